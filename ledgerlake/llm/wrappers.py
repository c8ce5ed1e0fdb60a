"""Operator 2: main text of web pages by union-free wrappers.

A page is a stream of tags and text slots.  Tandem repeats in it are folded into repeated groups.  The streams of a host's pages
are aligned one after the other: equal parts stay, a part that only one side has becomes optional, a body that one
side repeats becomes a repeated group on both, and differing texts become one slot.  The result is the host's wrapper, a regular
expression of tags, slots, optional and repeated groups without unions.  It also carries, for each slot,
its container, in how many pages it stands, how much text it held, and whether that text varies.

The wrapper tells which containers hold the article: ``article`` or ``main`` elements; for pages without text in one, the
common container of all text that varies among such pages of the host, without its sections that never vary; for pages without text there, the whole page.
Extraction walks each page, takes the text of those containers, and
leaves out navigation, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.  Class words tell these
by, but not of ``html``, ``body`` and ``main``, nor of an ``article`` outside other articles.
Then each page's tokens are aligned with the host's wrapper: a block of text goes if its slot there is on at least 0.8 of the
host's pages with that same text (share lines, notices), also one of several in a repeated group.  It stays on
hosts of fewer than four pages, and where such blocks are more than half of the page's article, as in copies of one page.
Counts of a slot's texts are summaries of a fixed size, at most a sixteenth of the pages too low.

Scale: a task folds its pages into one partial wrapper per host (as partial aggregation does), so a
host with a third of all pages sends one row per task; partial wrappers are merged in two steps, salted first.
Pages are joined with their host's containers and, where it has constant lines, its wrapper: a small table that Spark broadcasts or joins with skew splitting.

Defined results: null or empty html gives the empty text; a null url belongs to the empty host; repeated rows are all
returned; an empty table gives no rows; extra columns are ignored.  Unclosed elements end with their parent; an
unclosed script or comment runs to the end of the page.
"""

from __future__ import annotations

import html as entities
import json
import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.urls import parts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|noscript|template|svg|iframe|select|object)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.S | re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr br".split())
CONTAINERS = frozenset("html body div section article main nav header footer aside form ul ol dl table figure blockquote details "
                       "dialog fieldset menu center".split())
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog button head".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo cookie cookies consent notice notices alert popup modal "
    "newsletter subscribe subscription sidebar widget related breadcrumb breadcrumbs menu nav navbar navigation footer header "
    "comment comments disqus reply replies respond social share sharing paywall login signup".split())
STATES = ("has-", "no-", "with-", "without-", "not-", "is-")
"""Class names that begin so tell of what an element holds or lacks, not what it is."""
NAMES = re.compile(r"\b(?P<kind>class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
SLOT = "#"
SAME, FEW = 0.8, 4
"""A line is the host's if it begins in the same slot on this share of its pages, and the host has that many pages."""
COUNTED = 16
SECTION = re.compile(r"/(?:div|section|center)(?:[.@][^/]*)?$")
OTHER = "!"
"""Before a section within the content containers whose text is the same on all of at least half the host's pages."""
PLAIN = "-"
"""Before the containers of a page that has no text in an article or main element."""
WHOLE = frozenset("html body main article".split())
"""Elements that hold the page or its article: what their class says is about the page, not that they are none of it."""
ARTICLE = re.compile(r"(.*?/(?:article|main)(?:[.@][^/]*)?)(?:/|$)")
PAGE_NUMBERS = re.compile(r"[0-9a-f]*[0-9][0-9a-f]{7,}|[0-9]+", re.I)


def is_aside(tag: str, attributes: str, nested: bool = False) -> bool:
    """Whether an element is none of the article; ``nested`` tells that it stands within an article element."""
    if tag in ASIDE_TAGS:
        return True
    if not attributes or "=" not in attributes or tag in WHOLE and not (nested and tag == "article"):
        return False
    names = [n for m in NAMES.findall(attributes) for n in "".join(m[1:]).lower().split()]
    return any(not ASIDE_WORDS.isdisjoint(WORDS.findall(n)) for n in names if not n.startswith(STATES))


@lru_cache(1 << 12)
def label_of(tag: str, attributes: str) -> str:
    """The tag with its first class, or its id or role where it has no class; numbers of single pages are left out."""
    found = {m[0].lower(): "".join(m[1:]).split() for m in reversed(NAMES.findall(attributes))} if attributes else {}
    for kind, mark in (("class", "."), ("id", "@"), ("role", "@")):
        if found.get(kind):
            return tag + mark + PAGE_NUMBERS.sub("0", found[kind][0]).replace("/", "_")
    return tag


def stream(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """``kind, value, container, aside`` of every tag and text: kind is open, close or text; container is the path of
    open containers, with classes; aside tells whether an open element is none of the article."""
    stack: list[tuple[str, str, bool]] = []  # name, path, aside
    path, aside = "", False
    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            yield "text", text, path, aside
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            yield "raw", "", path, aside
            continue
        if m["close"] or m["close2"]:
            if any(s[0] == name for s in stack):
                while stack and stack.pop()[0] != name:
                    pass
                path, aside = (stack[-1][1], stack[-1][2]) if stack else ("", False)
            yield "close", name, path, aside
            continue
        attributes = m["attributes"] or ""
        off = is_aside(name, attributes, name == "article" and any(s[0] == name for s in stack))
        if name in CONTAINERS or off:
            path, aside = f"{path}/{label_of(name, attributes)}", aside or off
            if name not in ("p", "button") and not attributes.endswith("/") or name in CONTAINERS:
                stack.append((name, path, aside))
        yield "open", name, path, aside


def parse(page: str) -> tuple[list[str], list[tuple[int, list[tuple[str, bool, str]]]]]:
    """The page's tokens (tags and slots), and its blocks of text: the number of the first slot, and ``container, aside, text``
    of each text in it.  Inline tags do not end a block."""
    cores: list[str] = []
    blocks: list[tuple[int, list[tuple[str, bool, str]]]] = []
    now: list[tuple[str, bool, str]] = []
    first = -1
    for kind, value, path, aside in stream(page):
        if kind == "text":
            now.append((path, aside, value))
            if not value.isspace():
                if not (cores and cores[-1] == SLOT):
                    cores.append(SLOT)
                if first < 0:
                    first = len(cores) - 1
        elif kind != "raw":
            cores.append(value if kind == "open" else "/" + value)
            if value == "br":
                now.append((path, aside, " "))
            elif value not in INLINE:
                if first >= 0:
                    blocks.append((first, now))
                now, first = [], -1
    if first >= 0:
        blocks.append((first, now))
    return cores, blocks


def line_of(texts: list[str]) -> str:
    return " ".join(entities.unescape("".join(texts)).split())


def line_hash(block: list[tuple[str, bool, str]]) -> str | None:
    """The hash of a block's text outside asides; None if there is none."""
    line = line_of([text for _, aside, text in block if not aside])
    return xxhash.xxh3_64_hexdigest(line.encode("utf-8", "surrogatepass")) if line else None


def folded(cores: list, widths: list[int]) -> tuple[list, list[int]]:
    """Tandem repeats become repeated groups, short bodies first; ``widths`` tells how many tokens each core stands for."""
    size = 1
    while size <= len(cores) // 2 and size <= 40:
        out, wide, i, changed = [], [], 0, False
        while i < len(cores):
            body, k = cores[i:i + size], 1
            if len(body) == size and cores[i + size:i + size + 1] == body[:1]:
                while cores[i + k * size:i + (k + 1) * size] == body:
                    k += 1
            if k > 1:
                out.append(body[0] if size == 1 and isinstance(body[0], tuple) and body[0][0] == "rep" else ("rep", tuple(body)))
                wide.append(sum(widths[i:i + k * size]))
                i, changed = i + k * size, True
            else:
                out.append(cores[i])
                wide.append(widths[i])
                i += 1
        cores, widths = out, wide
        size = 1 if changed and size > 1 else size + 1
    return cores, widths


def fold(cores: list) -> list:
    return folded(cores, [1] * len(cores))[0]


def regroup(cores: list, widths: list[int], bodies: set[tuple]) -> tuple[list, list[int]]:
    """Single or repeated occurrences of known repeated bodies become the repeated group."""
    for body in sorted(bodies, key=lambda b: (len(b), repr(b))):
        out, wide, i, n = [], [], 0, len(body)
        while i < len(cores):
            whole = tuple(cores[i:i + n]) == body
            if whole or cores[i] == ("rep", body):
                m = n if whole else 1
                if out and out[-1] == ("rep", body):
                    wide[-1] += sum(widths[i:i + m])
                else:
                    out.append(("rep", body))
                    wide.append(sum(widths[i:i + m]))
                i += m
            else:
                out.append(cores[i])
                wide.append(widths[i])
                i += 1
        cores, widths = out, wide
    return cores, widths


def bodies_of(cores: list) -> set[tuple]:
    return {c[1] for c in cores if isinstance(c, tuple)}


def counted(one: list | None, two: list | None, most: int) -> list | None:
    """The lines of two cores, or of one core in two wrappers: the most lines of a page, and pages by line hash (at most
    ``most``).  ``one`` is taken over.

    Of more than 2 * COUNTED times the lines of a page, the rarest go and the others lose as much (the summary of Misra
    and Gries), so a line's pages are at most 1 / COUNTED of all pages too few and never too many."""
    if not one or not two:
        return one or two
    counts = one[1]
    for k, n in two[1].items():
        counts[k] = min(counts.get(k, 0) + n, most)
    room = COUNTED * max(one[0], two[0])
    if len(counts) > 2 * room:
        less = sorted(counts.values(), reverse=True)[room]
        counts = {k: n - less for k, n in counts.items() if n > less}
    return [max(one[0], two[0]), counts]


class Wrapper:
    """Cores in order with the number of pages that have each and the lines that begin in each; and facts about the
    text in each container."""

    def __init__(self, cores: list, pages: int = 1, support: list[int] | None = None, slots: dict | None = None, lines: list | None = None):
        self.cores, self.pages = cores, pages
        self.support = support if support is not None else [pages] * len(cores)
        self.slots = slots if slots is not None else {}  # container -> [characters, pages, hash of its text or None if texts differ, aside]
        self.lines = lines if lines is not None else [None] * len(cores)

    @classmethod
    def of_page(cls, page: str) -> Wrapper:
        tokens, blocks = parse(page)
        slots, named = {}, False
        for _, block in blocks:
            for path, aside, value in block:
                text = value.strip()
                if text:
                    seen = slots.setdefault(path, [0, 1, xxhash.xxh3_128(), aside])
                    seen[0] += len(text)
                    seen[2].update(text.encode("utf-8", "surrogatepass") + b"\0")
                    named = named or not aside and ARTICLE.match(path) is not None
        for seen in slots.values():
            seen[2] = seen[2].hexdigest()
        cores, widths = folded(tokens, [1] * len(tokens))
        lines: list = [None] * len(cores)
        for k, (_, block) in zip(places(widths, blocks), blocks):
            found = line_hash(block)
            if found:
                lines[k] = lines[k] or [0, {}]
                lines[k][1][found] = 1
                lines[k][0] = len(lines[k][1])
        return cls(cores, slots=slots if named else {PLAIN + path: seen for path, seen in slots.items()}, lines=lines)

    def merge(self, other: Wrapper) -> Wrapper:
        """The wrapper of the pages of both; their counts of lines are taken over."""
        bodies = bodies_of(self.cores) | bodies_of(other.cores)
        one, two = (w.regrouped(bodies) for w in (self, other))
        pages = one.pages + two.pages
        cores, support, lines = [], [], []
        for op, a, b, c, d in aligned(one.cores, two.cores):
            if op == "equal":
                cores += one.cores[a:b]
                support += [x + y for x, y in zip(one.support[a:b], two.support[c:d])]
                lines += [counted(x, y, pages) for x, y in zip(one.lines[a:b], two.lines[c:d])]
            else:  # optional parts of either side
                cores += one.cores[a:b] + two.cores[c:d]
                support += one.support[a:b] + two.support[c:d]
                lines += one.lines[a:b] + two.lines[c:d]
        slots = {k: list(v) for k, v in one.slots.items()}
        for k, v in two.slots.items():
            if k in slots:
                s = slots[k]
                slots[k] = [s[0] + v[0], s[1] + v[1], s[2] if s[2] == v[2] else None, s[3] and v[3]]
            else:
                slots[k] = list(v)
        return Wrapper(cores, pages, support, slots, lines)

    def regrouped(self, bodies: set[tuple]) -> Wrapper:
        cores, widths = regroup(self.cores, [1] * len(self.cores), bodies)
        if cores == self.cores:
            return self
        support, lines, at = [], [], 0
        for n in widths:
            support.append(max(self.support[at:at + n]))
            joint = None
            for x in self.lines[at:at + n]:
                wide = (joint[0] if joint else 0) + (x[0] if x else 0)
                joint = counted(joint, x, self.pages)
                if joint:
                    joint = [wide, joint[1]]
            lines.append(joint)
            at += n
        return Wrapper(cores, self.pages, support, self.slots, lines)

    def guide(self) -> str | None:
        """The cores, and for each the lines that begin there on at least ``SAME`` of the host's pages; None if there are none."""
        same = {k: sorted(x for x, n in lines[1].items() if n >= SAME * self.pages)
                for k, lines in enumerate(self.lines) if lines and self.support[k] >= SAME * self.pages}
        same = {k: v for k, v in same.items() if v}
        return json.dumps([self.cores, list(same.items())]) if same and self.pages >= FEW else None

    def expression(self) -> str:
        """The wrapper written as a regular expression; consecutive parts of equal support are one optional group."""
        def text(core) -> str:
            return "(" + "".join(map(text, core[1])) + ")+" if isinstance(core, tuple) else core if core == SLOT else f"<{core}>"
        out, i = [], 0
        while i < len(self.cores):
            j = i + 1
            while j < len(self.cores) and self.support[j] == self.support[i]:
                j += 1
            part = "".join(map(text, self.cores[i:j]))
            out.append(part if self.support[i] >= self.pages else f"({part})?")
            i = j
        return "".join(out)

    def content(self) -> list[list[str]]:
        """Containers that hold the article; each list is for the pages on which those before it hold no text."""
        real = {k: v for k, v in self.slots.items() if not v[3]}
        named = sorted({m[1] for k in real for m in [ARTICLE.match(k)] if m})
        # of the pages without them: the container of all text that varies (text of a single page is not known to be constant)
        plain = {k[1:]: v for k, v in real.items() if k[:1] == PLAIN}
        varying = [k for k, v in plain.items() if v[2] is None or v[1] == 1]
        if not varying:
            return [x for x in (named,) if x] + [[""]]
        common = "".join("/" + c for c in os.path.commonprefix([k.split("/")[1:] for k in varying]))
        half = max(v[1] for v in plain.values()) / 2
        same = [OTHER + k for k, v in plain.items() if k != common and f"{k}/".startswith(f"{common}/") and v[1] >= half
                and SECTION.search(k) and not any(f"{x}/".startswith(f"{k}/") for x in varying)]
        return [x for x in (named, [common, *sorted(same)]) if x] + [[""]]

    def to_json(self) -> str:
        return json.dumps([self.cores, self.pages, self.support, self.slots, self.lines])

    @classmethod
    def from_json(cls, text: str) -> Wrapper:
        cores, pages, support, slots, lines = json.loads(text)
        return cls([core_of(c) for c in cores], pages, support, slots, lines)


def core_of(x):
    return (x[0], tuple(core_of(y) for y in x[1])) if isinstance(x, list) else x


def aligned(one: list, two: list) -> list[tuple[str, int, int, int, int]]:
    if one == two:
        return [("equal", 0, len(one), 0, len(two))]
    return SequenceMatcher(None, one, two, autojunk=False).get_opcodes()


def places(widths: list[int], blocks: list) -> list[int]:
    """The core in which each block begins."""
    ends = list(accumulate(widths))
    return [bisect_right(ends, first) for first, _ in blocks]


class Guide:
    """A host's wrapper as extraction needs it: its cores, and the lines that do not vary in each."""

    def __init__(self, text: str):
        cores, same = json.loads(text)
        self.cores = [core_of(c) for c in cores]
        self.bodies = bodies_of(self.cores)
        self.same = {k: frozenset(v) for k, v in same}
        self.known: dict[tuple, dict[int, int]] = {}

    def constant(self, tokens: list, blocks: list) -> set[int]:
        """The blocks that stand in a slot of the wrapper with a text that does not vary there."""
        cores, widths = regroup(*folded(tokens, [1] * len(tokens)), self.bodies)
        key = tuple(cores)
        slot = self.known.get(key)
        if slot is None:
            slot = {a + i: c + i for op, a, b, c, d in aligned(cores, self.cores) if op == "equal" for i in range(b - a)}
            if len(self.known) < 4096:
                self.known[key] = slot
        none: frozenset = frozenset()
        return {i for i, (k, (_, block)) in enumerate(zip(places(widths, blocks), blocks))
                if k in slot and (same := self.same.get(slot[k], none)) and line_hash(block) in same}


@lru_cache(256)
def guide_of(text: str) -> Guide:
    return Guide(text)


def lines_in(blocks: list, content: list[str]) -> list[tuple[int, str]]:
    """Number and text of the blocks with text in the content containers."""
    inside: dict[str, bool] = {}
    other = [c[len(OTHER):] for c in content if c.startswith(OTHER)]
    out = []
    for i, (_, block) in enumerate(blocks):
        texts = []
        for path, aside, text in block:
            own = inside.get(path)
            if own is None:
                own = inside[path] = (any(c == "" or path == c or path.startswith(c + "/") for c in content)
                                      and not any(path == c or path.startswith(c + "/") for c in other))
            if own and not aside:
                texts.append(text)
        line = line_of(texts)
        if line:
            out.append((i, line))
    return out


def main_text(page: str, content: list[str]) -> str:
    """The blocks of the content containers, one a line."""
    return "\n".join(line for _, line in lines_in(parse(page)[1], content))


def first_text(page: str, content: list[list[str]], guide: str | None = None) -> str:
    """The text by the first containers that hold any on this page, without the host's constant lines; if those are the
    greater part (copies of one page), they stay."""
    tokens, blocks = parse(page)
    found = next((x for x in (lines_in(blocks, c) for c in content) if x), [])
    if found and guide:
        constant = guide_of(guide).constant(tokens, blocks)
        kept = [(i, line) for i, line in found if i not in constant]
        if sum(len(line) for _, line in kept) * 2 >= sum(len(line) for _, line in found):
            found = kept
    return "\n".join(line for _, line in found)


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """``host, wrapper, content, guide, pages``: each host's wrapper as an expression, its content containers, the slots
    with constant lines and its pages."""
    rows = hosted(pages, id_col, url_col, html_col).select("host", "html")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Wrapper] = {}
        for b in batches:
            for host, page in zip(*(c.to_pylist() for c in b.columns)):
                one = Wrapper.of_page(page)
                old = found.get(host)
                found[host] = old.merge(one) if old else one
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([w.to_json() for w in found.values()], pa.string())],
                                         names=["host", "wrapper"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in sorted(frame["wrapper"]):
            one = Wrapper.from_json(text)
            whole = one if whole is None else whole.merge(one)
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [whole.to_json()]})

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        w = Wrapper.from_json(merge(frame)["wrapper"].iloc[0])
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [w.expression()], "content": [w.content()],
                             "guide": [w.guide()], "pages": [w.pages]})

    found = rows.mapInArrow(partial, "host string, wrapper string").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(32)))
    some = found.groupBy("host", "salt").applyInPandas(merge, "host string, wrapper string")
    return some.groupBy("host").applyInPandas(finish, "host string, wrapper string, content array<array<string>>, guide string, pages long")


def hosted(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    host = parts(rows.select(F.struct("page_id", "url", "html").alias("page_id"), "url")).select("page_id.*", "host")
    return host.select("page_id", "url", "html", "host")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, by its host's wrapper."""
    rows = hosted(pages, id_col, url_col, html_col)
    known = infer(pages, url_col, html_col, id_col).select("host", "content", "guide")
    joined = rows.join(known, "host", "left").select("page_id", "url", "html", "content", "guide")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [first_text(page, content or [[""]], guide) for page, content, guide in zip(*(c.to_pylist() for c in b.columns[2:5]))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string").select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
