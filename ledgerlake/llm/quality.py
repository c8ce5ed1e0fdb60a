"""Operator 5: line-first quality rules, DataFrame functions only.

Each line with a word is judged by itself:

* punctuation: more than ``symbols_per_word`` symbols of ``#*$%&|<>{}`` a word, or as many doubled exclamation marks;
* navigation: separators (``|``, ``>``, guillemets, bullets) make up a large part of its words, or it is a short line that
  consists of menu words only;
* boilerplate: a short line with a notice phrase, or a line equal to an earlier one of the same text.

Failing lines are removed, and a document is rejected when the removed lines hold more than ``most_lost`` of
its words' characters.  Beside that verdict stand base counts of the whole text, which reject a document that has too few words or too
many words in repeated five-word windows.

Scale: one narrow pass of expressions inside the scan's tasks, no shuffle, no Python, nothing collected; a
document's cost is n log n of its words at most.

Defined results: null text has no words (base_failed, not kept, cleaned text empty); repeated rows are judged
one by one; an empty table gives no rows; extra columns pass through ``clean`` untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MENU = ("about", "account", "archive", "blog", "cart", "categories", "contact", "faq", "forum", "help", "home", "login",
        "logout", "menu", "news", "next", "previous", "products", "register", "search", "services", "sitemap", "tags")
NOTICES = ("accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript", "lorem ipsum",
           "privacy policy", "read more", "share this", "sign up", "subscribe to", "terms of service", "terms of use",
           "uses cookies")
MENU_LINE = rf"(?i)^(?:{SPACE})?(?:(?:{'|'.join(MENU)})(?:{SPACE}|$)){{2,}}$"
NOTICE = f"(?i){'|'.join(NOTICES)}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where ``body`` uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def removed(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match ``pattern``."""
    return F.when(text.rlike(pattern), F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).otherwise(0)


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more.

    Hashes of the windows are compared first.  Only where two agree, the windows' words themselves are sorted with
    their positions; each repeated window then covers the words up to the next repeated window.
    """
    def starts(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - F.lit(WINDOW))

    def covered(w: Column) -> Column:
        texts = F.array_sort(F.transform(starts(w), lambda i: F.struct(
            F.concat_ws(" ", *[w[i + k] for k in range(WINDOW)]).alias("t"), i.alias("i"))))
        same = let(texts, lambda s: F.zip_with(
            F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
            lambda a, b: F.when(a["t"] == b["t"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
        places = F.sort_array(F.array_distinct(F.flatten(same)))
        gaps = let(places, lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                                                lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)

    def twice(w: Column) -> Column:
        hashes = F.transform(starts(w), lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)]))
        return let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))

    return let(words, lambda w: F.when(F.size(w) <= WINDOW, F.lit(0).cast("long"))
               .when(twice(w), covered(w)).otherwise(F.lit(0).cast("long")))


def bad_line(line: Column, symbols_per_word: float, short: int) -> Column:
    """Whether a line fails the punctuation, navigation or boilerplate rule."""
    n_words = F.size(words_of(line))
    noisy = line.rlike(r"[#*$%&|<>{}]") & (removed(line, r"[#*$%&|<>{}]") > symbols_per_word * n_words)
    shouted = F.contains(line, F.lit("!!")) & (removed(line, "!!") > 2 * symbols_per_word * n_words)
    separated = line.rlike(r"[|>«»•·]") & (removed(line, r"[|>«»•·]") > symbols_per_word * n_words)
    menu = (F.char_length(line) <= 12 * short) & line.rlike(MENU_LINE)
    notice = line.rlike(NOTICE) & (n_words <= short)
    return noisy | shouted | separated | menu | notice


def judge(docs: DataFrame, text_col: str = "text", min_words: int = 10, most_repeated: int = 20,
          symbols_per_word: float = 0.25, short: int = 20, most_lost: float = 0.5,
          kept_only: bool = False) -> DataFrame:
    """``docs`` with one column ``__verdict`` (a struct): the base counts, base_failed, cleaned text and kept.  With
    ``kept_only`` just the kept rows; the verdict is made by a generator, which computes it once."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def cleaned(ls: Column) -> Column:
        return F.array_distinct(F.filter(ls, lambda x: ~bad_line(x, symbols_per_word, short)))

    def chars(ls: Column) -> Column:
        return F.char_length(F.regexp_replace(F.array_join(ls, ""), SPACE, "")).cast("long")

    counts = F.struct(
        let(words_of(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"))).alias("w"),
        removed(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda ls: F.struct(
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            let(cleaned(ls), lambda c: F.struct(
                (F.size(c) == F.size(ls)).alias("whole"), F.array_join(c, "\n").alias("text"),
                F.when(F.size(c) == F.size(ls), F.lit(None).cast("long")).otherwise(chars(c)).alias("chars"))
                ).alias("clean"))).alias("l"))
    failed = lambda c: (c["w"]["n_words"] < min_words) | (
        100 * c["w"]["n_repeat_words"] > most_repeated * c["w"]["n_words"])
    left = lambda c: F.coalesce(c["l"]["clean"]["chars"], c["w"]["word_chars"])
    verdict = let(counts, lambda c: F.struct(
        c["w"]["n_words"].alias("n_words"), c["w"]["word_chars"].alias("word_chars"),
        c["n_symbols"].alias("n_symbols"), c["l"]["n_dup_lines"].alias("n_dup_lines"),
        c["w"]["n_repeat_words"].alias("n_repeat_words"), failed(c).alias("base_failed"),
        F.when(c["l"]["clean"]["whole"], text).otherwise(c["l"]["clean"]["text"]).alias("cleaned"),
        (~failed(c) & (left(c) >= (1 - most_lost) * c["w"]["word_chars"])).alias("kept")))
    if kept_only:
        return docs.select("*", F.explode(F.filter(F.array(verdict), lambda v: v["kept"])).alias("__verdict"))
    return docs.withColumn("__verdict", verdict)


def report(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """The contract's columns, one row per row of ``docs``."""
    rows = docs.select(F.col(f"`{doc_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(rows, **rules).select("doc_id", *[F.col(f"__verdict.{n}").alias(n) for n in names])


def clean(docs: DataFrame, text_col: str = "text", **rules) -> DataFrame:
    """The kept rows of ``docs`` with their cleaned texts (and ``n_chars``, if there is one, counted anew)."""
    out = judge(docs, text_col, kept_only=True, **rules).withColumn(text_col, F.col("__verdict.cleaned"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(F.col(f"`{text_col}`")).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{SPACE}'), lambda x: x <> '') ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) ls FROM d),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) i FROM w WHERE len(ws) > 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) c FROM grams) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) n FROM twice, range(0, 5) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, x, len(list_filter(string_split_regex(x, '{SPACE}'), lambda y: y <> '')) nw
  FROM (SELECT doc_id, unnest(ls) x FROM w)),
good AS (SELECT DISTINCT doc_id, x FROM lines WHERE NOT (
  length(x) - length(regexp_replace(x, '[#*$%&|<>{{}}]', '', 'g')) > 0.25 * nw
  OR length(x) - length(replace(x, '!!', '')) > 0.5 * nw
  OR length(x) - length(regexp_replace(x, '[|>«»•·]', '', 'g')) > 0.25 * nw
  OR (length(x) <= 240 AND regexp_matches(x, '{MENU_LINE}'))
  OR (nw <= 20 AND regexp_matches(x, '{NOTICE}')))),
kept AS (SELECT doc_id, sum(length(regexp_replace(x, '{SPACE}', '', 'g'))) chars FROM good GROUP BY doc_id),
counts AS (SELECT w.doc_id, len(ws) n_words, length(array_to_string(ws, '')) word_chars,
  length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) n_symbols,
  len(ls) - len(list_distinct(ls)) n_dup_lines, coalesce(covered.n, 0) n_repeat_words, coalesce(chars, 0) chars
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN kept USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) n_words, CAST(word_chars AS BIGINT) word_chars,
  CAST(n_symbols AS BIGINT) n_symbols, CAST(n_dup_lines AS BIGINT) n_dup_lines,
  CAST(n_repeat_words AS BIGINT) n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND chars >= 0.5 * word_chars AS kept FROM counts"""
