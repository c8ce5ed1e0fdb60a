"""Operator 4: URL filter with path rules and a Bloom filter cascade.

A url is judged by the longest rule that fits it, else by a list of blocked keys (hosts, or hosts with paths).  The list is
compiled against the complete universe of the corpus's keys: level 1 is a Bloom filter of the listed keys,
level 2 one of the unlisted keys that pass level 1, level 3 one of the listed keys that pass level 2, and so
on until nothing passes wrongly.  A key of the universe is listed if the first level that it misses is an
even one, which is exact, and costs a few bits a key in place of a join.

Scale: the universe is dealt out by hash into shards of about ``PER_SHARD`` keys, each compiled in its own
task.  Judging needs the compiled bits only: they are sent to all tasks if their measured size is at most ``MOST_BYTES``;
above that the distinct keys are judged shard by shard beside their bits, and the verdicts joined on the keys
(Spark splits a hot host).

Defined results: null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed;
repeated rows are judged one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import store

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))
BLOCKED_LABELS = ("ads-track", "cheap-pills", "spam-farm")
PER_SHARD = 500_000
MOST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(urls: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path`` of every row."""
    url = F.col(f"`{url_col}`")
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.char_length(url))).otherwise("")
    return urls.select(F.col(f"`{id_col}`").alias("page_id"), F.coalesce(rest, F.lit("")).alias("rest")).select(
        "page_id", F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def rule_of(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):  # a longer rule overrides
        host, path = text.split("/", 1)
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def keys_of(rows: DataFrame) -> DataFrame:
    """The distinct keys of hosts and paths: every host, and every host with its path."""
    return rows.where("host <> ''").select(
        F.explode(F.array("host", F.concat("host", "path"))).alias("key")).distinct()


def hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def bits_at(h1: np.ndarray, h2: np.ndarray, level: int, n_bits: int, hashes: int) -> np.ndarray:
    """The places of each key's bits, a row for each hash."""
    salt = np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))
    a = (h1 + salt) ^ (h2 >> np.uint64(29))
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    b = (h2 ^ salt) * np.uint64(0x94D049BB133111EB) | np.uint64(1)
    b ^= b >> np.uint64(30) << np.uint64(1)
    return np.stack([(a + np.uint64(i) * b ^ (a >> np.uint64(17))) % np.uint64(n_bits) for i in range(hashes)])


def passes(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int, hashes: int) -> np.ndarray:
    at = bits_at(h1, h2, level, len(bits) * 8, hashes)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def compile_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """The levels' bits and numbers of hashes for keys with hashes (h1, h2)."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[tuple[np.ndarray, int]] = []
    while len(inside):
        if len(levels) > 200:
            raise ValueError("a listed and an unlisted key have equal hashes")
        # a low rate where many keys could pass wrongly, else one half
        rate = 0.5 if levels else min(0.5, max(2.0 ** -12, 0.7 * len(inside) / max(1, len(outside))))
        hashes = max(1, round(-np.log2(rate)))
        bits = np.zeros(max(8, int(np.ceil(len(inside) * hashes / np.log(2) / 8))), np.uint8)
        at = bits_at(h1[inside], h2[inside], len(levels) + 1, len(bits) * 8, hashes).ravel()
        np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        levels.append((bits, hashes))
        wrong = outside[passes(bits, h1[outside], h2[outside], len(levels), hashes)] if len(outside) else outside
        inside, outside = wrong, inside
    return levels


def is_listed(levels: Sequence[tuple[np.ndarray, int]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed."""
    out = np.zeros(len(h1), bool)
    alive = np.arange(len(h1))
    for level, (bits, hashes) in enumerate(levels, 1):
        alive = alive[passes(bits, h1[alive], h2[alive], level, hashes)]
        out[alive] = level % 2 == 1
    return out


def cascade(universe: DataFrame, listed: DataFrame, shards: int) -> DataFrame:
    """``shard, level, hashes, bits`` for the distinct ``key`` rows of ``universe`` and ``listed``."""
    marked = universe.join(listed.select("key", F.lit(True).alias("listed")).distinct(), "key", "left")
    rows = marked.select(*hashed(F.col("key")), F.coalesce("listed", F.lit(False)).alias("listed")).withColumn(
        "shard", F.pmod("h1", F.lit(shards)).cast("int"))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        levels = compile_levels(*(frame[c].to_numpy().view(np.uint64) for c in ("h1", "h2")), frame["listed"].to_numpy(bool))
        return pd.DataFrame({"shard": frame["shard"].iloc[0], "level": np.arange(1, len(levels) + 1, dtype=np.int32),
                             "hashes": np.array([k for _, k in levels], np.int32), "bits": [b.tobytes() for b, _ in levels]})

    return rows.groupBy("shard").applyInPandas(build, "shard int, level int, hashes int, bits binary")


def by_shard(rows: Sequence) -> dict[int, list[tuple[np.ndarray, int]]]:
    out: dict[int, list[tuple[np.ndarray, int]]] = {}
    for r in sorted(rows, key=lambda r: (r["shard"], r["level"])):
        out.setdefault(r["shard"], []).append((np.frombuffer(r["bits"], np.uint8), r["hashes"]))
    return out


def judge(pages: DataFrame, listed: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
          id_col: str = "page_id", url_col: str = "url", per_shard: int = PER_SHARD,
          most_bytes: int = MOST_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every row.

    ``listed`` has the blocked keys in a column ``key``; by default the hosts with a label of ``BLOCKED_LABELS``.
    """
    rows = parts(pages, id_col, url_col)
    universe = store(keys_of(rows), "keys")
    if listed is None:
        label = "|".join(BLOCKED_LABELS)
        listed = universe.where(~F.contains("key", F.lit("/")) & F.col("key").rlike(rf"(^|\.)({label})(\.|$)"))
    shards = max(1, -(-universe.count() // per_shard))
    compiled = store(cascade(universe, listed, shards), "cascade")
    size = compiled.agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]
    rule, verdict = rule_of(rules)
    if size <= most_bytes:
        sent = pages.sparkSession.sparkContext.broadcast(by_shard(compiled.collect()))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = np.zeros(b.num_rows, bool)
                for c in (3, 5):
                    h1, h2 = (b.column(c + i).to_numpy().view(np.uint64) for i in (0, 1))
                    shard = np.mod(h1.view(np.int64), shards)
                    for s in np.unique(shard):
                        own = np.flatnonzero(shard == s)
                        hit[own] |= is_listed(sent.value.get(int(s), []), h1[own], h2[own])
                hit &= np.array(b.column(1).to_pylist(), object) != ""
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(hit)], names=["page_id", "host", "path", "listed"])

        hashes = [c.alias(f"{c_}{k}") for k, key in enumerate((F.col("host"), F.concat("host", "path")))
                  for c, c_ in zip(hashed(key), ("h1_", "h2_"))]
        kind = rows.schema["page_id"].dataType.simpleString()
        marked = rows.select("page_id", "host", "path", *hashes).mapInArrow(
            mark, f"page_id {kind}, host string, path string, listed boolean")
    else:
        def own(frame: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
            levels = by_shard(bits.to_dict("records")).get(int(frame["shard"].iloc[0]), []) if len(frame) else []
            hit = is_listed(levels, *(frame[c].to_numpy().view(np.uint64) for c in ("h1", "h2")))
            return frame.loc[hit, ["key"]]

        dealt = universe.select("key", *hashed(F.col("key"))).withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
        hits = dealt.groupBy("shard").cogroup(compiled.groupBy("shard")).applyInPandas(own, "key string")
        hits = store(hits, "listed-keys")
        marked = (rows.join(hits.select(F.col("key").alias("host"), F.lit(True).alias("a")), "host", "left")
                  .withColumn("key", F.concat("host", "path")).join(hits.withColumn("b", F.lit(True)), "key", "left")
                  .select("page_id", "host", "path", (F.coalesce("a", "b", F.lit(False))).alias("listed")))
    return marked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


ORACLE_SQL = r"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END rest FROM pages),
p AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*', 0)) host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path FROM r),
rules(verdict, rule, host, path) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
best AS (SELECT p.page_id, arg_max(r.rule, length(r.rule)) rule, arg_max(r.verdict, length(r.rule)) verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY 1)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, CASE WHEN l THEN 'block' ELSE 'allow' END) verdict, l AS listed
FROM (SELECT *, regexp_matches(host, '(^|\.)(ads-track|cheap-pills|spam-farm)(\.|$)') l FROM p) p LEFT JOIN best b USING (page_id)"""
