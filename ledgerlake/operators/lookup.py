"""Lookup joins.

Join strategy: lookups are deduplicated on their key *before* the join (so a
left join never fans the fact out, q10), then joined with a plain equi-join and
AQE picks broadcast-hash or sort-merge at run time from the measured size
(``spark.sql.adaptive.autoBroadcastJoinThreshold``).  Skewed fact keys on the
shuffle path are split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for an equi-join that must not broadcast it: a table that grows with the parts.  Spark plans by file size, and
    such a table is stored in a few bytes a row, so that a file far below the broadcast limit can hold more rows than the
    driver can take.  Both sides are shuffled and sorted; AQE splits a skewed key."""
    return df.hint("merge")


def dedupe_lookup(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                  order_by: Sequence[str] | None = None, normalize_keys: bool = True) -> DataFrame:
    """One row per (trimmed) key; among duplicates the row with the
    greatest ``order_by`` (then greatest values) wins — the explicit stand-in for
    the reference's "last duplicate wins".  Partial aggregation keeps this
    skew-safe (no window over a hot key).  One value without an order is its plain
    maximum: no struct per row, and for numbers a hash aggregate instead of a sort."""
    order_by = list(order_by or [])
    kcols = [F.trim(F.col(k)).alias(k) if normalize_keys else F.col(k) for k in keys]
    if not order_by and len(values) == 1:
        best = df.select(*kcols, F.col(values[0]).alias("__v")).groupBy(*keys).agg(F.max("__v").alias("__v"))
        return best.select(*keys, F.col("__v").alias(values[0]))
    packed = F.struct(
        F.struct(*[F.col(c) for c in order_by]).alias("o") if order_by else F.lit(0).alias("o"),
        F.struct(*[F.col(v) for v in values]).alias("v"))
    best = df.select(*kcols, packed.alias("__p")).groupBy(*keys).agg(F.max("__p").alias("__p"))
    return best.select(*keys, *[F.col(f"__p.v.{v}").alias(v) for v in values])


def map_or_keep(df: DataFrame, column: str, lookup: DataFrame, key: str, value: str,
                out: str | None = None) -> DataFrame:
    """Replace ``column`` by its mapped value when the key is found."""
    lk = lookup.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    joined = df.join(lk, F.trim(df[column]) == F.col("__k"), "left")
    return joined.withColumn(out or column, F.coalesce(F.col("__v"), df[column])).drop("__k", "__v")


def fallback_lookup(df: DataFrame, lookup: DataFrame, paths: Sequence[Mapping[str, Column | str]],
                    value: str, out: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Try key path A, then key path B, ...; first hit wins.

    Each path maps lookup key columns to fact key expressions and becomes one
    left join against a copy of the lookup deduplicated on that path's key."""
    result = df
    tmp = []
    for i, path in enumerate(paths):
        keys = list(path)
        lk = dedupe_lookup(lookup, keys, [value], order_by, normalize_keys=False)
        lk = lk.select(*[F.col(k).alias(f"__f{i}_{k}") for k in keys], F.col(value).alias(f"__v{i}"))
        cond = None
        for k, fexpr in path.items():
            e = _c(fexpr) == F.col(f"__f{i}_{k}")
            cond = e if cond is None else (cond & e)
        result = result.join(lk, cond, "left").drop(*[f"__f{i}_{k}" for k in keys])
        tmp.append(f"__v{i}")
    return result.withColumn(out, F.coalesce(*[F.col(t) for t in tmp])).drop(*tmp)


def last_name_part(x) -> Column:
    """``ods.t`` → ``t``."""
    return F.element_at(F.split(_c(x), r"\."), -1)


def resolve_name(df: DataFrame, name_col: str, producers: DataFrame, producer_key: str,
                 producer_value: str, out: str) -> DataFrame:
    """Exact-name match first, else match on the part after the last '.'."""
    return fallback_lookup(df, producers,
                           [{producer_key: F.col(name_col)}, {producer_key: last_name_part(F.col(name_col))}],
                           producer_value, out)


@dataclass
class LookupSpec:
    """One enrichment step of :func:`star_enrich`."""
    table: DataFrame
    on: Mapping[str, Column | str]      # lookup key column -> fact key expression
    columns: Mapping[str, str]          # lookup column -> output name
    dedupe: bool = True
    order_by: Sequence[str] = field(default_factory=list)


def star_enrich(fact: DataFrame, specs: Sequence[LookupSpec]) -> DataFrame:
    """Chained left equi-joins of one fact to many lookups on 1-4 keys.

    Each lookup is reduced to (keys, needed columns) and deduplicated on its
    key, so the fact's row count is preserved (invariant tested)."""
    out = fact
    for i, spec in enumerate(specs):
        keys = list(spec.on)
        cols = list(spec.columns)
        lk = (dedupe_lookup(spec.table, keys, cols, spec.order_by, normalize_keys=False)
              if spec.dedupe else spec.table.select(*keys, *cols))
        lk = lk.select(*[F.col(k).alias(f"__j{i}_{k}") for k in keys],
                       *[F.col(c).alias(spec.columns[c]) for c in cols])
        cond = None
        for k, fexpr in spec.on.items():
            e = _c(fexpr) == F.col(f"__j{i}_{k}")
            cond = e if cond is None else (cond & e)
        out = out.join(lk, cond, "left").drop(*[f"__j{i}_{k}" for k in keys])
    return out


def ci_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
            right_keys: Sequence[str] | None = None) -> DataFrame:
    """Case-insensitive composite equi-join (``UPPER(a)=UPPER(b)`` per key);
    stays a hash/sort-merge equi-join on the normalised keys."""
    right_keys = list(right_keys or keys)
    r = right.withColumns({f"__ci{i}": F.upper(F.col(k)) for i, k in enumerate(right_keys)})
    cond = None
    for i, k in enumerate(keys):
        e = F.upper(left[k]) == r[f"__ci{i}"]
        cond = e if cond is None else (cond & e)
    return left.join(r, cond, how).drop(*[f"__ci{i}" for i in range(len(keys))])


def _longest_literal(pattern: Column) -> Column:
    """The longest run of a LIKE pattern without wildcards and escaped characters ('' if there is none)."""
    runs = F.split(pattern, r"\\.|[%_]")
    return F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("run")))).getField("run")


def like_join(facts: DataFrame, text_col: str, patterns: DataFrame, pattern_col: str,
              how: str = "inner", gram: int = 8) -> DataFrame:
    """``fact.text LIKE pattern.pattern`` with the pattern a column, as equi-joins.

    A text can only match a pattern whose literal runs it contains.  Every pattern
    is keyed by the first ``gram`` characters (or fewer) of its longest run; every
    *distinct* text is cut into its distinct substrings of just those lengths that
    some pattern has (at most ``gram + 1`` of them, a scalar subquery).  Both meet
    on the key, the LIKE itself decides, and the matches go back to the facts by
    text.  No bound on the number of patterns, no nested loop, nothing broadcast
    by hand; a common key is a skewed equi-join that AQE splits.

    Repeated patterns and facts keep their multiplicity; a NULL text or pattern
    matches nothing (``how="left"`` keeps the fact); a pattern of wildcards only
    meets every distinct text."""
    pat = patterns.where(F.col(pattern_col).isNotNull()).withColumn(
        "__gram", F.substring(_longest_literal(F.col(pattern_col)), 1, gram))
    lengths = pat.select(F.array_sort(F.collect_set(F.length("__gram")))).scalar()
    texts = facts.select(F.col(text_col).alias("__text")).where(F.col("__text").isNotNull()).distinct()
    cuts = F.regexp_extract_all("__text", F.concat(F.lit("(?s)(?=(.{"), F.col("__n"), F.lit("}))")), F.lit(1))
    keyed = texts.select("__text", F.explode(lengths).alias("__n")).select(
        "__text", F.explode(F.array_distinct(cuts)).alias("__gram"))
    matches = keyed.join(pat, "__gram").where(F.like("__text", F.col(pattern_col))).drop("__gram")
    return facts.join(matches, facts[text_col] == matches["__text"], how).drop("__text")


def match_cascade(fact: DataFrame, lookup: DataFrame, rules: Sequence[Mapping], value: str,
                  out: str) -> DataFrame:
    """First-match-wins cascade over subsets of one lookup.

    Each rule is ``{"where": Column on the lookup or None, "keys": {lookup col:
    fact expr}, "const": value or None}``; a rule with ``const`` is a literal
    result gated by its fact condition ``fact_where``.  One left join per rule
    (lookups deduplicated per rule key), then COALESCE in rule order."""
    result = fact
    picks = []
    for i, rule in enumerate(rules):
        if rule.get("const") is not None:
            picks.append(F.when(rule.get("fact_where", F.lit(True)), F.lit(rule["const"])))
            continue
        sub = lookup.where(rule["where"]) if rule.get("where") is not None else lookup
        keys = list(rule["keys"])
        lk = dedupe_lookup(sub, keys, [value], rule.get("order_by"), normalize_keys=False)
        lk = lk.select(*[F.col(k).alias(f"__m{i}_{k}") for k in keys], F.col(value).alias(f"__mv{i}"))
        cond = None
        for k, fexpr in rule["keys"].items():
            e = _c(fexpr) == F.col(f"__m{i}_{k}")
            cond = e if cond is None else (cond & e)
        if rule.get("fact_where") is not None:
            cond = cond & rule["fact_where"]
        result = result.join(lk, cond, "left").drop(*[f"__m{i}_{k}" for k in keys])
        picks.append(F.col(f"__mv{i}"))
    tmp = [f"__mv{i}" for i in range(len(rules)) if f"__mv{i}" in result.columns]
    return result.withColumn(out, F.coalesce(*picks)).drop(*tmp)


def subset_lookup(df: DataFrame, in_subset: Column, lookup: DataFrame, key_expr: Column, lk_key: str,
                  value: str, default, out: str) -> DataFrame:
    """Rows in the subset take the looked-up value (default if missing);
    all other rows take the default."""
    lk = dedupe_lookup(lookup, [lk_key], [value], normalize_keys=False).select(
        F.col(lk_key).alias("__sk"), F.col(value).alias("__sv"))
    joined = df.join(lk, key_expr == F.col("__sk"), "left")
    return joined.withColumn(out, F.when(in_subset, F.coalesce(F.col("__sv"), _c(default))).otherwise(_c(default))
                             ).drop("__sk", "__sv")


def split_join_union(df: DataFrame, branches: Sequence[tuple[Column, DataFrame, Mapping[str, str], Sequence[str]]]
                     ) -> DataFrame:
    """Split rows by a condition, join each part on its own key, union.

    ``branches``: (row condition, lookup, {fact col: lookup col}, lookup columns)."""
    parts = []
    for cond, lk, on, cols in branches:
        lk_keys = list(on.values())
        lk2 = dedupe_lookup(lk, lk_keys, cols, normalize_keys=False)
        lk2 = lk2.select(*[F.col(k).alias(f"__s_{k}") for k in lk_keys], *cols)
        c = None
        part = df.where(cond)
        for fcol, lcol in on.items():
            e = part[fcol] == F.col(f"__s_{lcol}")
            c = e if c is None else (c & e)
        parts.append(part.join(lk2, c, "left").drop(*[f"__s_{k}" for k in lk_keys]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def bom_explode(components: DataFrame, bom: DataFrame, comp_key: str, bom_comp: str, bom_parent: str,
                qty: str) -> DataFrame:
    """Component rows → finished parts.  The BOM is pre-aggregated to one
    row per (component, parent) with summed quantity, then left-joined (1:n)."""
    agg = bom.groupBy(bom_comp, bom_parent).agg(F.sum(qty).alias(qty))
    return components.join(agg, components[comp_key] == agg[bom_comp], "left").drop(bom_comp)


def attach_constant(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row, as scalar
    subqueries (no join at all)."""
    return df.withColumns({c: one_row.select(F.max(F.col(c))).scalar() for c in one_row.columns})


def semi_join_values(df: DataFrame, column: str, values: DataFrame, value_col: str) -> DataFrame:
    """Keep rows whose ``column`` is in a (small) value set."""
    v = values.select(F.col(value_col).alias("__sv")).distinct()
    return df.join(v, df[column] == F.col("__sv"), "left_semi")


def anti_join(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key tuple does not occur in ``incoming``."""
    return target.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
