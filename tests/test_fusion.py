"""Fused lookups: values against a plain loop, one join per key set, candidate columns that are not all NULL."""

import random

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL

from ledgerlake.operators.fusion import Series, Value, attach, fuse
from ledgerlake.plans import grossprofit as GP
from ledgerlake.plans.q_gross import lookups
from ledgerlake.plans.registry import QUERIES, load_all
from ledgerlake.sources.adapters import tables

load_all()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(4)
    months = [f"2024{m:02d}" for m in range(1, 13)]
    pick = lambda *x: rng.choice(x)
    fact = [(i, pick("a", "b", "c", "d", None), pick("x", "y", None), pick(*months, None), pick(*months, "newest", None)) for i in range(400)]
    cost = [(pick("a", "b", "c", None), pick(*months, None), pick(None, 1.0, 2.0, 5.0)) for _ in range(60)]
    ratio = [(pick("a", "b"), pick("x", "y", None), pick(*months[3:9]), float(rng.randint(0, 9)), float(rng.randint(0, 1))) for _ in range(60)]
    attr = [("a", "A1", 1), ("a", "A2", 0), ("b", None, 3), ("b", None, 2), (None, "N", 9)]
    return (fact, cost, ratio, attr,
            spark.createDataFrame(fact, "id int, k string, g string, p string, cp string"),
            spark.createDataFrame(cost, "key string, period string, c double"),
            spark.createDataFrame(ratio, "key string, grp string, month string, n double, d double"),
            spark.createDataFrame(attr, "key string, name string, rank int"))


def fused_lookups(cost, ratio, attr):
    return [Value(attr, {"k": "key"}, {"name": "name", "rank": "rank"}),
            Series(cost, {"k": "key"}, "mean", "c", exact={"exact_c": "cp"}, latest={"latest_c": "p"}),
            Series(cost, {"k": "key"}, "sum", "c", exact={"sum_c": "p"}),
            Series(ratio, {"k": "key", "g": "grp"}, "ratio", "n", "d", "month", exact={"exact_r": "p"}, latest={"latest_r": "p"})]


def test_values_against_a_loop(made):
    fact, cost, ratio, attr, f, c, r, a = made
    got = {row.id: row for row in attach(f, fuse(fused_lookups(c, r, a))).collect()}
    assert len(got) == len(fact)

    def mean(rows):
        rows = [x for x in rows if x is not None]
        return sum(rows) / len(rows) if rows else None

    for i, k, g, p, cp in fact:
        own = [x for x in cost if k is not None and x[0] == k and x[1] is not None]
        months = sorted({x[1] for x in own if p is not None and x[1] <= p})
        values = lambda m: [x[2] for x in own if x[1] == m]
        row = got[i]
        assert row.exact_c == (mean(values(cp)) if cp is not None else None)
        assert row.latest_c == (mean(values(months[-1])) if months else None)
        summed = [x for x in values(p) if x is not None] if p is not None else []
        assert row.sum_c == (sum(summed) if summed else None)
        rows = [x for x in ratio if None not in (k, g) and x[:2] == (k, g)]
        share = lambda m: ((lambda d: sum(x[3] for x in rows if x[2] == m) / d if d else None)
                           (sum(x[4] for x in rows if x[2] == m)))
        upto = sorted({x[2] for x in rows if p is not None and x[2] <= p})
        assert row.latest_r == (share(upto[-1]) if upto else None)
        assert row.exact_r == (share(p) if p is not None else None)
        best = max(((x[1] or "", x[2]) for x in attr if k is not None and x[0] == k), default=None)
        assert (row["name"] or "", row["rank"]) == (best if best else ("", None))


def test_a_lookup_may_key_the_next_and_missing_keys_raise(spark):
    fact = spark.createDataFrame([(1, "a")], "id int, k string")
    one = spark.createDataFrame([("a", "m")], "key string, model string")
    two = spark.createDataFrame([("m", 7)], "model string, v int")
    both = [Value(two, {"model": "model"}, {"v": "v"}), Value(one, {"k": "key"}, {"model": "model"})]
    assert [tuple(r) for r in attach(fact, fuse(both)).select("id", "model", "v").collect()] == [(1, "m", 7)]
    with pytest.raises(ValueError):
        attach(fact, fuse(both[:1]))


def test_empty_lookups_and_clashing_columns(made):
    *_, f, c, r, a = made
    out = attach(f.withColumn("period", F.lit("own")).withColumn("c", F.lit(3)), fuse(fused_lookups(c.limit(0), r.limit(0), a.limit(0))))
    assert out.count() == 400 and out.where("exact_c IS NOT NULL OR latest_r IS NOT NULL OR name IS NOT NULL").isEmpty()
    assert {(x["period"], x["c"]) for x in out.select("period", "c").distinct().collect()} == {("own", 3)}


def test_one_exchange_of_the_fact_per_key_set(spark, made):
    """With broadcasts off, the fact is shuffled once per key set, however many lookups share it."""
    *_, f, c, r, a = made
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        fused = fuse(fused_lookups(c, r, a) + [Series(c, {"k": "key"}, "max", "c", exact={f"more{i}": "p"}) for i in range(9)])
        assert len(fused) == 2
        alone = sum(exchanges(x.table) for x in fused)
        assert exchanges(attach(f, fused)) <= alone + 2 + 2  # fact and table of each key set
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_enrichment_has_all_lookups_in_six_joins(spark):
    t = tables(spark, SF_SMALL)
    fused = lookups(t)
    assert len(fused) == 6
    # the two sources' simulation series count once each per shape, exact and latest apart, as joins of the rules do
    assert sum(len(f.values) + sum(bool(s.exact) + bool(s.latest) for s in f.series) for f in fused) >= 25
    plan = QUERIES["enriched_monthly"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") <= 6 + 4 + 4  # fused sets of D23 and of D10, the credit-note rules


def test_every_candidate_and_waterfall_arm_has_values(spark):
    row = QUERIES["candidate_costs"](spark, SF_SMALL).agg(*[F.count(c).alias(c) for c in GP.CANDIDATES]).first()
    assert not [c for c in GP.CANDIDATES if row[c] == 0]
    costs = QUERIES["cost_waterfall"](spark, SF_SMALL).agg(F.count("hq_asc"), F.count("hq_asc_fxdiff"), F.sum((F.col("hq_asc") != F.col("hq_asc_fxdiff")).cast("int"))).first()
    assert min(costs) > 0
