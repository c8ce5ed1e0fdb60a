"""Operator semantics on hand-written rows (NULL keys, duplicates, zero divisors,
negative quantities, blank text, empty inputs)."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import money as M
from ledgerlake.functions.dates import normalize_period, period_quarter
from ledgerlake.operators import asof as W
from ledgerlake.operators import lookup as L
from ledgerlake.operators import rules as R
from ledgerlake.operators import setops as U
from ledgerlake.operators import spine as S
from ledgerlake.operators.catalog import dense_index
from ledgerlake.operators.cleanse import dedupe_columns, drop_blank_columns, enforce_contract, normalize_names
from ledgerlake.plans import grossprofit as GP


def _key(r):
    return tuple((x is None, str(x)) for x in r)


def srt(items):
    return sorted((tuple(r) for r in items), key=_key)


def rows(df, *cols):
    return srt(df.select(*cols).collect())


def test_dedupe_lookup_last_wins_on_trimmed_key(spark):
    lk = spark.createDataFrame([(" a ", "x", 1), ("a", "y", 2), ("b", "z", 1)], "k string, v string, o int")
    out = L.dedupe_lookup(lk, ["k"], ["v"], order_by=["o"])
    assert rows(out, "k", "v") == [("a", "y"), ("b", "z")]


def test_star_enrich_keeps_fact_row_count(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, k string")
    lk = spark.createDataFrame([("a", 10), ("a", 11), (None, 99)], "k string, v int")
    out = L.star_enrich(fact, [L.LookupSpec(lk, {"k": "k"}, {"v": "v"})])
    assert out.count() == 3
    assert rows(out, "id", "v") == srt([(1, 11), (2, 11), (3, None)])   # NULL key never matches


def test_override_cascade_later_rule_wins(spark):
    df = spark.createDataFrame([("x", "US", "RETAIL"), ("x", "CA", "RETAIL"), ("y", None, None)],
                               "base string, rc string, sg string")
    expr = R.override_cascade(F.col("base"), [((F.col("rc") == "US") & (F.col("sg") == "RETAIL"), F.lit("US-Retail")),
                                             (F.col("rc") == "CA", F.lit("CA"))])
    assert rows(df.select(expr.alias("b")), "b") == srt([("CA",), ("US-Retail",), ("y",)])


def test_category_waterfall_longest_prefix_first(spark):
    df = spark.createDataFrame([("GDDR6 X",), ("LP5",), ("XBRA",), ("PLAIN",)], "d string")
    cat = R.category_waterfall([(F.col("d").like("%BRA%"), "BR")], None, "d", {"G": "GPU", "GDDR": "DDR", "LP": "DDR"},
                               "SSD")
    assert rows(df.select("d", cat.alias("c")), "d", "c") == [("GDDR6 X", "DDR"), ("LP5", "DDR"), ("PLAIN", "SSD"),
                                                              ("XBRA", "BR")]


def test_period_normalise_and_quarter_of_blank(spark):
    df = spark.createDataFrame([("2024-3",), ("  ",), ("202412",)], "p string")
    out = df.select(normalize_period("p").alias("n")).select("n", period_quarter("n").alias("q"))
    assert rows(out, "n", "q") == [("000000", "Q4"), ("202412", "Q4"), ("202430", "Q4")]


def test_fx_ratio_zero_and_null_rate(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("0")), (Decimal("10.00"), None), (Decimal("9.00"), Decimal("3"))],
                               "a decimal(10,2), r decimal(10,2)")
    assert [r[0] for r in df.select(M.ratio("a", "r")).collect()] == [None, None, 3.0]


def test_guard_negative_quantity(spark):
    df = spark.createDataFrame([(Decimal("-2"),), (Decimal("3"),)], "q decimal(10,2)")
    out = df.select(M.guard_negative("q", M.mul("q", F.lit(Decimal("1.5")))).alias("v"))
    assert sorted(r[0] for r in out.collect()) == [Decimal("0E-15"), Decimal("4.500000000000000")]


def test_asof_attach_matches_brute_force(spark):
    fact = spark.createDataFrame([("p", "202401"), ("p", "202403"), ("p", "202312"), ("q", "202402"), (None, "202402")],
                                 "k string, period string")
    table = spark.createDataFrame([("p", "202401", 1.0), ("p", "202402", 2.0), ("q", "202403", 3.0)],
                                  "k string, period string, c double")
    out = W.asof_attach(fact, table, {"k": "k"}, "period", "c", "v")
    assert rows(out, "k", "period", "v") == srt([("p", "202401", 1.0), ("p", "202403", 2.0), ("p", "202312", None),
                                                 ("q", "202402", None), (None, "202402", None)])


def test_latest_per_key_ties_are_deterministic(spark):
    df = spark.createDataFrame([("a", "202401", 1), ("a", "202402", 5), ("a", "202402", 7)], "k string, p string, v int")
    assert rows(W.latest_per_key(df, ["k"], "p", ["v"]), "k", "p", "v") == [("a", "202402", 7)]


def test_period_accumulate_empty_batch_keeps_history(spark):
    hist = spark.createDataFrame([("202401", 1), ("202402", 2)], "period string, v int")
    empty = hist.where(F.lit(False))
    assert U.period_accumulate(hist, empty).count() == 2
    new = spark.createDataFrame([("202402", 9)], "period string, v int")
    assert rows(U.period_accumulate(hist, new), "period", "v") == [("202401", 1), ("202402", 9)]


def test_restatement_empty_monthly_keeps_weekly(spark):
    weekly = spark.createDataFrame([("202401", 1)], "period string, v int")
    monthly = weekly.where(F.lit(False))
    assert U.restatement(weekly, monthly).count() == 1


def test_skeleton_is_a_generator_not_a_cartesian_product(spark):
    items = spark.createDataFrame([("a",), ("b",)], "item string")
    periods = spark.createDataFrame([("202401",), ("202402",), (None,)], "period string")
    sk = S.period_skeleton(items, periods)
    assert sk.count() == 4
    plan = sk._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_carry_forward_order(spark):
    skel = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "3")], "k string, period string")
    cur = spark.createDataFrame([("a", "3", 30.0)], "k string, period string, v double")
    hist = spark.createDataFrame([("a", "1", 10.0), ("a", "2", 20.0), ("b", "2", 5.0)], "k string, period string, v double")
    out = S.carry_forward(skel, cur, hist, ["k"], "period", ["v"])
    assert rows(out, "k", "period", "v") == [("a", "1", 10.0), ("a", "2", 20.0), ("a", "3", 30.0)]


def test_cost_waterfall_order_per_source_and_mode(spark):
    names = [c for c in GP.CANDIDATES if not c.endswith(("_ex", "_fxdiff"))]
    ranks = {c: float(i) for i, c in enumerate(GP.COST_WATERFALL["hq_asc"]["ACCRAW", "exact"])} | {
        "aci_cost_item_cost_usd": 20.0, "hq_model_cpu_branch_item_cost_usd": 30.0}
    full, none = [ranks[c] for c in names], [None] * len(names)
    without = [None if c.startswith(("item_cost_usd_hqpn", "aci_")) else ranks[c] for c in names]
    data = [("ACCRAW", "199601", *full), ("ACCRAW", "由新到舊", *full), ("ACIRAW", "199601", *full), ("ACIRAW", None, *full),
            ("ACCRAW", "199601", *without), ("ACCRAW", "由新到舊", *without), ("ACIRAW", "由新到舊", *without),
            ("ACCRAW", None, *full), ("ACCRAW", "199601", *none), ("OTHER", "199601", *full)]
    df = spark.createDataFrame(data, "source string, cost_period string, " + ", ".join(f"{c} double" for c in names))
    out = [r[0] for r in df.select(GP.cost_waterfall("hq_asc")).collect()]
    assert out == [0.0, 1.0, 20.0, 20.0, 2.0, 3.0, 30.0, None, None, None]


def test_contract_and_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF(" A x", "b", "b")
    assert dedupe_columns(df).columns == [" A x", "b"]
    assert normalize_names(dedupe_columns(df)).columns == ["a_x", "b"]
    out = enforce_contract(normalize_names(dedupe_columns(df)), ["b", "missing"])
    assert out.columns == ["b", "missing"] and out.first()["missing"] is None


def test_drop_blank_columns_and_unnamed(spark):
    df = spark.createDataFrame([("x", " ", "1")], "a string, b string, `Unnamed: 2` string")
    assert drop_blank_columns(df).columns == ["a"]


def test_dense_index_is_consecutive(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    out = dense_index(df, ["k"], "i")
    got = sorted(tuple(r) for r in out.collect())
    assert [r[1] for r in got] == list(range(1, 1001))


def test_keyword_exclude_keeps_null(spark):
    df = spark.createDataFrame([("RTN x",), (None,), ("ok",)], "t string")
    assert rows(R.keyword_exclude(df, "t", ["rtn"]), "t") == srt([(None,), ("ok",)])
