"""Rules that earlier versions broke: ids at size, keyed writes, failures that must show, ties."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.dates import add_months_period, serial_or_text_date
from ledgerlake.functions.text import zero_pad
from ledgerlake.operators import asof, catalog, writers
from ledgerlake.operators.setops import restatement
from ledgerlake.sources.files import read_matrix_sheet
from ledgerlake.sources.snapshot import read_self_snapshot
from ledgerlake.streaming.arrival import replace_batch


def test_dense_index_at_a_million_rows_with_payload(spark):
    n = 1_000_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"), F.concat(F.lit("payload "), F.col("id")).alias("text"))
    out = catalog.dense_index(df, ["k"], "i").agg(F.count_distinct("i"), F.min("i"), F.max("i")).first()
    assert tuple(out) == (n, 1, n)


def test_upsert_past_the_pad_width(spark):
    old = spark.createDataFrame([("a", "999998", "x")], "k string, id string, v string")
    new = spark.createDataFrame([(f"n{i:02d}", "y") for i in range(30)] + [("a", "z")], "k string, v string")
    rows = {r["k"]: r["id"] for r in catalog.surrogate_upsert(old, new, ["k"], "id").collect()}
    assert len(rows) == len(set(rows.values())) == 31 and rows["a"] == "999998"
    assert sorted(map(int, rows.values())) == list(range(999998, 1000029))
    assert spark.range(1).select(zero_pad(F.lit(1234567))).first()[0] == "1234567"


def test_first_in_group_flags_one_of_ties(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 1, "q"), ("a", 1, "p"), ("b", None, "r"), ("b", 2, "s"), (None, 5, "t"), (None, 5, "t")],
                               "k string, o int, v string")
    rows = asof.first_in_group(df, ["k"], "o").collect()
    assert len(rows) == 7
    assert sorted((r["k"] or "", r["o"], r["v"]) for r in rows if r["is_first"]) == [("", 5, "t"), ("a", 1, "p"), ("b", 2, "s")]


def test_asof_attach_never_fans_out(spark):
    fact = spark.createDataFrame([("a", "202403")], "k string, period string")
    table = spark.createDataFrame([("a", "202401", 1.0), ("a", "202401", 2.0)], "k string, period string, value double")
    assert [r["v"] for r in asof.asof_attach(fact, table, {"k": "k"}, "period", "value", "v").collect()] == [2.0]


def test_dates_that_are_none(spark):
    row = spark.range(1).select(add_months_period(F.lit("000000"), 1), add_months_period(F.lit("202312"), 1), serial_or_text_date(F.lit("1e12")),
                                serial_or_text_date(F.lit("45000")), serial_or_text_date(F.lit("NaN"))).first()
    assert (row[0], row[1], row[2], str(row[3]), row[4]) == (None, "202401", None, "2023-03-15", None)


def test_restatement_keeps_null_periods(spark):
    a = spark.createDataFrame([("202401", 1), ("202402", 2), (None, 3)], "period string, v int")
    b = spark.createDataFrame([("202402", 9)], "period string, v int")
    assert sorted(r["v"] for r in restatement(a, b).collect()) == [1, 3, 9]


def test_self_snapshot_shows_damage(spark, scratch):
    assert read_self_snapshot(spark, f"{scratch}/absent") is None
    import os
    os.makedirs(f"{scratch}/bad")
    with open(f"{scratch}/bad/part-0.parquet", "wb") as f:
        f.write(b"not a table")
    with pytest.raises(Exception):
        read_self_snapshot(spark, f"{scratch}/bad").collect()


def test_full_replace_restores_on_failure(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    writers.full_replace(spark.range(3), path)
    real, calls = writers._rename, []

    def failing(fs, source, target):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("no")
        real(fs, source, target)
    monkeypatch.setattr(writers, "_rename", failing)
    with pytest.raises(OSError):
        writers.full_replace(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3


def test_write_by_key_replaces_and_empties_partitions(spark, scratch):
    path = f"{scratch}/keyed"
    old = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d1"), ("c", 3, "d2"), ("d", 4, "d3")], "k string, v int, ds string")
    writers.write_by_key(old, path, ["k"])
    new = spark.createDataFrame([("a", 10, "d4"), ("c", 30, "d4"), ("c", 31, "d4")], "k string, v int, ds string")
    for _ in range(2):
        writers.write_by_key(new, path, ["k"])
        assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "ds").collect()) == [
            ("a", 10, "d4"), ("b", 2, "d1"), ("c", 30, "d4"), ("c", 31, "d4"), ("d", 4, "d3")]


def test_a_repeated_batch_does_not_double(spark, scratch):
    handle = replace_batch(f"{scratch}/out")
    for batch, n in ((0, 5), (1, 7), (1, 7)):
        handle(spark.range(n).toDF("v"), batch)
    assert spark.read.parquet(f"{scratch}/out").count() == 12


def test_matrix_sheet_by_place(spark, scratch):
    with open(f"{scratch}/m.csv", "w") as f:
        f.write('RATES,,\nmonth,"US, D",EUR\n202401,"1,5",2\nRATES,3,4\nmonth,5,6\n')
    rows = sorted(tuple(r) for r in read_matrix_sheet(spark, f"{scratch}/m.csv").collect())
    assert rows == [("202401", "1,5", "2", "RATES"), ("RATES", "3", "4", "RATES"), ("month", "5", "6", "RATES")]


def test_like_join_equals_brute_force_without_a_bound(spark):
    from ledgerlake.operators.lookup import like_join
    texts = ["red bolt 12", "RED BOLT", "", None, "a%b", "axb", "ab", "日本語の鋼", "x😀y", "red bolt 12", "long " * 3000 + "tail", "back\\slash",
             "line\nbreak"]
    pats = ["%bolt%", "red%", "%", "___", "_", "", None, "a\\%b", "a_b", "%本語%", "%😀%", "%bolt%", "%tail", "long long long%", "back%",
            "%e\nb%", "%B_LT", "%12"]
    facts = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rules = spark.createDataFrame(list(enumerate(pats)), "j int, p string")

    def like(t, p):
        return re.fullmatch("".join({"%": ".*", "_": "."}.get(m, re.escape(m[-1])) for m in re.findall(r"\\.|.", p, re.S)), t, re.S)

    want = sorted((i, j) for i, t in enumerate(texts) for j, p in enumerate(pats) if t is not None and p is not None and like(t, p))
    for gram in (1, 3, 8):
        got = like_join(facts, "t", rules, "p", gram=gram)
        assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.i, r.j) for r in got.collect()) == want
    left = like_join(facts, "t", rules, "p", how="left").collect()
    assert sorted((r.i, r.j) for r in left if r.j is not None) == want
    assert {r.i for r in left if r.j is None} == set(range(len(texts))) - {i for i, _ in want}
    assert like_join(facts, "t", rules.limit(0), "p").isEmpty()
    assert like_join(facts, "t", rules.limit(0), "p", how="left").count() == len(texts)


def test_cpugpu_gap_by_hand(spark):
    from ledgerlake.plans.pricegap import cpugpu_gap, cpugpu_gap_by_part
    quotes = spark.createDataFrame([
        ("01a", "nb", "202401", 10.0, "B"), ("01a", "nb", "202401", 20.0, "B"), ("01a", "nb", "202402", 30.0, "B"),
        ("01a", "nb", "202404", 99.0, "B"), ("02b", "nb", "202402", 7.0, "B"), ("02b", "nb", "202401", 1.0, "C"), ("03c", "nb", "202401", 5.0, "B")],
        "item_no string, product_no string, group_no string, po_price double, buying_mode string").withColumn(
            "po_price", F.col("po_price").cast("decimal(18,2)"))
    report = spark.createDataFrame([
        ("NB", "01a", "202401", "80", "120", "2", "2"), ("NB", "01a", "202312", "1", "1", "1", "2"), ("NB", "01a", "202401", "9", "9", "9", "1")],
        "product_line string, item_no string, gl_yearmonth string, net_sale_amount string, material_cost string, quantity string, ds string")
    fx = spark.createDataFrame([("NB", "202401", 2.0), ("NR", "202401", 5.0)], "product_line string, period string, fx_rate double").withColumn(
        "fx_rate", F.col("fx_rate").cast("decimal(17,7)"))
    pac = spark.createDataFrame([("NB", "01a", "202401", 50.0, "1"), ("NB", "02135x", "202401", 3.0, "1"), ("NB", "01a", "202402", 1.0, "1")],
                                "product_line string, pn string, period string, pac double, ds string")
    history = spark.createDataFrame([("NB", "C.S", "02b", "202312", 4.0, 6.0, None, "1"), ("NB", None, "03c", "202312", 1.0, 2.0, 3.0, "1")],
                                    "product_line string, category string, item_no string, period string, equo_price double, "
                                    "cogs_price double, pac double, ds string")
    gap = cpugpu_gap(quotes, report, fx, pac, history)
    got = {(r.item_no, r.category, r.period): (r.equo_price, r.cogs_price, r.pac, r.rebate, r.bs_gap) for r in gap.collect()}
    none = (None,) * 5
    assert got == {
        ("01a", "CPU", "202312"): none,
        ("01a", "CPU", "202401"): (20.0, 30.0, 50.0, 20.0, 10.0),  # the first month takes the report's price
        ("01a", "CPU", "202402"): (30.0, 30.0, 50.0, 20.0, 0.0),
        ("02b", "C.S", "202312"): (4.0, 6.0, None, None, 2.0),
        ("02b", "C.S", "202401"): (4.0, 6.0, None, None, 2.0),  # carried forward
        ("02b", "C.S", "202402"): (4.0, 6.0, None, None, 2.0),  # first month, not in the report: stored value
        **{("03c", None, m): none for m in ("202312", "202401", "202402")},  # no category: matches nothing
        **{(None, "CPU", m): none for m in ("202312", "202401", "202402")}}  # standard price alone: no line, no item
    parts = spark.createDataFrame([("01a", "90NB1", 2.0), ("01a", "90NR1", 9.0), ("02b", "90NB1", None)],
                                  "item_no string, part_number string, kp_qty double")
    by = {r.period: r for r in cpugpu_gap_by_part(gap, parts).collect() if r.part_number == "90NB1"}
    assert float(by["202401"].cpu_gap) == 20 and float(by["202401"].cpu_rebate) == 40 and float(by["202401"].gpu_gap) == 0
    assert {r.part_number for r in cpugpu_gap_by_part(gap, parts).collect()} == {"90NB1", None}


def test_credit_note_rate_by_hand(spark):
    from ledgerlake.plans.ingest import credit_note_rate
    rates = spark.createDataFrame([
        (" accraw ", "NB", "OU1", "F", "202401", 0.01), ("ACIRAW", "NB", "US", "ACI-Retail", "202401", 0.02),
        ("ACIRAW", "NB", "CA", "Walmart-CA", "202401", 0.03), ("ACIRAW", "NB", "SA", "Other Channel 1", "202401", 0.04),
        ("ACIRAW", "NB", "SA", "Other Channel 2", "202401", 0.05), ("ACIRAW", "NB", "US", "Channel-SA", "202401", None)],
        "source string, product_line string, legal_entity string, channel_code string, period string, cn double").withColumn(
            "cn", F.col("cn").cast("decimal(8,4)"))
    rows = [  # source, ou, distribution, business, branch2, customer, country, wanted
        ("ACCRAW", "OU1 ", "F", "REFURBISH", "ACI-Retail", "Walmart", "CA", 0.01),  # the literal rule is the USD source's
        ("ACCRAW", "OU2", "F", "x", "ACI-Retail", "Walmart", "CA", None),
        ("ACIRAW", "OU1", "F", " refurbish", "ACI-Retail", "Walmart", "CA", 0),
        ("ACIRAW", "OU1", "F", "x", "ACI-Retail", "Walmart", "CA", 0.02),
        ("ACIRAW", "OU1", "F", None, "Walmart-CA", "Walmart", "CA", 0.03),  # not among the retail channels: third rule
        ("ACIRAW", "OU1", "F", "x", "Other Channel 1", "Shop", "SA", 0.05),  # repeated key: the greatest
        ("ACIRAW", "OU1", "F", "x", "Channel-SA", None, "SA", 0.05),  # a rule with an empty rate passes on
        ("ACIRAW", "OU1", "F", "x", None, None, None, None)]
    fact = spark.createDataFrame([(i, *r[:-1], "NB", "202401") for i, r in enumerate(rows)],
                                 "i int, source string, ou string, distribution_type string, business_type string, branch2 string, "
                                 "customer string, country_code string, product_line_id string, period string")
    got = credit_note_rate(fact, rates, F.col("ou"), F.col("branch2"), F.col("customer")).orderBy("i").collect()
    assert [None if r.cn is None else float(r.cn) for r in got] == [r[-1] for r in rows]


def test_cost_period_by_hand(spark):
    from ledgerlake.plans.ingest import NEWEST_FIRST, cost_period
    ranges = spark.createDataFrame([(" p1", "202401 ", "202312"), ("p1", "202402", None), ("p1", "202401", "202311")],
                                   "pn string, version string, cost_range string")
    rows = [("ACCRAW", "nb", "p1", "202401", "202312"), ("ACCRAW", "NR", "p1", "202401", NEWEST_FIRST),
            ("ACIRAW", "NR", "p1 ", "202401", "202312"), ("ACIRAW", "XX", "p1", "202401", NEWEST_FIRST),
            ("ACIRAW", "NB", "p1", "202402", NEWEST_FIRST), ("ACIRAW", "NB", None, "202401", NEWEST_FIRST)]
    fact = spark.createDataFrame([(i, *r[:-1]) for i, r in enumerate(rows)],
                                 "i int, source string, product_line_id string, part_number string, period string")
    got = cost_period(fact, ranges).orderBy("i").collect()
    assert [r.cost_period for r in got] == [r[-1] for r in rows]


def test_self_snapshot_knows_its_newest_folder_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "20240101"), (2, "20240102"), (3, "20240102"), (4, None)], "a int, ds string")
    df.write.partitionBy("ds").parquet(path)
    (tmp_path / "t" / "ds=20240103").mkdir()  # a copy without files is none
    got = read_self_snapshot(spark, path, schema=df.schema)
    assert "ubquery" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.a for r in got.collect()} == {2, 3}
    plain = str(tmp_path / "plain")
    df.write.parquet(plain)
    assert {r.a for r in read_self_snapshot(spark, plain).collect()} == {2, 3}
