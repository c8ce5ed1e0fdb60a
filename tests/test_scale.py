"""Work per row and per task at larger sizes: what is joined, carried and read, on rows built here."""

from pyspark.sql import functions as F

from ledgerlake.plans import pricegap as PG


def test_a_group_meets_its_items_once_however_many_gaps_it_has(spark):
    """60 gaps of a group and 2 finished parts per item: 7 items, not 60 * 14 joined rows."""
    gap = spark.createDataFrame([(g, str(p)) for g in ("AG1", None, "AG9") for p in range(60)], "ag_no string, period string")
    pairs = spark.createDataFrame([(a, f"i{i}", f"p{k}") for a in ("AG1", "AG2", None) for i in range(7) for k in (1, 2)],
                                  "ag_no string, item_no string, part_number string")
    cpu = spark.createDataFrame([("c1",), ("c1",), ("i1",)], "item_no string")
    incentive = spark.createDataFrame([("o1", "2"), ("old", "1")], "os_part_number string, ds string")
    out = PG.explode_item_list(gap, cpu, pairs, incentive)
    assert sorted((r[0] for r in out.collect()), key=str) == sorted([*(f"i{i}" for i in range(7)), "c1", "o1", None], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join LeftOuter"):]
    assert join.count("Aggregate") >= 2  # both sides of the join are distinct


def test_stored_values_meet_items_before_the_periods_repeat_them(spark):
    """The latest stored values are joined to 2 items, not to 2 items * 3 periods; a NULL key and a repeated stored row
    keep their SQL meaning."""
    from ledgerlake.operators import spine as S

    now = spark.createDataFrame([("a", "x", "202403", 9.0), (None, "x", "202403", 8.0)], "k string, g string, period string, v double")
    stored = spark.createDataFrame([("a", "x", "202401", 1.0), ("a", "x", "202402", 2.0), ("a", "x", "202402", 3.0), (None, "x", "202402", 4.0)],
                                   "k string, g string, period string, v double")
    out = PG.gap_history(now, stored, ["k", "g"], ["v"])
    # two stored rows of the last month: each fills the periods, and both meet themselves in their own month
    want = [("a", "202401", 1.0)] * 2 + [("a", "202402", 2.0)] * 2 + [("a", "202402", 3.0)] * 2 + [("a", "202403", 9.0)] * 2
    want += [(None, m, None) for m in ("202401", "202402", "202403")]
    assert sorted(map(str, ((r.k, r.period, r.v) for r in out.collect()))) == sorted(map(str, want))
    items = S.key_union([now, stored], ["k", "g"])
    plain = S.carry_forward(S.period_skeleton(items, now.select("period").union(stored.select("period"))), now, stored, ["k", "g"], "period", ["v"])
    assert sorted(map(str, plain.collect())) == sorted(map(str, out.collect()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Join LeftOuter")  # a join lies below the periods


def test_the_report_is_read_for_its_newest_month_once(spark):
    """Both gap models read one stored month, not the report once for every maximum and use."""
    from paths import SF_SMALL

    from ledgerlake.plans import q_marts
    from ledgerlake.sources.adapters import MartTables

    t = MartTables(spark, SF_SMALL)
    for gap in (q_marts.kp_now, q_marts.cg_now, q_marts.kp_gap, q_marts.cg_gap):
        gap(t)
    assert q_marts.newest_report(t).select("gl_yearmonth").distinct().count() == 1
    assert not [f for f in q_marts.newest_report(t).inputFiles() if "lineitem" in f]


def test_files_of_parts_follow_their_rows(spark, scratch):
    """A part table in one small file is stored as several, so that no task makes, sorts or reads all months of all parts."""
    from ledgerlake.sources.adapters import PARTS_A_FILE, MartTables, spread

    n = 2 * PARTS_A_FILE + 5
    spark.range(n).select(F.col("id").alias("p_partkey"), F.lit("a nut").alias("p_name"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"),
                          F.lit(1).alias("p_size"), F.lit(1.5).alias("p_retailprice")).coalesce(1).write.parquet(f"{scratch}/part.parquet")
    stored = MartTables(spark, scratch)["part_attr"]
    assert len(stored.inputFiles()) == 3 and stored.count() == n and stored.agg(F.count_distinct("part_number")).first()[0] == n
    assert spread(spark.range(5).coalesce(1), 10).rdd.getNumPartitions() == 1


def test_one_numeric_value_per_key_needs_no_sort(spark):
    from ledgerlake.operators.lookup import dedupe_lookup

    rows = [("a ", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 2.0), (None, 5.0)]
    out = dedupe_lookup(spark.createDataFrame(rows, "k string, v double"), ["k"], ["v"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", 3.0), ("b", None), (None, 5.0)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_tables_keep_wide_projections_out_of_one_method(spark, scratch):
    from ledgerlake.sources.adapters import MartTables

    kept = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        MartTables(spark, scratch)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", kept)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_of_parts_are_not_broadcast(spark):
    """However small their files: the joins of quotes, component map and rebates shuffle; rows without a partner keep
    their SQL meaning."""
    from paths import SF_SMALL

    from ledgerlake.sources.adapters import MartTables

    result = spark.createDataFrame([("NB", "p1", "m", "20240101"), ("NV", "p2", "m", "20240101"), ("NV", None, "m", "20240101")],
                                   "product_line string, part_number string, model_name string, ds string")
    pairs = spark.createDataFrame([("i1", "p1"), ("i1", "p1"), ("i2", "p2"), ("i3", None)], "item_no string, part_number string")
    rebate = spark.createDataFrame([("i1", "NB", "c", 1.0, "202401", "20240101"), ("i2", "NV", "c", None, "202401", "20240101"),
                                    ("i1", "NB", "c", 9.0, "202401", "20231231"), (None, "NV", "c", 3.0, "202401", "20240101")],
                                   "item_no string, product_line string, cpu string, extra_rebate double, period string, ds string")
    extra = PG.extra_rebate(result, pairs, rebate)
    assert [(r.part_number, r.extra_rebate) for r in extra.collect()] == [("p1", 1.0)]
    sellout = PG.sellout_rebate(result, pairs, rebate.withColumnRenamed("extra_rebate", "reb").withColumn("product_line", F.lit("NV")))
    assert sellout.count() == 0
    lazy = MartTables(spark, SF_SMALL, materialize=False)
    for df in (extra, sellout, lazy["quotes"], lazy["bom"]):
        assert "SortMergeJoin" in executed(df) and "BroadcastExchange" not in executed(df)
    tables = MartTables(spark, SF_SMALL)
    tables["cost_branch"]
    branches = tables.memo("fact_branches", None)
    assert branches.count() == tables["fact_sales"].select("period", "branch").distinct().count()
    assert not [f for f in branches.inputFiles() if "lineitem" in f]


def test_history_is_not_moved_to_its_periods(spark):
    """The batch's periods go to the history's rows; a NULL period of either side finds nothing."""
    from ledgerlake.plans.grossprofit import accumulate
    from ledgerlake.sources.adapters import ACCUM_CONTRACT

    def rows(*periods):
        return spark.createDataFrame([(p, "1") for p in periods], "period string, ds string").select(
            *[F.col("period") if c == "period" else F.lit("x").alias(c) for c in ACCUM_CONTRACT], "ds")

    batch = rows("202402", None)
    grouped = batch.groupBy(*ACCUM_CONTRACT).count().drop("count")  # a batch of unknown size
    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = accumulate(rows("202401", "202402", "202402", None), grouped, "20240201", F.lit("now"))
        assert "SortMergeJoin" not in executed(out)
        assert sorted(r.period or "" for r in out.collect()) == ["", "", "202401", "202402"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)


def test_sales_rows_travel_without_what_is_derived_from_them(spark):
    """The tables per part are joined first (the lowest join): rates, freight and names of customers come after."""
    from paths import SF_SMALL

    from ledgerlake.plans.q_gross import local
    from ledgerlake.sources.adapters import MartTables

    for monthly in (False, True):
        plan = local(MartTables(spark, SF_SMALL), monthly)._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.split("\n") if "Join LeftOuter" in line and "__k_" in line]
        assert len(joins) == 3 and "part_number" in joins[-1] and "part_number" not in "".join(joins[:-1])
        assert "Walmart" not in plan[plan.index(joins[-1]):]


def test_stored_rows_go_to_their_folders_without_a_sort(spark, scratch, monkeypatch):
    """Tasks keep the folders of all values open, or sort what is left; all rows come back, the session's setting too, and
    repeated text is compressed."""
    import os

    import pyarrow.parquet as pq
    from pyspark.sql import DataFrameWriter

    from ledgerlake.operators import versioned

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(int(spark.conf.get(key))), write(self, *a, **k))[1])
    rows = spark.range(0, 700, 1, 2).select("id", F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("string")).alias("period"),
                                            F.lit("0123456789" * 20).alias("text"))
    before = spark.conf.get(key)
    for most in (versioned.OPEN_FOLDERS, 2):
        monkeypatch.setattr(versioned, "OPEN_FOLDERS", most)
        table = versioned.VersionedTable(spark, f"{scratch}/t{most}", "period")
        table.replace_all(rows)
        assert sorted(map(str, table.read().collect())) == sorted(map(str, rows.collect()))
        assert sorted(e["rows"] for e in table.manifest()["partitions"].values()) == [100] * 7
    assert seen == [96, 2] and spark.conf.get(key) == before
    files = [f"{d}/{f}" for d, _, names in os.walk(scratch) for f in names if f.endswith(".parquet")]
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files} == {"ZSTD"}


def test_fused_lookups_are_summed_by_hash(spark):
    """No sort of all stacked rows and no window; the greatest text, the periods of a source shared by its values."""
    from ledgerlake.operators.fusion import Series, attach, fuse

    rows = spark.createDataFrame([("a", "202401", 1.0, "x", 3), ("a", "202401", 2.0, "y", None), ("a", "202403", None, None, 5), ("b", None, 1.0, "z", 1),
                                  (None, "202401", 9.0, "n", 9)], "k string, p string, v double, t string, n int")
    fused = fuse([Series(rows, {"k": "k"}, "sum", "v", period="p", exact={"v": "month"}, latest={"last_v": "month"}),
                  Series(rows, {"k": "k"}, "max", "n", period="p", exact={"n": "month"}),
                  Series(rows, {"k": "k"}, "mean", "n", period="p", latest={"mean_n": "month"})])
    plan = executed(fused[0].table)
    assert "Window" not in plan and "SortAggregate" not in plan
    assert [c for c in fused[0].table.columns if c.startswith("__p")] == ["__p0"]
    fused += fuse([Series(rows, {"k": "k"}, "max", "t", period="p", exact={"t": "month"}, latest={"last_t": "month"})])
    fact = spark.createDataFrame([("a", "202401"), ("a", "202402"), ("a", "202409"), ("a", "2024"), ("a", None), ("b", "202401"), (None, "202401")], "k string, month string")
    out = {(r.k, r.month): (r.v, r.last_v, r.n, r.mean_n, r.t, r.last_t) for r in attach(fact, fused).collect()}
    none = (None,) * 6
    assert out == {("a", "202401"): (3.0, 3.0, 3, 3.0, "y", "y"), ("a", "202402"): (None, 3.0, None, 3.0, None, "y"),
                   ("a", "202409"): (None, None, None, 5.0, None, None), ("a", "2024"): none, ("a", None): none, ("b", "202401"): none,
                   (None, "202401"): none}
    by_number = fuse([Series(rows.where("v > 0"), {"k": "k"}, "max", "t", period="n", exact={"t": "at"}, latest={"last_t": "at"})])
    fact = spark.createDataFrame([("a", 2), ("a", 3), ("a", 4)], "k string, at int")
    assert [(r.at, r.t, r.last_t) for r in attach(fact, by_number).orderBy("at").collect()] == [(2, None, None), (3, "x", "x"), (4, None, "x")]


def test_files_of_a_drop_follow_its_rows(spark, monkeypatch):
    """A file is hashed as a whole, so a larger table comes in more files; the first drop's files come again with the same bytes."""
    import hashlib
    from pathlib import Path

    from paths import SF_SMALL

    from ledgerlake.plans import q_io
    from ledgerlake.sources.adapters import tables

    folders, scratch = [], q_io.scratch
    monkeypatch.setattr(q_io, "scratch", lambda *a: (folders.append(scratch(*a)), folders[-1])[1])
    monkeypatch.setattr(q_io, "ROWS_A_FILE", 200)
    t = tables(spark, SF_SMALL)
    assert q_io.file_arrival_contents_q(t).count() == t["fact_sales"].count()
    files = [p.read_bytes() for p in Path(folders[0].removeprefix("file:")).rglob("part-*.csv")]
    first, second = (-(-t["fact_sales"].where(w).count() // 200) for w in ("l_linenumber <= 2", "l_linenumber > 2"))
    assert first > 4 and len(files) == 2 * first + second
    assert len({hashlib.sha256(b).hexdigest() for b in files}) == first + second


def test_gaps_are_added_without_the_zeros_of_other_families(spark):
    """A family's sum is 0 where the part has rows of others only, and NULL where all its rows are its own and have no gap."""
    pairs = spark.createDataFrame([("AG1", "i1", "90NBx", 2.0), ("AG2", "i2", "90NBy", 3.0)], "ag_no string, item_no string, part_number string, kp_qty double")
    gap = spark.createDataFrame([("NB", "LCD", "AG1", "202401", 1.5), ("NB", "ssd", "AG1", "202401", None), ("NB", None, "AG1", "202401", 7.0),
                                 ("NB", "DDR", "AG2", "202401", None)], "product_line string, category string, ag_no string, period string, bs_gap double")
    missed = spark.createDataFrame([], "product_line string, category string, item_no string, period string, bs_gap double")
    out = PG.keypart_gap_by_part(gap, missed, pairs)
    assert {r.part_number: tuple(None if v is None else float(v) for v in r[3:]) for r in out.collect()} == {
        "90NBx": (3.0, 0.0, 0.0, 0.0), "90NBy": (0.0, 0.0, None, 0.0)}
    cg = spark.createDataFrame([("NB", "CPU", "i1", "202401", None, 1.0), ("NB", None, "i2", "202401", 4.0, 4.0)],
                               "product_line string, category string, item_no string, period string, bs_gap double, rebate double")
    parts = PG.cpugpu_gap_by_part(cg, pairs)
    assert {r.part_number: tuple(None if v is None else float(v) for v in r[3:]) for r in parts.collect()} == {
        "90NBx": (None, 2.0, 0.0, 0.0), "90NBy": (0.0, 0.0, 0.0, 0.0)}
    for df in (out, parts):
        added = df._jdf.queryExecution().analyzed().toString().split("sum(")[1:]
        assert added and not [x for x in added if "else" in x[:x.index(" END")].lower()]
