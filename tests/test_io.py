"""Sources, sinks, gates and the arrival stream, against files in a fresh scratch folder."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import quality as Q
from ledgerlake.operators import writers as K
from ledgerlake.sources import files as S
from ledgerlake.sources.snapshot import latest_snapshot, read_self_snapshot
from ledgerlake.streaming.arrival import process_arrivals


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_partition_replace_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "t")
    day1 = spark.createDataFrame([(1, "20240101"), (2, "20240101")], "v int, ds string")
    day2 = spark.createDataFrame([(3, "20240102")], "v int, ds string")
    K.partition_replace(day1, path)
    K.partition_replace(day2, path)
    K.partition_replace(day2, path)            # re-run of the same ds
    stored = spark.read.parquet(path)
    assert stored.schema["ds"].dataType.simpleString() == "string"   # partition inference is off
    assert sorted(r.v for r in stored.collect()) == [1, 2, 3]
    assert [r.v for r in latest_snapshot(stored).collect()] == [3]


def test_self_snapshot_read_then_replace_same_table(spark, scratch):
    path = os.path.join(scratch, "acc")
    assert read_self_snapshot(spark, path) is None
    K.partition_replace(spark.createDataFrame([(1, "20240101")], "v int, ds string"), path)
    prev = read_self_snapshot(spark, path)
    nxt = prev.withColumn("v", F.col("v") + 1).withColumn("ds", F.lit("20240102"))
    K.partition_replace(nxt, path)
    assert sorted((r.v, r.ds) for r in spark.read.parquet(path).collect()) == [(1, "20240101"), (2, "20240102")]


def test_full_replace_swaps_and_schema_drift_backs_up(spark, scratch):
    path = os.path.join(scratch, "plain")
    K.full_replace(spark.createDataFrame([(1, "a")], "v int, s string"), path)
    K.full_replace(spark.createDataFrame([(2, "b")], "v int, s string"), path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
    same = K.schema_drift(spark, spark.createDataFrame([(3, "c", "t")], "v int, s string, dw_ins_time string"), path)
    assert same["status"] == "same"
    drift = K.schema_drift(spark, spark.createDataFrame([(3,)], "w int"), path)
    assert drift["status"] == "drift" and drift["missing"] == ["s", "v"] and drift["extra"] == ["w"]
    assert not K.path_exists(spark, path) and K.path_exists(spark, drift["backup"])


def test_string_csv_keeps_na_and_quotes(spark, scratch):
    path = os.path.join(scratch, "csv", "a.csv")
    _write(path, 'h1,h2,h3\nNA,"x, y",\n"q\\"uote",,2\n')
    df = S.read_string_csv(spark, path, ["a", "b", "c"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("NA", "x, y", ""), ('q"uote', "", "2")]


def test_filename_routing_and_literal(spark, scratch):
    folder = os.path.join(scratch, "land")
    _write(os.path.join(folder, "pac_nb.csv"), "pn,pac\n1,2\n")
    _write(os.path.join(folder, "opp_nr.csv"), "pn,pac\n3,4\n")
    df = S.route_by_filename(spark, folder, {r"/pac_[^/]*$": "pac", r"/opp_[^/]*$": "opp"}, r"_([a-z]+)\.csv$")
    got = sorted((r.pn, r.target_table, r.name_literal) for r in df.collect())
    assert got == [("1", "pac", "NB"), ("3", "opp", "NR")]


def test_matrix_sheet_unpivot(spark, scratch):
    from ledgerlake.operators.aggregate import unpivot_matrix
    path = os.path.join(scratch, "fx.csv")
    _write(path, "FX RMB,,\nPeriod,USD,NTD\n202401,7.1,\n202402,7.2,31\n")
    m = S.read_matrix_sheet(spark, path)
    out = unpivot_matrix(m.drop("label"), ["period"], ["USD", "NTD"], "currency", "rate", label="FX RMB")
    got = sorted((r.period, r.currency, r.rate) for r in out.collect())
    assert got == [("202401", "USD", "7.1"), ("202402", "NTD", "31"), ("202402", "USD", "7.2")]


def test_source_corpus(spark, scratch):
    _write(os.path.join(scratch, "src", "a.sql"), "select 1")
    _write(os.path.join(scratch, "src", "sub", "b.py"), "x = 1")
    _write(os.path.join(scratch, "src", "c.txt"), "no")
    df = S.source_corpus(spark, os.path.join(scratch, "src"))
    assert sorted(os.path.basename(r.path) for r in df.collect()) == ["a.sql", "b.py"]


def test_arrivals_are_processed_once(spark, scratch):
    land = os.path.join(scratch, "landing")
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    schema = "v string, ds string"
    from pyspark.sql.types import StructType
    st = StructType.fromDDL(schema)

    def handle(df, _):
        K.partition_replace(df, out)

    _write(os.path.join(land, "f1.csv"), "v,ds\n1,20240101\n")
    assert process_arrivals(spark, land, st, handle, "t", checkpoint=ckpt) == 1
    assert process_arrivals(spark, land, st, handle, "t", checkpoint=ckpt) == 0      # nothing new
    _write(os.path.join(land, "f2.csv"), "v,ds\n2,20240102\n")
    assert process_arrivals(spark, land, st, handle, "t", checkpoint=ckpt) == 1
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_gates(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert not Q.is_empty(df) and Q.is_empty(df.where("id > 5"))
    assert Q.column_check(df, ["id", "other", "dw_ins_time"]) == {"missing": ["other"], "extra": ["name"]}
    assert Q.required_columns(df, ["id", "x"]) == ["x"]
    with pytest.raises(ValueError):
        Q.required_columns(df, ["x"], fail=True)


def test_unique_keys_exempt_blank(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), (" ", "2"), (" ", "2"), ("b", "3")], "k string, v string")
    v = Q.unique_key_violations(df, {"k": ["k"], "kv": ["k", "v"]})
    assert sorted((r.key_group, r.key_value) for r in v.collect()) == [("k", "a"), ("k", "a"), ("kv", "a|1"),
                                                                       ("kv", "a|1")]


def test_matrix_folder_of_many_shapes(spark, scratch):
    import os

    from ledgerlake.sources.files import read_matrix_folder
    os.makedirs(f"{scratch}/sheets/deep")
    sheets = {"a.csv": 'RATES A,,\nmonth,x,"y, z"\n202401,1,"2 ""q"""\n\n202402,,NA\n', "deep/b.csv": "B\r\nmonth,x\r\n202401,7,beyond\r\n202402\r\n",
              "c.csv": "C only\n", "d.csv": "D\nmonth,x,,w\n", "e.csv": "E\nmonth,x\nRATES A,9"}
    for name, text in sheets.items():
        with open(f"{scratch}/sheets/{name}", "w", newline="") as f:
            f.write(text)
    got = sorted(((r.label, r.period, r.column_name, r.value) for r in read_matrix_folder(spark, f"{scratch}/sheets").collect()), key=str)
    assert got == sorted([("RATES A", "202401", "x", "1"), ("RATES A", "202401", "y, z", '2 "q"'), ("RATES A", "202402", "x", ""),
                          ("RATES A", "202402", "y, z", "NA"), ("B", "202401", "x", "7"), ("B", "202402", "x", None), ("E", "RATES A", "x", "9")], key=str)
