"""One-scan key checks, missing values, lineage over all levels."""

from collections import Counter

import pytest

from ledgerlake.operators import catalog as C
from ledgerlake.operators import quality as Q

ROWS = [("a", "1", 5), ("a", "1", 6), ("a", " ", 5), ("a", " ", 5), (None, "1", 5), (None, "1", 5), ("b", "2", 5), ("b", "2", 5), ("b", "2", 5)]


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(ROWS, "k string, g string, v int").repartition(3)


def brute(groups):
    out = Counter()
    for rnd, (name, cols) in enumerate(groups.items(), start=1):
        at = ["kgv".index(c) for c in cols]
        keys = [tuple(None if r[i] is None else str(r[i]) for i in at) for r in ROWS]
        keys = [k for k in keys if all(x is not None and x.strip() for x in k)]
        out.update({(name, rnd, "|".join(k)): n for k, n in Counter(keys).items() if n > 1})
    return out


GROUPS = {"kg": ["k", "g"], "gk": ["g", "k"], "v": ["v"], "all": ["k", "g", "v"], "again": ["v"], "one": ["k"]}


def test_violations_against_a_loop(table):
    got = Counter(tuple(r) for r in Q.unique_key_violations(table, GROUPS).collect())
    assert got == brute(GROUPS)


def test_one_scan_and_one_shuffle_for_any_number_of_groups(table):
    for groups in ({"kg": ["k", "g"]}, GROUPS):
        plan = Q.unique_key_violations(table, groups)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan ExistingRDD") == 1 and plan.count("Expand") == 1


def test_report_counts_rows_and_violations(spark, table):
    got = {r.check_name: (r["round"], r.result, r.n_violations, r.n_rows) for r in Q.report(spark, "t", table, GROUPS).collect()}
    sums = Counter()
    for (name, _, _), n in brute(GROUPS).items():
        sums[name] += n
    assert got == {n: (i, "FAIL" if sums[n] else "PASS", sums[n], len(ROWS)) for i, n in enumerate(GROUPS, start=1)}
    empty = Q.report(spark, "t", table.limit(0), {"kg": ["k", "g"]}).first()
    assert (empty.result, empty.n_violations, empty.n_rows) == ("PASS", 0, 0)


def test_null_shares(table):
    got = {r.column_name: (r.n_rows, r.n_missing) for r in Q.null_shares(table, ["k", "g", "nope"]).collect()}
    assert got == {"k": (9, 2), "g": (9, 2), "nope": (9, 9)}
    assert {tuple(r) for r in Q.null_shares(table.limit(0), ["k", "nope"]).collect()} == {("k", 0, 0), ("nope", 0, 0)}


def test_lineage_closure_with_a_cycle_and_two_ways(spark):
    edges = [("m1", "t1", "ods.raw1"), ("m1", "t1", "t2"), ("m2", "t2", "x.t3, raw2"), ("m3", "t3", "raw3"), ("m3", "t3", "t2"),
             ("m4", "t4", "t1, raw3"), ("m5", "t5", "t5, raw5"), ("m6", "t6", "")]
    columns = spark.createDataFrame([(f"{i}", f"c{i}", t, m, s) for i, (m, t, s) in enumerate(edges)],
                                    "column_id string, column_name string, table_name string, model_name string, source_table string")
    got = {(r.model_name, r.source_table): (r.depth, r.in_cycle) for r in C.lineage_closure(columns).collect()}
    assert got == {("m1", "ods.raw1"): (1, False), ("m1", "raw2"): (2, False), ("m1", "raw3"): (3, False),
                   ("m2", "raw2"): (1, True), ("m2", "raw3"): (2, True), ("m3", "raw3"): (1, True), ("m3", "raw2"): (2, True),
                   ("m4", "raw3"): (1, False), ("m4", "ods.raw1"): (2, False), ("m4", "raw2"): (3, False), ("m5", "raw5"): (1, True)}


def test_a_renamed_file_is_not_loaded_twice(spark, scratch):
    import os
    import shutil

    from pyspark.sql.types import StructType

    from ledgerlake.streaming.arrival import process_new_contents, replace_batch
    land, out = f"{scratch}/land", f"{scratch}/out"
    os.makedirs(land)
    schema = StructType.fromDDL("k int, v string")

    def drop(name, text):
        with open(f"{land}/{name}.csv", "w") as f:
            f.write("k,v\n" + text)

    def run(k):
        n = process_new_contents(spark, land, schema, replace_batch(out), f"contents{k}-{os.path.basename(scratch)}", checkpoint=f"{scratch}/state")
        return n, sorted((r.k, r.v) for r in spark.read.parquet(out).collect())

    drop("a", "1,x\n2,y\n")
    drop("a_copy", "1,x\n2,y\n")  # twice in one drop
    assert run(0) == (1, [(1, "x"), (2, "y")])
    shutil.copy(f"{land}/a.csv", f"{land}/renamed.csv")
    assert run(1) == (0, [(1, "x"), (2, "y")])
    shutil.copy(f"{land}/a.csv", f"{land}/again.csv")
    drop("b", "1,x\n")  # other bytes, though its row is known
    assert run(2) == (1, [(1, "x"), (1, "x"), (2, "y")])
