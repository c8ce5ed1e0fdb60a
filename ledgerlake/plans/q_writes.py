"""Verified queries: keyed writes, audit columns and data-quality reports (K2, K3, K7, Q3, Q5)."""

from pyspark.sql import functions as F

from ledgerlake.operators import quality as Q
from ledgerlake.operators import writers as K
from ledgerlake.plans.registry import query
from ledgerlake.sources.snapshot import latest_snapshot


@query("merge_by_key", ["order_snapshots"], """
WITH tgt AS (SELECT o_orderkey, period, amount, ds FROM order_snapshots WHERE ds = (SELECT max(ds) FROM order_snapshots)),
src AS (SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS period,
        CAST(o_totalprice * 0 + 1 AS DECIMAL(18,2)) AS amount, '20240331' AS ds FROM orders WHERE o_orderstatus = 'F')
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_orderkey = t.o_orderkey AND s.ds = t.ds)
UNION ALL SELECT * FROM src""")
def merge_by_key_q(t):
    """K2: unique-key upsert into the latest snapshot partition."""
    tgt = latest_snapshot(t["order_snapshots"]).select("o_orderkey", "period", "amount", "ds")
    o = t["orders"].where(F.col("o_orderstatus") == "F")
    src = o.select("o_orderkey", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("string").alias("period"),
                   (F.col("o_totalprice") * 0 + 1).cast("decimal(18,2)").alias("amount"), F.lit("20240331").alias("ds"))
    return K.merge_by_key(tgt, src, ["o_orderkey", "ds"])


@query("replace_by_key", ["order_snapshots"], """
WITH tgt AS (SELECT o_orderkey, period, amount FROM order_snapshots WHERE ds = (SELECT max(ds) FROM order_snapshots)),
src AS (SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS period,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.period = t.period)
UNION ALL SELECT * FROM src""")
def replace_by_key_q(t):
    """K3 (+J20): delete every stored row of the incoming periods, then append."""
    tgt = latest_snapshot(t["order_snapshots"]).select("o_orderkey", "period", "amount")
    o = t["orders"].where(F.col("o_orderpriority") == "1-URGENT")
    src = o.select("o_orderkey", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("string").alias("period"),
                   F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return K.replace_by_key(tgt, src, ["period"])


@query("audit_columns", [], """
SELECT event_id, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Taipei', '%Y-%m-%d %H:%M:%S') AS dw_ins_time,
  '20240201' AS ds FROM events""")
def audit_columns_q(t):
    """K7: load time in a named zone (here a fixed instant per row) and the snapshot day."""
    e = t["events"].select("event_id", "ts")
    return K.audit_columns(e, "20240201", instant=F.col("ts")).drop("ts")


_KEY_GROUPS = {"order_line": ["l_orderkey", "l_linenumber"], "part_period_order": ["part_number", "period", "l_orderkey"],
               "line_cost_period": ["l_orderkey", "cost_period"]}


def _dq_sql_group(name, rnd, keys):
    ok = " AND ".join(f"{k} IS NOT NULL AND length(trim(CAST({k} AS VARCHAR))) > 0" for k in keys)
    kv = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    part = ", ".join(keys)
    return (f"SELECT '{name}' AS key_group, {rnd} AS round, {kv} AS key_value FROM ("
            f"SELECT *, count(*) OVER (PARTITION BY {part}) AS n FROM fact_sales WHERE {ok}) q WHERE n > 1")


_DQ_SQL = "\nUNION ALL\n".join(_dq_sql_group(n, i, k) for i, (n, k) in enumerate(_KEY_GROUPS.items(), start=1))


@query("dq_unique_keys", ["fact_sales"], _DQ_SQL)
def dq_unique_keys_q(t):
    """Q3: duplicate-key rows for every key group (blank key parts exempt)."""
    return Q.unique_key_violations(t["fact_sales"], _KEY_GROUPS)


@query("dq_report", ["fact_sales"], f"""
WITH v AS ({_DQ_SQL}),
g AS ({' UNION ALL '.join(f"SELECT '{n}' AS key_group, {i} AS round" for i, n in enumerate(_KEY_GROUPS, start=1))}),
c AS (SELECT key_group, round, count(*) AS n FROM v GROUP BY 1, 2)
SELECT 'fact_sales' AS table_name, g.round, g.key_group AS check_name,
  CASE WHEN coalesce(c.n, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
  CASE WHEN coalesce(c.n, 0) = 0 THEN '' ELSE 'duplicate key' END AS reason,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_violations, CAST((SELECT count(*) FROM fact_sales) AS BIGINT) AS n_rows
FROM g LEFT JOIN c ON c.key_group = g.key_group AND c.round = g.round""")
def dq_report_q(t):
    """Q5: the validation report table (one row per check)."""
    return Q.report(t.spark, "fact_sales", t["fact_sales"], _KEY_GROUPS)


_GATED = ("orders", "lineitem", "part", "customer")
_CONTRACT = {"orders": ("o_orderkey", "o_custkey", "o_channel"), "part": ("p_partkey", "p_name", "p_vendor", "p_size")}


@query("dq_empty", [], " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) = 0 AS is_empty" for n in _GATED))
def dq_empty_q(t):
    """Q1: the empty-input gate of every input table."""
    return t.spark.createDataFrame([(n, Q.is_empty(t[n])) for n in _GATED], "table_name string, is_empty boolean")


_HAVE = "SELECT table_name, list(column_name) AS have FROM information_schema.columns GROUP BY table_name"
_WANT = " UNION ALL ".join(f"SELECT '{n}' AS table_name, {list(c)!r} AS want" for n, c in _CONTRACT.items())


@query("dq_columns", [], f"""
SELECT w.table_name, array_to_string(list_sort(list_filter(w.want, lambda c: NOT list_contains(h.have, c))), ',') AS missing,
  array_to_string(list_sort(list_filter(h.have, lambda c: NOT list_contains(w.want, c))), ',') AS extra
FROM ({_WANT}) w JOIN ({_HAVE}) h USING (table_name)""")
def dq_columns_q(t):
    """Q2: missing and extra columns of stored tables against their contracts."""
    rows = [(n, Q.column_check(t[n], c)) for n, c in _CONTRACT.items()]
    return t.spark.createDataFrame([(n, ",".join(r["missing"]), ",".join(r["extra"])) for n, r in rows],
                                   "table_name string, missing string, extra string")


@query("dq_required", [], f"""
SELECT w.table_name, array_to_string(list_filter(w.want, lambda c: NOT list_contains(h.have, c)), ',') AS missing
FROM ({_WANT}) w JOIN ({_HAVE}) h USING (table_name)""")
def dq_required_q(t):
    """Q4: required columns that a stored table lacks, in the order of the contract."""
    return t.spark.createDataFrame([(n, ",".join(Q.required_columns(t[n], c))) for n, c in _CONTRACT.items()],
                                   "table_name string, missing string")


_REQUIRED = {"sales_detail": ("part_number", "customer", "sold_to_customer", "ou", "warranty", "cn_rate"),
             "quotes": ("item_no", "ag_no", "price_list")}
_REQ_HAVE = {"sales_detail": {"part_number", "sold_to_customer", "ou", "warranty", "cn_rate"}, "quotes": {"item_no", "ag_no"}}


@query("dq_required_rows", ["sales_detail", "quotes"], " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
    + (f"count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')" if c in _REQ_HAVE[n] else "count(*)") + f" AS n_missing FROM {n}"
    for n, cs in _REQUIRED.items() for c in cs))
def dq_required_rows_q(t):
    """Q4 on rows: how many rows lack each required value, a column that the table lacks counting in full."""
    parts = [Q.null_shares(t[n], cs).withColumn("table_name", F.lit(n)) for n, cs in _REQUIRED.items()]
    return parts[0].unionByName(parts[1]).select("table_name", "column_name", "n_rows", "n_missing")
