"""Verified queries: lineage catalog."""

from pyspark.sql import functions as F

from ledgerlake.operators import catalog as C
from ledgerlake.plans.registry import query

LOAD_TIME = "2024-02-01 08:00:00"

_PROD_SQL = "prod AS (SELECT table_name, max(model_name) AS model_name FROM columnlist GROUP BY table_name)"
_EDGES_SQL = """edges AS (SELECT DISTINCT model_name, target_table, trim(s) AS source_table FROM (
  SELECT model_name, table_name AS target_table, unnest(regexp_split_to_array(source_table, '[,/]')) AS s
  FROM columnlist) q WHERE trim(s) <> '')"""


@query("catalog_models", ["columnlist"], "SELECT DISTINCT model_name FROM columnlist WHERE model_name IS NOT NULL")
def catalog_models_q(t):
    """G1: distinct models."""
    return C.models(t["columnlist"])


@query("catalog_tables", ["columnlist"], """
SELECT DISTINCT table_name FROM columnlist WHERE model_name = 'model_3' AND table_name IS NOT NULL""")
def catalog_tables_q(t):
    """Tables of one model."""
    return C.tables_of(t["columnlist"], "model_3")


@query("catalog_columns", ["columnlist"], """
SELECT column_id, column_name, coalesce(source_table, '') AS source_table FROM columnlist
WHERE model_name = 'model_3' AND table_name = 'tbl_3'""")
def catalog_columns_q(t):
    """Columns of one model's table, NULL → ''."""
    return C.columns_of(t["columnlist"], "model_3", "tbl_3")


@query("catalog_producer", ["columnlist"], f"""WITH {_PROD_SQL}, {_EDGES_SQL},
s AS (SELECT DISTINCT source_table FROM edges)
SELECT s.source_table, coalesce(p1.model_name, p2.model_name) AS producer_model
FROM s LEFT JOIN prod p1 ON p1.table_name = s.source_table
LEFT JOIN prod p2 ON p2.table_name = string_split(s.source_table, '.')[-1]""")
def catalog_producer_q(t):
    """Producer of every referenced table (exact name, else suffix)."""
    edges = C.lineage_edges(t["columnlist"])
    s = edges.select("source_table").distinct()
    return C.resolve_producer(s, "source_table", C.producers(t["columnlist"]), "producer_model")


@query("resolve_name", ["columnlist"], f"""WITH {_PROD_SQL}
SELECT c.column_id, coalesce(p1.model_name, p2.model_name) AS producer_model
FROM columnlist c LEFT JOIN prod p1 ON p1.table_name = c.source_table
LEFT JOIN prod p2 ON p2.table_name = string_split(c.source_table, '.')[-1]""")
def resolve_name_q(t):
    """Exact-then-suffix name resolution for every column's source text."""
    c = t["columnlist"].select("column_id", "source_table")
    return C.resolve_producer(c, "source_table", C.producers(t["columnlist"]), "producer_model").select(
        "column_id", "producer_model")


@query("lineage_edges", ["columnlist"], f"""WITH {_PROD_SQL}, {_EDGES_SQL}
SELECT e.model_name, e.target_table, e.source_table, coalesce(p1.model_name, p2.model_name) AS source_model,
  CASE WHEN coalesce(p1.model_name, p2.model_name) IS NULL THEN 'raw source' ELSE 'model' END AS source_kind
FROM edges e LEFT JOIN prod p1 ON p1.table_name = e.source_table
LEFT JOIN prod p2 ON p2.table_name = string_split(e.source_table, '.')[-1]""")
def lineage_edges_q(t):
    """All upstream edges, each source resolved to its producing model."""
    return C.lineage_edges(t["columnlist"])


@query("lineage_closure", ["columnlist"], f"""WITH RECURSIVE {_PROD_SQL}, {_EDGES_SQL},
resolved AS (SELECT DISTINCT e.model_name, e.source_table, coalesce(p1.model_name, p2.model_name) AS source_model
  FROM edges e LEFT JOIN prod p1 ON p1.table_name = e.source_table LEFT JOIN prod p2 ON p2.table_name = string_split(e.source_table, '.')[-1]),
walk AS (SELECT DISTINCT model_name, model_name AS node, 0 AS depth FROM resolved
  UNION SELECT w.model_name, r.source_model, w.depth + 1 FROM walk w JOIN resolved r ON r.model_name = w.node
  WHERE r.source_model IS NOT NULL AND w.depth < (SELECT count(DISTINCT model_name) FROM resolved)),
cyclic AS (SELECT DISTINCT model_name FROM walk WHERE depth > 0 AND node = model_name)
SELECT w.model_name, r.source_table, CAST(min(w.depth) + 1 AS INTEGER) AS depth,
  w.model_name IN (SELECT model_name FROM cyclic) AS in_cycle
FROM walk w JOIN resolved r ON r.model_name = w.node WHERE r.source_model IS NULL GROUP BY ALL""")
def lineage_closure_q(t):
    """G5 over all levels: every model's raw sources with their distance, cycles marked."""
    return C.lineage_closure(t["columnlist"])


def _answer(t):
    c = t["columnlist"]
    obj = F.concat(F.lit('[{"table_name": " '), F.col("table_name"), F.lit(' ", "column_name": "'),
                   F.col("column_name"), F.lit('", "source_table": "'), F.col("source_table"),
                   F.lit('"}, {"table_name": "", "column_name": "junk"}]'))
    return c.select("model_name", F.concat(F.lit("Here is the list:\n```json\n"), obj, F.lit("\n```")).alias("answer"))


@query("catalog_normalize", ["columnlist"], f"""
WITH a AS (SELECT model_name, 'Here is the list:' || chr(10) || '```json' || chr(10)
  || '[{{"table_name": " ' || table_name || ' ", "column_name": "' || column_name || '", "source_table": "'
  || source_table || '"}}, {{"table_name": "", "column_name": "junk"}}]' || chr(10) || '```' AS answer FROM columnlist),
p AS (SELECT model_name, unnest(from_json(regexp_extract(answer, '(?s)([\\[{{].*[\\]}}])', 1),
  '[{{"table_name":"VARCHAR","column_name":"VARCHAR","source_table":"VARCHAR"}}]')) AS it FROM a)
SELECT model_name, trim(it.table_name) AS table_name, trim(it.column_name) AS column_name,
  trim(it.source_table) AS source_table, '{LOAD_TIME}' AS dw_ins_time
FROM p WHERE length(trim(it.table_name)) > 0 AND length(trim(it.column_name)) > 0""")
def catalog_normalize_q(t):
    """G6 (+F15): catalog rows out of free-text answers: parse, trim, skip empty names, stamp."""
    return C.normalize_answers(_answer(t), "answer", "model_name", F.lit(LOAD_TIME))


@query("catalog_project", ["columnlist"], """
SELECT column_id, model_name, table_name FROM columnlist WHERE starts_with(model_name, 'model_1')""")
def catalog_project_q(t):
    """Models of one project (or all when no project is given)."""
    return C.select_project(t["columnlist"], "model_1").select("column_id", "model_name", "table_name")


@query("surrogate_upsert", ["columnlist"], """
WITH ex AS (SELECT column_id, column_name, table_name, model_name, source_table FROM columnlist),
inc AS (SELECT column_name, table_name, model_name, source_table FROM columnlist WHERE model_name = 'model_2'
        UNION ALL
        SELECT column_name || '_v2', table_name, model_name, source_table FROM columnlist WHERE model_name = 'model_5'),
ids AS (SELECT table_name, column_name, max(column_id) AS column_id FROM ex GROUP BY 1, 2),
top AS (SELECT max(CAST(column_id AS BIGINT)) AS m FROM ex),
known AS (SELECT i.column_name, i.table_name, i.model_name, i.source_table, d.column_id
          FROM inc i JOIN ids d ON i.table_name = d.table_name AND i.column_name = d.column_name),
fresh AS (SELECT i.column_name, i.table_name, i.model_name, i.source_table,
  lpad(CAST(coalesce((SELECT m FROM top), 0) + row_number() OVER (ORDER BY i.table_name, i.column_name) AS VARCHAR), 6, '0')
    AS column_id
  FROM inc i WHERE NOT EXISTS (SELECT 1 FROM ids d WHERE d.table_name = i.table_name AND d.column_name = i.column_name)),
untouched AS (SELECT e.column_name, e.table_name, e.model_name, e.source_table, e.column_id FROM ex e
  WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.table_name = e.table_name AND i.column_name = e.column_name))
SELECT * FROM untouched UNION ALL SELECT * FROM known UNION ALL SELECT * FROM fresh""")
def surrogate_upsert_q(t):
    """K6: keep ids of known natural keys, allocate max(id)+rank for new ones (distributed numbering)."""
    c = t["columnlist"].select("column_id", "column_name", "table_name", "model_name", "source_table")
    inc = (c.where(F.col("model_name") == "model_2").drop("column_id")
           .unionByName(c.where(F.col("model_name") == "model_5").drop("column_id")
                        .withColumn("column_name", F.concat(F.col("column_name"), F.lit("_v2")))))
    return C.surrogate_upsert(c, inc, ["table_name", "column_name"], "column_id", 6)
