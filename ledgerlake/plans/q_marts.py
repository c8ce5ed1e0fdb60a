"""Verified queries: the price-gap mart chain.

The SQL twins are written as CTE chains; later models reuse the CTEs of the
models they read, exactly as the Spark side composes the functions.
"""

from pyspark.sql import functions as F

from ledgerlake.plans import pricegap as PG
from ledgerlake.plans.registry import query, shared, stored

# ---------------------------------------------------------------- Spark side


def _patterns(t):
    noun = F.upper(F.split(F.col("p_name"), " ").getItem(1))
    return t["part"].select(F.concat(F.lit("%"), noun, F.lit("%")).alias("pattern"), noun.alias("tag")).distinct()


@stored
def item_map(t):
    return PG.component_map(t["quotes"], _patterns(t), t["bom"])


@stored
def newest_report(t):
    return PG.newest_report(t["keypart_report"])


@stored
def kp_now(t):
    return PG.keypart_now(t["quotes"], newest_report(t), t["fx_rates"], t["item_code"])


@stored
def kp_gap(t):
    return PG.keypart_filled(kp_now(t), t["keypart_history"])


@stored
def cg_now(t):
    return PG.cpugpu_now(t["quotes"], newest_report(t), t["fx_rates"], t["pac_src"])


@stored
def cg_gap(t):
    return PG.cpugpu_filled(cg_now(t), t["cpugpu_history"])


@shared
def missed_rows(t):
    h = t["price_history"].where(F.col("ag_no").isNull())
    ic = t["item_code"]
    j = h.join(ic, F.substring(h["item_no"], 1, 2) == ic["item_code"], "left")
    return j.select("product_line", F.coalesce("category", F.lit("SSD")).alias("category"), "item_no", "period",
                    (F.col("cogs_price").cast("double") - F.col("equo_price").cast("double")).alias("bs_gap"))


@shared
def kp_part(t):
    return PG.keypart_gap_by_part(kp_gap(t), missed_rows(t), item_map(t))


@shared
def cg_part(t):
    return PG.cpugpu_gap_by_part(cg_gap(t), item_map(t))


@stored
def extra(t):
    return PG.extra_rebate(t["keypart_result"], item_map(t), t["extra_rebate_src"])


@stored
def sellout(t):
    return PG.sellout_rebate(t["keypart_result"], item_map(t), t["sellout_src"])


def spine(t):
    return PG.costgap_spine(kp_part(t), cg_part(t), sellout(t), extra(t), t["opp_rebate"])

# ---------------------------------------------------------------- SQL side


ITEM_MAP_SQL = """patterns AS (SELECT DISTINCT '%' || upper(split_part(p_name, ' ', 2)) || '%' AS pattern,
                           upper(split_part(p_name, ' ', 2)) AS tag FROM part),
im_q AS (SELECT item_no, ag_no, item_desc, group_no FROM quotes
         WHERE buying_mode = 'B' AND upper(product_no) IN ('NB', 'NR', 'NV')),
im_tagged AS (SELECT q.*, coalesce(p.tag, '') AS tag FROM im_q q LEFT JOIN patterns p ON q.item_desc LIKE p.pattern),
im_best AS (SELECT item_no, ag_no, item_desc, tag FROM (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY CASE WHEN ag_no IS NOT NULL THEN 0 ELSE 1 END,
    group_no DESC, ag_no DESC NULLS LAST, item_desc DESC NULLS LAST, tag DESC NULLS LAST) AS rn FROM im_tagged) x
  WHERE rn = 1),
im_main AS (SELECT part_number_kp, part_number_90, sum(kp_qty) AS kp_qty FROM bom WHERE substitute_type = 'M'
            GROUP BY part_number_kp, part_number_90),
item_map AS (SELECT b.item_no, b.ag_no, b.item_desc, m.part_number_90 AS part_number, b.tag, m.kp_qty
             FROM im_best b LEFT JOIN im_main m ON b.item_no = m.part_number_kp)"""

RANGE_SQL = """newest AS (SELECT max(ds) AS day FROM keypart_report),
anchor AS (SELECT max(gl_yearmonth) AS m0 FROM keypart_report JOIN newest ON ds = day),
gap_months AS (SELECT strftime(strptime(m0, '%Y%m') + to_months(CAST(k AS INT)), '%Y%m') AS month
  FROM anchor, range(0, 3) AS steps(k))"""


def _history_sql(name: str, now: str, stored: str, keys: str, measures: list[str], more_keys: str = "") -> str:
    """Every key × every month; a measure is its youngest value: of this run, else stored for that month, else
    stored for the last stored month.  ``now`` and ``stored`` hold one row per key and month."""
    cells = ", ".join(measures)
    picks = ", ".join(f"arg_min({m}, age) FILTER (WHERE {m} IS NOT NULL) AS {m}" for m in measures)
    return f"""{name}_keys AS (SELECT {keys} FROM {now} UNION SELECT {keys} FROM {stored} {more_keys}),
{name}_months AS (SELECT list(DISTINCT period) AS months
  FROM (SELECT period FROM {now} UNION ALL SELECT period FROM {stored}) WHERE period IS NOT NULL),
{name}_grid AS (SELECT {keys}, unnest(months) AS period FROM {name}_keys, {name}_months),
{name}_cells AS (SELECT {keys}, period, 0 AS age, {cells} FROM {now}
  UNION ALL SELECT {keys}, period, 1, {cells} FROM {stored}
  UNION ALL SELECT {keys}, unnest(months), 2, {cells} FROM {stored}, {name}_months
    WHERE period = (SELECT max(period) FROM {stored})),
{name}_filled AS (SELECT {keys}, period, {picks} FROM {name}_grid LEFT JOIN {name}_cells USING ({keys}, period)
  GROUP BY {keys}, period)"""


_QTY = "NULLIF(CAST(CAST(sum(TRY_CAST(quantity AS DECIMAL(38,15))) AS DECIMAL(38,4)) AS DOUBLE), 0)"
_UNITS = f"""CAST(CAST(sum(TRY_CAST(net_sale_amount AS DECIMAL(38,15))) AS DECIMAL(38,4)) AS DOUBLE) / {_QTY} AS unit_net,
  CAST(CAST(sum(TRY_CAST(material_cost AS DECIMAL(38,15))) AS DECIMAL(38,4)) AS DOUBLE) / {_QTY} AS unit_cost
  FROM keypart_report JOIN newest ON ds = day JOIN anchor ON gl_yearmonth = m0 GROUP BY ALL"""

KP_GAP_SQL = f"""kp_unit AS (SELECT product_line, category, ag_no, {_UNITS}),
kp_rate AS (SELECT NULLIF(CAST(max(fx_rate) AS DOUBLE), 0) AS rate FROM fx_rates JOIN anchor ON period = m0
  WHERE product_line = 'NB'),
kp_priced AS (SELECT product_line, category, ag_no, unit_net / rate AS equo, unit_cost / rate AS cogs FROM kp_unit, kp_rate),
kp_quoted AS (SELECT upper(product_no) AS product_line, ag_no, group_no AS period, po_price,
  CASE WHEN contains(item_desc, 'BRA') THEN 'BR'
       ELSE coalesce(c.category, CASE WHEN regexp_matches(item_desc, '^(GDDR|DDR|LP)') THEN 'DDR' ELSE 'SSD' END) END AS category
  FROM quotes JOIN gap_months ON group_no = month LEFT JOIN item_code c ON c.item_code = left(item_no, 2)
  WHERE buying_mode = 'B'),
kp_mean AS (SELECT product_line, category, ag_no, period, CAST(sum(po_price) AS DOUBLE) / CAST(count(po_price) AS DOUBLE) AS quoted
  FROM kp_quoted WHERE upper(category) IN ('BATT', 'SSD', 'LCD', 'HDD', 'DDR', 'FLASH') GROUP BY ALL),
kp_now AS (SELECT m.product_line, m.category, m.ag_no, m.period, IF(m.period = m0, p.equo, m.quoted) AS equo_price, p.cogs AS cogs_price
  FROM kp_mean m CROSS JOIN anchor LEFT JOIN kp_priced p USING (product_line, category, ag_no)),
kp_stored AS (SELECT product_line, category, ag_no, period, equo_price, cogs_price FROM keypart_history
  WHERE ds = (SELECT max(ds) FROM keypart_history)),
{_history_sql("kp", "kp_now", "kp_stored", "product_line, category, ag_no", ["equo_price", "cogs_price"],
              "UNION SELECT product_line, category, ag_no FROM kp_priced")},
kp_gap AS (SELECT *, cogs_price - equo_price AS bs_gap FROM kp_filled)"""

_CG_CLASS = "CASE WHEN starts_with(item_no, '01') OR starts_with(item_no, '02135') THEN 'CPU' WHEN starts_with(item_no, '02') THEN 'C.S' END"
CG_GAP_SQL = f"""cg_unit AS (SELECT product_line, item_no, {_UNITS}),
cg_rate AS (SELECT NULLIF(CAST(max(fx_rate) AS DOUBLE), 0) AS rate FROM fx_rates JOIN anchor ON period = m0
  WHERE product_line = 'NB'),
cg_priced AS (SELECT product_line, item_no, unit_net / rate AS equo, unit_cost / rate AS cogs FROM cg_unit, cg_rate),
cg_quoted AS (SELECT upper(product_no) AS product_line, item_no, group_no AS period,
    CAST(sum(po_price) AS DOUBLE) / CAST(count(po_price) AS DOUBLE) AS quoted
  FROM quotes JOIN gap_months ON group_no = month WHERE buying_mode = 'B' AND left(item_no, 2) IN ('01', '02') GROUP BY ALL),
cg_pac AS (SELECT product_line, pn AS item_no, CAST(max(pac) AS DOUBLE) AS pac FROM pac_src JOIN anchor ON period = m0
  WHERE ds = (SELECT max(ds) FROM pac_src) GROUP BY ALL),
cg_now AS (SELECT product_line, {_CG_CLASS} AS category, item_no, period,
  IF(period = min(period) OVER (PARTITION BY product_line, item_no), equo, quoted) AS equo_price, cogs AS cogs_price, pac
  FROM cg_quoted LEFT JOIN cg_priced USING (product_line, item_no) LEFT JOIN cg_pac USING (product_line, item_no)),
cg_stored AS (SELECT DISTINCT product_line, category, item_no, period, equo_price, cogs_price, pac FROM cpugpu_history
  WHERE ds = (SELECT max(ds) FROM cpugpu_history)),
{_history_sql("cg", "cg_now", "cg_stored", "product_line, category, item_no", ["equo_price", "cogs_price", "pac"],
              f"UNION SELECT product_line, {_CG_CLASS}, item_no FROM cg_priced UNION SELECT NULL, {_CG_CLASS}, NULL FROM "
              "(SELECT * FROM cg_pac ANTI JOIN cg_priced USING (product_line, item_no)) ANTI JOIN cg_quoted USING (product_line, item_no)")},
cg_gap AS (SELECT *, cogs_price - equo_price AS bs_gap, pac - cogs_price AS rebate FROM cg_filled)"""

_FAMILIES = {"lcd_gap": "'LCD'", "ssd_gap": "'SSD', 'HDD', 'FLASH'", "ddr_gap": "'DDR'", "batt_gap": "'BATT'"}

KP_PART_SQL = """kp_worth AS (
  SELECT g.product_line, g.period, upper(g.category) AS family, m.part_number, g.bs_gap, m.kp_qty
  FROM kp_gap g LEFT JOIN (SELECT DISTINCT ag_no, part_number, kp_qty FROM item_map) m
    ON m.ag_no = g.ag_no AND substr(m.part_number, 3, 2) = g.product_line
  UNION ALL
  SELECT o.product_line, o.period, upper(o.family), m.part_number, o.bs_gap, m.kp_qty
  FROM (SELECT DISTINCT h.product_line, h.period, h.item_no, coalesce(c.category, 'SSD') AS family,
          CAST(h.cogs_price AS DOUBLE) - CAST(h.equo_price AS DOUBLE) AS bs_gap
        FROM price_history h LEFT JOIN item_code c ON c.item_code = left(h.item_no, 2) WHERE h.ag_no IS NULL) o
  LEFT JOIN (SELECT DISTINCT item_no, part_number, kp_qty FROM item_map) m
    ON m.item_no = o.item_no AND substr(m.part_number, 3, 2) = o.product_line),
kp_part AS (SELECT product_line, period, part_number, """ + ", ".join(
    f"sum(IF(family IN ({names}), CAST(bs_gap * CAST(coalesce(kp_qty, 0) AS DOUBLE) AS DECIMAL(38,9)), CAST(0 AS DECIMAL(38,9)))) AS {column}"
    for column, names in _FAMILIES.items()) + """ FROM kp_worth GROUP BY ALL)"""

_CG_TERM = "CAST({c} * CAST(m.kp_qty AS DOUBLE) AS DECIMAL(38,9))"
_Z9 = "CAST(0 AS DECIMAL(38,9))"

CG_PART_SQL = f"""cgp_m AS (SELECT DISTINCT substr(part_number, 3, 2) AS line, item_no, part_number, kp_qty FROM item_map),
cg_part AS (SELECT g.product_line, g.period, m.part_number,
  sum(CASE WHEN g.category = 'CPU' THEN {_CG_TERM.format(c='g.bs_gap')} ELSE {_Z9} END) AS cpu_gap,
  sum(CASE WHEN g.category = 'CPU' THEN {_CG_TERM.format(c='g.rebate')} ELSE {_Z9} END) AS cpu_rebate,
  sum(CASE WHEN g.category = 'C.S' THEN {_CG_TERM.format(c='g.bs_gap')} ELSE {_Z9} END) AS gpu_gap,
  sum(CASE WHEN g.category = 'C.S' THEN {_CG_TERM.format(c='g.rebate')} ELSE {_Z9} END) AS gpu_rebate
  FROM cg_gap g LEFT JOIN cgp_m m ON g.item_no = m.item_no AND g.product_line = m.line GROUP BY 1, 2, 3)"""

EXTRA_SQL = """ex_res AS (SELECT DISTINCT product_line, part_number, model_name FROM keypart_result
                WHERE ds = (SELECT max(ds) FROM keypart_result)),
ex_grp AS (SELECT DISTINCT item_no, part_number FROM item_map),
ex_reb AS (SELECT DISTINCT item_no, product_line, cpu, extra_rebate, period FROM extra_rebate_src
           WHERE ds = (SELECT max(ds) FROM extra_rebate_src)),
extra AS (SELECT DISTINCT r.product_line, b.cpu, b.extra_rebate, b.period, r.part_number, r.model_name
  FROM ex_res r LEFT JOIN ex_grp g ON r.part_number = g.part_number
  LEFT JOIN ex_reb b ON g.item_no = b.item_no AND r.product_line = b.product_line
  WHERE b.extra_rebate IS NOT NULL
    AND (NOT (r.product_line = 'NV' AND upper(b.cpu) = 'PROMO') OR r.model_name = 'Brand#13'))"""

SELLOUT_SQL = """so_res AS (SELECT DISTINCT product_line, part_number FROM keypart_result
                WHERE ds = (SELECT max(ds) FROM keypart_result) AND product_line = 'NV'),
so_grp AS (SELECT DISTINCT item_no, part_number FROM item_map),
so_src AS (SELECT DISTINCT item_no, product_line, reb, period FROM sellout_src
           WHERE ds = (SELECT max(ds) FROM sellout_src)),
sellout AS (SELECT DISTINCT r.product_line, s.period, r.part_number, s.reb
  FROM so_res r LEFT JOIN so_grp g ON r.part_number = g.part_number
  LEFT JOIN so_src s ON g.item_no = s.item_no AND r.product_line = s.product_line
  WHERE s.reb IS NOT NULL)"""

_SP_KEYS = "product_line, period, part_number"
SPINE_SQL = f"""sp_keys AS (SELECT {_SP_KEYS} FROM kp_part UNION SELECT {_SP_KEYS} FROM cg_part
  UNION SELECT {_SP_KEYS} FROM sellout UNION SELECT {_SP_KEYS} FROM extra
  UNION SELECT product_line, period, sku90pn FROM opp_rebate),
sp_kp AS (SELECT {_SP_KEYS}, sum(lcd_gap) AS lcd_gap, sum(ssd_gap) AS ssd_gap, sum(ddr_gap) AS ddr_gap,
          sum(batt_gap) AS batt_gap FROM kp_part GROUP BY 1, 2, 3),
sp_cg AS (SELECT {_SP_KEYS}, sum(cpu_gap) AS cpu_gap, sum(cpu_rebate) AS cpu_rebate, sum(gpu_gap) AS gpu_gap,
          sum(gpu_rebate) AS gpu_rebate FROM cg_part GROUP BY 1, 2, 3),
sp_nv AS (SELECT {_SP_KEYS}, sum(CAST(reb AS DECIMAL(34,15))) AS nv_rebate FROM sellout GROUP BY 1, 2, 3),
sp_ex AS (SELECT {_SP_KEYS}, sum(CAST(extra_rebate AS DECIMAL(34,15))) AS cpu_extra_rebate FROM extra GROUP BY 1, 2, 3),
sp_op AS (SELECT product_line, period, sku90pn AS part_number, sum(CAST(opp_rebate AS DECIMAL(34,15))) AS opp_rebate
          FROM opp_rebate GROUP BY 1, 2, 3),
costgap AS (SELECT k.product_line, k.period, k.part_number,
  CAST(coalesce(a.lcd_gap, 0) AS DECIMAL(38,9)) AS lcd_gap, CAST(coalesce(a.ssd_gap, 0) AS DECIMAL(38,9)) AS ssd_gap,
  CAST(coalesce(a.ddr_gap, 0) AS DECIMAL(38,9)) AS ddr_gap, CAST(coalesce(a.batt_gap, 0) AS DECIMAL(38,9)) AS batt_gap,
  CAST(coalesce(b.cpu_gap, 0) AS DECIMAL(38,9)) AS cpu_gap, CAST(coalesce(b.cpu_rebate, 0) AS DECIMAL(38,9)) AS cpu_rebate,
  CAST(coalesce(b.gpu_gap, 0) AS DECIMAL(38,9)) AS gpu_gap, CAST(coalesce(b.gpu_rebate, 0) AS DECIMAL(38,9)) AS gpu_rebate,
  CAST(coalesce(c.nv_rebate, 0) AS DECIMAL(38,15)) AS nv_rebate,
  CAST(coalesce(d.cpu_extra_rebate, 0) AS DECIMAL(38,15)) AS cpu_extra_rebate,
  CAST(coalesce(e.opp_rebate, 0) AS DECIMAL(38,15)) AS opp_rebate
  FROM sp_keys k
  LEFT JOIN sp_kp a ON k.product_line IS NOT DISTINCT FROM a.product_line AND k.period IS NOT DISTINCT FROM a.period
    AND k.part_number IS NOT DISTINCT FROM a.part_number
  LEFT JOIN sp_cg b ON k.product_line IS NOT DISTINCT FROM b.product_line AND k.period IS NOT DISTINCT FROM b.period
    AND k.part_number IS NOT DISTINCT FROM b.part_number
  LEFT JOIN sp_nv c ON k.product_line IS NOT DISTINCT FROM c.product_line AND k.period IS NOT DISTINCT FROM c.period
    AND k.part_number IS NOT DISTINCT FROM c.part_number
  LEFT JOIN sp_ex d ON k.product_line IS NOT DISTINCT FROM d.product_line AND k.period IS NOT DISTINCT FROM d.period
    AND k.part_number IS NOT DISTINCT FROM d.part_number
  LEFT JOIN sp_op e ON k.product_line IS NOT DISTINCT FROM e.product_line AND k.period IS NOT DISTINCT FROM e.period
    AND k.part_number IS NOT DISTINCT FROM e.part_number)"""

_GAP_VIEWS = ["quotes", "bom", "keypart_report", "keypart_history", "fx_rates", "item_code", "price_history",
              "extra_rebate_src", "sellout_src", "keypart_result", "opp_rebate", "os_incentive", "cpugpu_history", "pac_src"]

# ---------------------------------------------------------------- registered queries


@query("item_bom_map", _GAP_VIEWS, f"""WITH {ITEM_MAP_SQL}
SELECT item_no, ag_no, item_desc, part_number, tag, CAST(kp_qty AS DECIMAL(38,2)) AS kp_qty FROM item_map""")
def item_bom_map_q(t):
    """Component → group/description/tag → finished parts."""
    return item_map(t).withColumn("kp_qty", F.col("kp_qty").cast("decimal(38,2)"))


@query("keypart_gap", _GAP_VIEWS, f"""WITH {RANGE_SQL}, {KP_GAP_SQL}
SELECT product_line, category, ag_no, period, equo_price, cogs_price, bs_gap FROM kp_gap""")
def keypart_gap_q(t):
    """Key-part price gap with skeleton and carry-forward history."""
    return kp_gap(t).select("product_line", "category", "ag_no", "period", "equo_price", "cogs_price", "bs_gap")


@query("cpugpu_gap", _GAP_VIEWS, f"""WITH {RANGE_SQL}, {CG_GAP_SQL}
SELECT product_line, item_no, period, category, equo_price, cogs_price, pac, rebate, bs_gap FROM cg_gap""")
def cpugpu_gap_q(t):
    """CPU/GPU gap: quotes, report and standard prices, first-month override, history fill."""
    return cg_gap(t).select("product_line", "item_no", "period", "category", "equo_price", "cogs_price", "pac",
                            "rebate", "bs_gap")


@query("keypart_gap_by_part", _GAP_VIEWS, f"""WITH {ITEM_MAP_SQL}, {RANGE_SQL}, {KP_GAP_SQL}, {KP_PART_SQL}
SELECT * FROM kp_part""")
def keypart_gap_by_part_q(t):
    """Key-part gaps per finished part and category family."""
    return kp_part(t)


@query("cpugpu_gap_by_part", _GAP_VIEWS, f"""WITH {ITEM_MAP_SQL}, {RANGE_SQL}, {CG_GAP_SQL}, {CG_PART_SQL}
SELECT * FROM cg_part""")
def cpugpu_gap_by_part_q(t):
    """CPU/GPU gap and rebate per finished part."""
    return cg_part(t)


@query("extra_rebate", _GAP_VIEWS, f"""WITH {ITEM_MAP_SQL}, {EXTRA_SQL}
SELECT * FROM extra""")
def extra_rebate_q(t):
    """Extra rebate expanded to finished parts with the variant rule."""
    return extra(t)


@query("sellout_rebate", _GAP_VIEWS, f"""WITH {ITEM_MAP_SQL}, {SELLOUT_SQL}
SELECT * FROM sellout""")
def sellout_rebate_q(t):
    """NV sell-out rebate expanded to finished parts."""
    return sellout(t)


@query("costgap_spine", _GAP_VIEWS, f"""WITH {ITEM_MAP_SQL}, {RANGE_SQL}, {KP_GAP_SQL}, {KP_PART_SQL}, {CG_GAP_SQL}, {CG_PART_SQL},
{EXTRA_SQL}, {SELLOUT_SQL}, {SPINE_SQL}
SELECT * FROM costgap""")
def costgap_spine_q(t):
    """Cost-gap spine over the five gap / rebate inputs."""
    s = spine(t)
    nine = ["lcd_gap", "ssd_gap", "ddr_gap", "batt_gap", "cpu_gap", "cpu_rebate", "gpu_gap", "gpu_rebate"]
    return s.select("product_line", "period", "part_number",
                    *[F.col(c).cast("decimal(38,9)").alias(c) for c in nine],
                    *[F.col(c).cast("decimal(38,15)").alias(c) for c in ("nv_rebate", "cpu_extra_rebate", "opp_rebate")])


@query("explode_item_list", _GAP_VIEWS, f"""WITH {ITEM_MAP_SQL}, {RANGE_SQL}, {KP_GAP_SQL}, {CG_GAP_SQL}
SELECT m.item_no FROM kp_gap k LEFT JOIN item_map m ON k.ag_no = m.ag_no
UNION SELECT item_no FROM cg_gap
UNION SELECT os_part_number FROM os_incentive WHERE ds = (SELECT max(ds) FROM os_incentive)""")
def explode_item_list_q(t):
    """Items whose cost must be exploded to finished parts."""
    return PG.explode_item_list(kp_gap(t), cg_gap(t), item_map(t), t["os_incentive"])
