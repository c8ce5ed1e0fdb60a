"""Verified queries: combined fact, candidate costs, enriched fact, gross profit, accumulators."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerlake.functions.money import fixed6
from ledgerlake.operators.fusion import Fused
from ledgerlake.plans import grossprofit as GP
from ledgerlake.plans.q_marts import ITEM_MAP_SQL, EXTRA_SQL, SELLOUT_SQL, extra, item_map, sellout
from ledgerlake.plans.registry import query, shared
from ledgerlake.sources.adapters import ACCUM_CONTRACT, store_table
from ledgerlake.sources.snapshot import max_of

_LOCAL_VIEWS = ["sales_detail", "fx_rates", "cn_rates", "branch_freight", "funding", "cost_range"]
_VIEWS = [*_LOCAL_VIEWS, "keypart_gp", "os_incentive_kp", "opp_rebate", "cost_pn", "cost_pn_ex", "cost_branch", "cost_branch_ex",
          "aci_cost", "aci_cost_ex", "simulation", "hq_ship_fee", "csc_percentage", "csc_local", "quotes", "bom", "keypart_result",
          "extra_rebate_src", "sellout_src"]
_ACCUM_VIEWS = [*_VIEWS, "gp_monthly_accum", "gp_weekly_accum"]

LOAD_TIME = "2024-02-01 08:00:00"
BATCH_DS = "20240201"

# ---------------------------------------------------------------- Spark side


@shared
def local(t, monthly: bool):
    t.prepare(_LOCAL_VIEWS)
    return GP.local_data(t["sales_detail"], t["fx_rates"], t["branch_freight"], t["funding"], t["cost_range"], t["cn_rates"], monthly)


@shared
def lookups(t):
    """The fused lookup tables of the enriched fact, stored once: Spark knows their sizes when it plans the joins."""
    t.prepare(_VIEWS)
    costs = GP.cost_families(t["cost_pn"], t["cost_pn_ex"], t["simulation"], t["aci_cost"], t["aci_cost_ex"], t["cost_branch"],
                             t["cost_branch_ex"])
    fused = GP.enrichment(t["keypart_gp"], t["simulation"], t["hq_ship_fee"], t["opp_rebate"], extra(t), sellout(t),
                          t["os_incentive_kp"], item_map(t), t["csc_percentage"], t["csc_local"], t["fx_rates"], costs)
    if not t.materialize:
        return fused
    with ThreadPoolExecutor(len(fused)) as pool:  # small jobs side by side
        stored = list(pool.map(lambda f: store_table(f.table, "lookup-" + "-".join(f.keys).strip("_")), fused))
    return [Fused(f.keys, table, f.values, f.series) for f, table in zip(fused, stored)]


@shared
def candidates(t):
    return GP.with_candidates(local(t, True), lookups(t))


@shared
def enriched(t, monthly: bool):
    return GP.enriched_fact(local(t, monthly), lookups(t), monthly)


GP_COLUMNS = ["l_orderkey", "l_linenumber", "source", "product_line_id", "part_number", "period", "all_qty",
              "local_gp", "local_gp_fxdiff", "gp_pod", "gp_pod_fxdiff", "hq_gp", "hq_gp_usd_fxdiff", "gp_net",
              "gp_net_fxdiff", "hq_gp_unit", "hq_gp_unit_fxdiff", "hq_asp", "hq_asp_fxdiff", "hq_rev",
              "hq_rev_usd_fxdiff", "rmb_fx_rate", "total_ship_fee_rmb", "cogs_amount_rmb", "opp_amount_rmb",
              "extra_rebate_rmb", "nv_sellout_rebate_rmb", "funding_rmb", "os_incentive_rmb", "local_gp_rmb",
              "gp_pod_rmb", "hq_gp_rmb", "gp_net_rmb"]


@shared
def gross(t, monthly: bool = True):
    return GP.gross_profit(enriched(t, monthly), t["fx_rates"])


def _text_ready(df):
    """Doubles become DECIMAL(38,6) before they are written as text."""
    return df.select(*[fixed6(f.name).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])

# ---------------------------------------------------------------- SQL side


def _ratio(a, b):
    return f"(CASE WHEN CAST({b} AS DOUBLE) <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


def _conv(amount, rate):
    return f"CASE WHEN source = 'ACCRAW' THEN {_ratio(amount, rate)} ELSE {amount} END"


def _keyword_sql(text, names, default):
    arms = " ".join("WHEN contains(upper({}), '{}') THEN '{}'".format(text, k, v.replace("'", "''")) for k, v in names.items())
    return f"CASE {arms} ELSE '{default}' END"


def local_sql(monthly: bool, sales: str = "sales_detail", columns=GP.LOCAL_COLUMNS) -> str:
    """CTE chain from ``sales`` to ``local_data``."""
    names = GP.CUSTOMERS if monthly else GP.WEEKLY_CUSTOMERS
    rate = """CASE WHEN source = 'ACIRAW' AND upper(trim(business_type)) = 'REFURBISH' THEN CAST(0 AS DECIMAL(8,4))
    ELSE coalesce(ra.cn, rb.cn, rc.cn, rd.cn) END""" if monthly else "NULL"
    notes = """cn * coalesce(revenue_usd_hedge_rate, 0.0) AS credit_note_hedge_rate, cn * coalesce(revenue_fxdiff, 0.0) AS credit_note_fxdiff,
  CASE WHEN source = 'ACCRAW' THEN cn * coalesce(revenue_rmb, 0.0) END AS credit_note_rmb""" if monthly else f"""{_conv('note', 'fx_rate')} AS credit_note_hedge_rate,
  {_conv('note', 'fx_rate_ex')} AS credit_note_fxdiff, CASE WHEN source = 'ACCRAW' THEN note END AS credit_note_rmb"""
    qty = "CASE WHEN CAST(all_qty AS DOUBLE) < 0 THEN 0.0 ELSE CAST(all_qty AS DOUBLE) END" if monthly else "CAST(all_qty AS DOUBLE)"
    return f"""ld_cn AS (SELECT CASE WHEN source = 'ACCRAW' THEN 'rmb' WHEN channel_code IN ('ACI-Retail', 'Channel-SA') THEN 'retail'
    WHEN starts_with(channel_code, 'Other Channel') THEN 'other' ELSE 'named' END AS rule, product_line, legal_entity, channel_code, period,
    cn FROM cn_rates),
ld_rmb AS (SELECT product_line, legal_entity, channel_code, period, max(cn) AS cn FROM ld_cn WHERE rule = 'rmb' GROUP BY ALL),
ld_ret AS (SELECT product_line, channel_code, period, max(cn) AS cn FROM ld_cn WHERE rule = 'retail' GROUP BY ALL),
ld_nam AS (SELECT product_line, channel_code, period, max(cn) AS cn FROM ld_cn WHERE rule = 'named' GROUP BY ALL),
ld_oth AS (SELECT product_line, legal_entity, period, max(cn) AS cn FROM ld_cn WHERE rule = 'other' GROUP BY ALL),
ld_fr AS (SELECT product_line, upper(trim(sales_team)) AS team, period, max(freight) AS freight FROM branch_freight GROUP BY ALL),
ld_fu AS (SELECT trim(pn) AS pn, period, max(funding) AS funding FROM funding GROUP BY ALL),
ld_cr AS (SELECT trim(pn) AS pn, trim(version) AS version, max(cost_range) AS cost_range FROM cost_range GROUP BY ALL),
ld0 AS (SELECT *, CASE WHEN source = 'ACIRAW' THEN {_keyword_sql('sold_to_customer', names, GP.OTHER_CUSTOMER)} END AS customer,
  CASE WHEN source = 'ACCRAW' THEN 'ACC' ELSE {_keyword_sql('branch', GP.BRANCHES, GP.OTHER_BRANCH)} END AS branch2 FROM {sales}),
ld1 AS (SELECT s.*, x.fx_rate, x.fx_rate_ex, -(CAST(fr.freight AS DOUBLE) * CAST(s.all_qty AS DOUBLE)) AS fee, fu.funding AS funding_unit,
  CASE WHEN s.source = 'ACIRAW' OR s.product_line_id = 'NB' THEN coalesce(cr.cost_range, '由新到舊') ELSE '由新到舊' END AS cost_period,
  CAST({rate} AS DOUBLE) AS cn
  FROM ld0 s LEFT JOIN fx_rates x ON x.product_line = s.product_line_id AND x.period = s.period
  LEFT JOIN ld_fr fr ON fr.product_line = s.product_line_id AND fr.team = upper(s.branch) AND fr.period = s.period
  LEFT JOIN ld_fu fu ON fu.pn = s.part_number AND fu.period = s.period
  LEFT JOIN ld_cr cr ON cr.pn = s.part_number AND cr.version = s.period
  LEFT JOIN ld_rmb ra ON s.source = 'ACCRAW' AND ra.product_line = s.product_line_id AND ra.legal_entity = s.ou
    AND ra.channel_code = s.distribution_type AND ra.period = s.period
  LEFT JOIN ld_ret rb ON s.source = 'ACIRAW' AND rb.product_line = s.product_line_id AND rb.channel_code = s.branch2 AND rb.period = s.period
  LEFT JOIN ld_nam rc ON s.source = 'ACIRAW' AND rc.product_line = s.product_line_id
    AND rc.channel_code = s.customer || '-' || s.country_code AND rc.period = s.period
  LEFT JOIN ld_oth rd ON s.source = 'ACIRAW' AND rd.product_line = s.product_line_id AND rd.legal_entity = s.country_code
    AND rd.period = s.period),
ld2 AS (SELECT *, CAST(revenue AS DOUBLE) AS rv, CAST(local_cogs AS DOUBLE) AS lc, CAST(sheet_credit_note AS DOUBLE) AS note FROM ld1),
ld3 AS (SELECT *, {_conv('rv', 'fx_rate')} AS revenue_usd_hedge_rate, {_conv('rv', 'fx_rate_ex')} AS revenue_fxdiff,
  CASE WHEN source = 'ACCRAW' THEN rv END AS revenue_rmb,
  {_conv('lc', 'fx_rate')} AS local_cogs_amount, {_conv('lc', 'fx_rate_ex')} AS local_cogs_amount_fxdiff,
  CASE WHEN source = 'ACCRAW' THEN lc END AS local_cogs_amount_rmb,
  {_conv('fee', 'fx_rate')} AS total_ship_fee_company, {_conv('fee', 'fx_rate_ex')} AS total_ship_fee_company_fxdiff,
  CASE WHEN source = 'ACCRAW' THEN fee END AS total_ship_fee_company_rmb, CAST(funding_unit AS DOUBLE) * ({qty}) AS funding FROM ld2),
ld4 AS (SELECT *, {notes} FROM ld3),
local_all AS (SELECT *, coalesce(revenue_usd_hedge_rate, 0.0) - coalesce(credit_note_hedge_rate, 0.0) AS net_revenue_usd_agp,
  coalesce(revenue_fxdiff, 0.0) - coalesce(credit_note_fxdiff, 0.0) AS net_revenue_fxdiff,
  CASE WHEN source = 'ACCRAW' THEN coalesce(revenue_rmb, 0.0) - coalesce(credit_note_rmb, 0.0) END AS net_revenue_rmb FROM ld4),
local_data AS (SELECT {', '.join(columns)} FROM local_all)"""


def _avg(value, keys, table):
    return (f"SELECT {keys}, period, CAST(sum({value}) AS DOUBLE) / CAST(count({value}) AS DOUBLE) AS c "
            f"FROM {table} GROUP BY {keys}, period")


def _asof(alias, table, keys):
    on = " AND ".join(f"{alias}.{k} = {f}" for k, f in keys.items())
    return f"ASOF LEFT JOIN {table} {alias} ON {on} AND f.period >= {alias}.period"


_PN, _MC, _SM = {"part_number": "f.part_number"}, {"model_name": "f.model", "cpu": "f.cpu_sku"}, {"model": "f.model", "cpu_sku": "f.cpu_sku"}
_BR = {"sales_team": "f.branch"} | _MC


def candidates_sql() -> str:
    """CTE chain from ``local_data`` to ``cands``: one join per candidate, as-of joins for the latest ones."""
    ctes, columns, joins = [], [], []
    for name, table, sfx in (("", "cost_pn", ""), ("x", "cost_pn_ex", "_ex")):
        ctes += [f"cf_p{name} AS ({_avg('item_cost_usd', 'part_number', table)})", f"cf_m{name} AS ({_avg('item_cost_usd', 'model_name, cpu', table)})"]
        for shape, short, keys in (("hqpn", "p", _PN), ("hqmodelcpu", "m", _MC)):
            a, b = f"e_{short}{name}", f"l_{short}{name}"
            on = " AND ".join(f"{a}.{k} = {f}" for k, f in keys.items())
            joins += [f"LEFT JOIN cf_{short}{name} {a} ON {on} AND {a}.period = f.cost_period", _asof(b, f"cf_{short}{name}", keys)]
            columns += [f"{a}.c AS item_cost_usd_{shape}{sfx}", f"{b}.c AS item_cost_usd_{shape}_max{sfx}"]
    for short, keys, shape, on in (("sp", "part_number", "1179pn", _PN), ("sm", "model, cpu_sku", "1179modelcpu", _SM)):
        ctes.append(f"""cf_{short} AS (SELECT {keys}, source, period, {_ratio('sum(cogs_amount)', 'sum(all_qty)')} AS c,
    {_ratio('sum(cogs_amount_fxdiff)', 'sum(all_qty)')} AS cx FROM sim GROUP BY {keys}, source, period)""")
        same = " AND ".join(f"e_{short}.{k} = {f}" for k, f in on.items())
        joins += [f"LEFT JOIN cf_{short} e_{short} ON {same} AND e_{short}.source = f.source AND e_{short}.period = f.period",
                  _asof(f"l_{short}", f"cf_{short}", on | {"source": "f.source"})]
        for c, sfx in (("c", ""), ("cx", "_fxdiff")):
            columns += [f"e_{short}.{c} AS cogs_amount_{shape}{sfx}", f"l_{short}.{c} AS cogs_amount_{shape}_max{sfx}"]
    for name, sfx in (("aci_cost", ""), ("aci_cost_ex", "_ex")):
        joins.append(f"LEFT JOIN (SELECT item, period, max(item_cost_usd) AS c FROM {name} GROUP BY ALL) {name}_1 "
                     f"ON {name}_1.item = f.part_number AND {name}_1.period = f.period")
        columns.append(f"CAST({name}_1.c AS DOUBLE) AS aci_cost_item_cost_usd{sfx}")
    for name, table, sfx in (("b", "cost_branch", ""), ("bx", "cost_branch_ex", "_ex")):
        ctes.append(f"cf_{name} AS ({_avg('item_cost_usd', 'sales_team, model_name, cpu', table)})")
        joins.append(_asof(f"l_{name}", f"cf_{name}", _BR))
        columns.append(f"l_{name}.c AS hq_model_cpu_branch_item_cost_usd{sfx}")
    nl = "\n  "
    return f"""sim AS (SELECT *, substr(estimate_revenue_date, 1, 6) AS period, CASE WHEN territory IN ('NA', 'LATAM') THEN 'ACIRAW'
    WHEN territory = 'CHINA' THEN 'ACCRAW' END AS source, freight_cost * all_qty AS freight_amt FROM simulation),
{(',' + nl).join(ctes)},
attrs AS (SELECT part_number, model_name AS model, segmentation AS segment, gpu, cpu_vendor, cpu_platform, cpu AS cpu_sku, lcd_code, cpu_n,
  acc_segment, cte AS is_cte FROM keypart_gp WHERE ds = (SELECT max(ds) FROM keypart_gp)),
withattrs AS (SELECT s.*, a.* EXCLUDE (part_number) FROM local_data s LEFT JOIN attrs a ON a.part_number = s.part_number),
cands AS (SELECT f.*, {', '.join(columns)}
  FROM withattrs f
  {nl.join(joins)})"""


def waterfall_sql(which: str) -> str:
    """The CASE as the rules state it: RMB source with a cost period, RMB source newest first, USD source."""
    rules = GP.COST_WATERFALL[which]
    return f"""CASE WHEN source = 'ACCRAW' AND cost_period <> '由新到舊' THEN coalesce({', '.join(rules['ACCRAW', 'exact'])})
    WHEN source = 'ACCRAW' AND cost_period = '由新到舊' THEN coalesce({', '.join(rules['ACCRAW', 'newest'])})
    WHEN source = 'ACIRAW' THEN coalesce({', '.join(rules['ACIRAW', None])}) END"""


def enriched_sql(monthly: bool) -> str:
    """CTE chain from ``cands`` to ``mapped`` (needs the extra, sellout and component-map CTEs)."""
    def amount(unit):
        plain = f"CAST({unit} AS DOUBLE) * qty"
        return f"CASE WHEN qty < 0 THEN 0.0 ELSE {plain} END" if monthly else plain
    ratio = "csc" if monthly else "CAST(sheet_csc_ratio AS DOUBLE)"
    other = (lambda rev: f"{rev} * csc_ratio") if monthly else (lambda rev: "CAST(sheet_csc_amt AS DOUBLE)")
    return f"""e_os AS (SELECT m.part_number, o.period, max(o.inc) AS inc FROM os_incentive_kp o
  JOIN (SELECT DISTINCT item_no, part_number FROM item_map WHERE part_number IS NOT NULL) m ON m.item_no = o.os_part_number
  WHERE o.ds = (SELECT max(ds) FROM os_incentive_kp) GROUP BY ALL),
e1 AS (SELECT c.*, CAST(c.all_qty AS DOUBLE) AS qty, op.u AS opp_unit, ex.u AS extra_unit, so.u AS sellout_unit, os.inc AS os_unit,
  fr.u AS freight_unit, CAST(h.fee AS DOUBLE) AS hq_fee, x.fx_rate, x.fx_rate_ex, CAST(m.margin AS DOUBLE) AS margin,
  CAST(cl.csc AS DOUBLE) AS csc
  FROM cands c
  LEFT JOIN (SELECT sku90pn, period, sum(opp_rebate) AS u FROM opp_rebate GROUP BY ALL) op ON op.sku90pn = c.part_number AND op.period = c.period
  LEFT JOIN (SELECT part_number, period, sum(extra_rebate) AS u FROM extra GROUP BY ALL) ex ON ex.part_number = c.part_number AND ex.period = c.period
  LEFT JOIN (SELECT part_number, period, sum(reb) AS u FROM sellout GROUP BY ALL) so ON so.part_number = c.part_number AND so.period = c.period
  LEFT JOIN e_os os ON os.part_number = c.part_number AND os.period = c.period
  LEFT JOIN (SELECT part_number, period, {_ratio('sum(freight_amt)', 'sum(all_qty)')} AS u FROM sim GROUP BY ALL) fr
    ON fr.part_number = c.part_number AND fr.period = c.period
  LEFT JOIN (SELECT product_line, period, max(acc_hqshipfee) AS fee FROM hq_ship_fee GROUP BY ALL) h
    ON h.product_line = c.product_line_id AND h.period = c.period
  LEFT JOIN fx_rates x ON x.product_line = c.product_line_id AND x.period = c.period
  LEFT JOIN (SELECT product_line, warranty, ledger_short_name, period, max(reserve_margin) AS margin FROM csc_percentage
             WHERE country_code = 'CN' GROUP BY ALL) m
    ON m.product_line = c.product_line_id AND m.warranty = c.warranty AND m.ledger_short_name = c.ou AND m.period = c.period
  LEFT JOIN (SELECT product_line, channel_code, period, max(csc) AS csc FROM csc_local GROUP BY ALL) cl ON cl.product_line = c.product_line_id
    AND cl.channel_code = CASE WHEN c.business_type = 'REFURBISH' THEN c.business_type ELSE c.business_type || '-' || c.country_code END
    AND cl.period = c.period),
e2 AS (SELECT *, CASE WHEN source = 'ACCRAW' THEN margin ELSE {ratio} END AS csc_ratio, {waterfall_sql('hq_asc')} AS hq_asc,
  {waterfall_sql('hq_asc_fxdiff')} AS hq_asc_fxdiff FROM e1),
mapped AS (SELECT {', '.join(GP.PASSED)}, {', '.join(GP.CANDIDATES)},
  model, segment, gpu, cpu_vendor, cpu_platform, cpu_sku, lcd_code, cpu_n, acc_segment, is_cte, csc_ratio,
  CASE WHEN source = 'ACCRAW' THEN {_ratio('revenue_rmb * csc_ratio', 'fx_rate')} ELSE {other('revenue_usd_hedge_rate')} END AS csc_amt,
  CASE WHEN source = 'ACCRAW' THEN {_ratio('revenue_rmb * csc_ratio', 'fx_rate_ex')} ELSE {other('revenue_fxdiff')} END AS csc_amt_fxdiff,
  CASE WHEN source = 'ACCRAW' THEN revenue_rmb * csc_ratio END AS csc_amt_rmb,
  CASE WHEN source = 'ACCRAW' THEN hq_fee END AS ship_fee_hq, CASE WHEN source = 'ACCRAW' THEN hq_fee * qty END AS total_ship_fee_hq,
  CASE WHEN source = 'ACCRAW' THEN total_ship_fee_company + hq_fee * qty ELSE freight_unit * qty END AS total_ship_fee,
  CASE WHEN source = 'ACCRAW' THEN total_ship_fee_company_fxdiff + hq_fee * qty ELSE freight_unit * qty END AS total_ship_fee_fxdiff,
  hq_asc, hq_asc_fxdiff, hq_asc * qty AS cogs_amount, hq_asc_fxdiff * qty AS cogs_amount_fxdiff,
  {amount('opp_unit')} AS opp_amount, {amount('extra_unit')} AS extra_rebate, {amount('sellout_unit')} AS nv_sellout_rebate,
  {amount('os_unit')} AS os_incentive FROM e2)"""


def _z(x):
    return f"coalesce(CAST({x} AS DOUBLE), 0.0)"


GP_SQL = f"""g1 AS (SELECT *,
  {_z('revenue_usd_hedge_rate')} - {_z('credit_note_hedge_rate')} - {_z('local_cogs_amount')} - {_z('total_ship_fee_company')} - {_z('csc_amt')} AS local_gp,
  {_z('revenue_fxdiff')} - {_z('credit_note_fxdiff')} - {_z('local_cogs_amount_fxdiff')} - {_z('total_ship_fee_company_fxdiff')} - {_z('csc_amt_fxdiff')} AS local_gp_fxdiff,
  {_z('net_revenue_usd_agp')} - {_z('cogs_amount')} - {_z('total_ship_fee')} - {_z('csc_amt')} AS gp_pod,
  {_z('net_revenue_fxdiff')} - {_z('cogs_amount_fxdiff')} - {_z('total_ship_fee_fxdiff')} - {_z('csc_amt_fxdiff')} AS gp_pod_fxdiff
  FROM mapped),
g2 AS (SELECT *, gp_pod - local_gp AS hq_gp, gp_pod_fxdiff - local_gp_fxdiff AS hq_gp_usd_fxdiff,
  gp_pod + {_z('extra_rebate')} + {_z('nv_sellout_rebate')} + {_z('funding')}
    + CASE WHEN product_line_id <> 'NV' THEN {_z('os_incentive')} ELSE 0.0 END AS gp_net,
  gp_pod_fxdiff + {_z('extra_rebate')} + {_z('nv_sellout_rebate')} + {_z('funding')}
    + CASE WHEN product_line_id <> 'NV' THEN {_z('os_incentive')} ELSE 0.0 END AS gp_net_fxdiff FROM g1),
g3 AS (SELECT *, CASE WHEN all_qty = 0 OR all_qty IS NULL THEN 0.0 ELSE hq_gp / CAST(all_qty AS DOUBLE) END AS hq_gp_unit,
  CASE WHEN all_qty = 0 OR all_qty IS NULL THEN 0.0 ELSE hq_gp_usd_fxdiff / CAST(all_qty AS DOUBLE) END AS hq_gp_unit_fxdiff
  FROM g2),
g4 AS (SELECT *, {_z('hq_asc')} + hq_gp_unit AS hq_asp, {_z('hq_asc_fxdiff')} + hq_gp_unit_fxdiff AS hq_asp_fxdiff FROM g3),
g5 AS (SELECT *, hq_asp * {_z('all_qty')} AS hq_rev, hq_asp_fxdiff * {_z('all_qty')} AS hq_rev_usd_fxdiff FROM g4),
g6 AS (SELECT g5.*, r.fx_rate AS rmb_fx_rate FROM g5 LEFT JOIN (SELECT product_line, period, max(fx_rate) AS fx_rate FROM fx_rates GROUP BY ALL) r
  ON g5.product_line_id = r.product_line AND g5.period = r.period),
g6b AS (SELECT *,
  CASE WHEN source = 'ACCRAW' THEN {_z('total_ship_fee_company_rmb')} + {_z('total_ship_fee_hq')} * {_z('rmb_fx_rate')} END AS total_ship_fee_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('cogs_amount')} * {_z('rmb_fx_rate')} END AS cogs_amount_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('opp_amount')} * {_z('rmb_fx_rate')} END AS opp_amount_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('extra_rebate')} * {_z('rmb_fx_rate')} END AS extra_rebate_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('nv_sellout_rebate')} * {_z('rmb_fx_rate')} END AS nv_sellout_rebate_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('funding')} * {_z('rmb_fx_rate')} END AS funding_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('os_incentive')} * {_z('rmb_fx_rate')} END AS os_incentive_rmb FROM g6),
g7 AS (SELECT *,
  CASE WHEN source = 'ACCRAW' THEN {_z('revenue_rmb')} - {_z('credit_note_rmb')} - {_z('local_cogs_amount_rmb')} - {_z('total_ship_fee_company_rmb')} - {_z('csc_amt_rmb')} END AS local_gp_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('revenue_rmb')} - {_z('credit_note_rmb')} - {_z('cogs_amount_rmb')} - {_z('total_ship_fee_rmb')} - {_z('csc_amt_rmb')} END AS gp_pod_rmb
  FROM g6b),
gp AS (SELECT *,
  CASE WHEN source = 'ACCRAW' THEN {_z('gp_pod_rmb')} - {_z('local_gp_rmb')} END AS hq_gp_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_z('gp_pod_rmb')} + {_z('extra_rebate_rmb')} + {_z('nv_sellout_rebate_rmb')} + {_z('funding_rmb')} + {_z('os_incentive_rmb')} END AS gp_net_rmb
  FROM g7)"""


def _chain(monthly: bool, upto: str) -> str:
    parts = {"local": local_sql(monthly), "cands": candidates_sql(),
             "mapped": f"{ITEM_MAP_SQL}, {EXTRA_SQL}, {SELLOUT_SQL}, {enriched_sql(monthly)}", "gp": GP_SQL}
    names = list(parts)
    return "WITH " + ",\n".join(parts[n] for n in names[:names.index(upto) + 1])


_CONTRACT = ", ".join(ACCUM_CONTRACT)
_DOUBLES = set(ACCUM_CONTRACT[ACCUM_CONTRACT.index("revenue_usd_hedge_rate"):]) - {
    "cost_period", "model", "segment", "gpu", "cpu_vendor", "cpu_platform", "cpu_sku", "lcd_code", "cpu_n", "acc_segment", "is_cte"}


def _contract_from_gp(name: str) -> str:
    cols = [f"CAST(CAST(floor(CAST({c} AS DOUBLE) * 1000000.0 + 0.5) / 1000000.0 AS DECIMAL(38,6)) AS VARCHAR) AS {c}"
            if c in _DOUBLES else f"CAST({c} AS VARCHAR) AS {c}" for c in ACCUM_CONTRACT]
    return f"SELECT {', '.join(cols)} FROM {name}"

# ---------------------------------------------------------------- registered queries


@query("local_data_monthly", _LOCAL_VIEWS, f"""{_chain(True, 'local')}
SELECT * FROM local_data""")
def local_data_monthly_q(t):
    """D10 monthly over the stored facts: fees, cost period, funding, credit note by the rule cascade, net revenue."""
    return local(t, True)


@query("local_data_weekly", _LOCAL_VIEWS, f"""{_chain(False, 'local')}
SELECT * FROM local_data""")
def local_data_weekly_q(t):
    """D10 weekly: the sheet's own credit note, funding also for negative quantities."""
    return local(t, False)


@query("candidate_costs", _VIEWS, f"""{_chain(True, 'cands')}
SELECT l_orderkey, l_linenumber, part_number, {', '.join(GP.CANDIDATES)} FROM cands""")
def candidate_costs_q(t):
    """D22 (+J11 per row): candidate costs of all families, exact and latest, both sets."""
    return candidates(t).select("l_orderkey", "l_linenumber", "part_number", *[F.col(c).cast("double").alias(c) for c in GP.CANDIDATES])


@query("cost_waterfall", _VIEWS, f"""{_chain(True, 'cands')}
SELECT l_orderkey, l_linenumber, part_number, {waterfall_sql('hq_asc')} AS hq_asc, {waterfall_sql('hq_asc_fxdiff')} AS hq_asc_fxdiff FROM cands""")
def cost_waterfall_q(t):
    """Per (source, cost mode) ordered COALESCE over the candidate costs, 8, 4 and 5 or 8, 6 and 5 of them."""
    return candidates(t).select("l_orderkey", "l_linenumber", "part_number", *[GP.cost_waterfall(w).alias(w) for w in GP.COST_WATERFALL])


@query("enriched_monthly", _VIEWS, f"""{_chain(True, 'mapped')}
SELECT * FROM mapped""")
def enriched_monthly_q(t):
    """D23 monthly: all lookups fused per key set, waterfalls, per-unit amounts (negative qty → 0)."""
    return enriched(t, True)


@query("enriched_weekly", _VIEWS, f"""{_chain(False, 'mapped')}
SELECT * FROM mapped""")
def enriched_weekly_q(t):
    """D23 weekly: as monthly but no quantity clamp, and the USD source's CSC from the sheet."""
    return enriched(t, False)


@query("gross_profit", _VIEWS, f"""{_chain(True, 'gp')}
SELECT {', '.join(GP_COLUMNS)} FROM gp""")
def gross_profit_q(t):
    """D24 (flagship): eight-stage gross profit over the monthly enriched fact."""
    return gross(t, True).select(*GP_COLUMNS)


def newest(t, mapped):
    """The rows of the fact's newest period: the batch that an accumulator takes in."""
    return mapped.where(F.col("period") == max_of(t["sales_detail"], "period"))


_HISTORY = """batch AS (SELECT * FROM gp WHERE period = (SELECT max(period) FROM sales_detail)),
hist AS (SELECT * FROM gp_weekly_accum WHERE ds = (SELECT max(ds) FROM gp_weekly_accum)),
keep AS (SELECT * FROM hist h WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.period = h.period))"""


@query("monthly_accum", _ACCUM_VIEWS, f"""{_chain(True, 'gp')},
{_HISTORY}
SELECT *, '{LOAD_TIME}' AS dw_ins_time, '{BATCH_DS}' AS ds FROM (
  SELECT {_CONTRACT} FROM keep UNION ALL {_contract_from_gp('batch')}) u""")
def monthly_accum_q(t):
    """The weekly accumulator's latest snapshot without the batch's period ∪ the batch (93 text columns); the
    batch is the newest period."""
    return GP.accumulate(t["gp_weekly_accum"], _text_ready(newest(t, gross(t, True))), BATCH_DS, F.lit(LOAD_TIME))


@query("weekly_accum", _ACCUM_VIEWS, f"""{_chain(False, 'gp')},
{_HISTORY},
weekly AS (SELECT {_CONTRACT} FROM keep UNION ALL {_contract_from_gp('batch')}),
mon AS (SELECT * FROM gp_monthly_accum WHERE ds = (SELECT max(ds) FROM gp_monthly_accum)),
restated AS (SELECT coalesce(max(period), '') AS p FROM mon)
SELECT *, '{LOAD_TIME}' AS dw_ins_time, '{BATCH_DS}' AS ds FROM (
  SELECT * FROM weekly WHERE period IS DISTINCT FROM (SELECT p FROM restated)
  UNION ALL SELECT {_CONTRACT} FROM mon WHERE period = (SELECT p FROM restated)) u""")
def weekly_accum_q(t):
    """Weekly accumulator whose restated month is taken from the monthly accumulator."""
    batch = _text_ready(newest(t, gross(t, False)))
    return GP.weekly_accumulate(t["gp_weekly_accum"], batch, t["gp_monthly_accum"], BATCH_DS, F.lit(LOAD_TIME))
