"""Combined fact, candidate costs, enriched fact, gross profit and accumulators.

* D10 computes the fact's currency amounts, shipping fee, cost period, funding, credit note and net revenue.
* D22 describes every cost family as a :class:`~ledgerlake.operators.fusion.Series` per key shape (part, model + cpu,
  branch + model + cpu): averages and SUM/SUM ratios, the exact period and the latest at or before the row's own
  period (the reference's single batch anchor is the special case of a one-period batch), with the second (``_ex``) set.
* D23 attaches all lookups by :mod:`ledgerlake.operators.fusion`: one table and one join per key set.
* D24 is eight dependent projection stages plus one FX lookup.
* D25/D26 replace the batch's periods in the stored accumulator and write the all-text contract.

Amounts derived from ratios (FX division, averaged costs) are DOUBLE; see README "Numeric semantics".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.cleanse import stringify_contract
from ledgerlake.operators.fusion import Fused, Series, Value, attach, fuse
from ledgerlake.operators.lookup import shuffled
from ledgerlake.plans.ingest import NEWEST_FIRST, RANGE_LINES, credit_note_rate
from ledgerlake.sources.adapters import ACCUM_CONTRACT
from ledgerlake.sources.snapshot import latest_snapshot


def _d(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def z(x) -> Column:
    """NULL → 0 (DOUBLE)."""
    return F.coalesce(_d(x), F.lit(0.0))


def per_unit_ratio(num, den) -> Column:
    d = _d(den)
    return F.when(d != 0, _d(num) / d)


# fixed values: customer names by keyword, first match wins; the monthly and the weekly load name one of them differently
CUSTOMERS = {"WALMART": "Walmart", "BEST BUY": "BBY", "AMAZON": "Amazon", "TARGET": "Target", "STAPLES": "Staples",
             "COSTCO": "Costco", "SAMS": "Sam's Club"}
WEEKLY_CUSTOMERS = CUSTOMERS | {"BEST BUY": "Best Buy"}
OTHER_CUSTOMER = "Others"
# fixed values: second-level branches of the USD source by keyword, first match wins
BRANCHES = {"RETAIL": "ACI-Retail", "CA": "CA", "MX": "ACMX", "SA": "Channel-SA"}
OTHER_BRANCH = "Channel-US"
RMB_BRANCH = "ACC"


def by_keyword(text: str, names: dict[str, str], default: str) -> Column:
    """The name of the first keyword that the upper-cased text holds."""
    return F.coalesce(*[F.when(F.contains(F.upper(text), F.lit(k)), F.lit(v)) for k, v in names.items()], F.lit(default))


# the columns of the combined fact that later stages read, in order
LOCAL_COLUMNS = [
    "l_orderkey", "l_linenumber", "source", "product_line_id", "year", "quarter", "month", "period", "sold_to_customer", "customer",
    "order_type", "business_type", "product_type", "distribution", "distribution_type", "territory", "territory2", "branch",
    "branch2", "country_id", "country_chinese", "country_code", "ou", "warranty", "csid", "part_number", "description", "all_qty",
    "revenue_usd_hedge_rate", "revenue_fxdiff", "net_revenue_usd_agp", "net_revenue_fxdiff", "local_cogs_amount",
    "local_cogs_amount_fxdiff", "credit_note_hedge_rate", "credit_note_fxdiff", "total_ship_fee_company",
    "total_ship_fee_company_fxdiff", "total_ship_fee_company_rmb", "cost_period", "funding", "revenue_rmb", "net_revenue_rmb",
    "local_cogs_amount_rmb", "credit_note_rmb", "sheet_csc_ratio", "sheet_csc_amt"]


def local_data(sales: DataFrame, fx: DataFrame, freight: DataFrame, funding: DataFrame, ranges: DataFrame, rates: DataFrame,
               monthly: bool) -> DataFrame:
    """D10 with D5-D9: the combined fact of both sources.

    RMB amounts are converted at the hedge and the ex rate, USD amounts kept; a rate of 0 gives NULL.  Shipping fee =
    -(freight per unit x quantity); cost period by the (part, version) ranges; funding per unit x quantity (monthly: none for
    negative quantities); credit note: monthly the rate of the rule cascade x revenue, weekly the sheet's own amount;
    net revenue = revenue - credit note, NULL as 0."""
    acc = F.col("source") == "ACCRAW"
    # the tables per part first: the sales rows are shuffled for them, and what is derived from a row need not travel
    f = attach(sales, fuse([
        Series(funding.withColumn("pn", F.trim("pn")), {"part_number": "pn"}, "max", "funding", exact={"funding_unit": "period"}),
        Series(ranges.withColumns({"pn": F.trim("pn"), "version": F.trim("version")}), {"part_number": "pn"}, "max", "cost_range",
               period="version", exact={"__range": "period"})]))
    f = f.withColumns({
        "customer": F.when(~acc, by_keyword("sold_to_customer", CUSTOMERS if monthly else WEEKLY_CUSTOMERS, OTHER_CUSTOMER)),
        "branch2": F.when(acc, F.lit(RMB_BRANCH)).otherwise(by_keyword("branch", BRANCHES, OTHER_BRANCH)),
        "__team": F.upper(F.trim("branch"))})
    f = attach(f, fuse([
        Value(fx, {"product_line_id": "product_line", "period": "period"}, {"fx_rate": "fx_rate", "fx_rate_ex": "fx_rate_ex"}),
        Value(freight.withColumn("team", F.upper(F.trim("sales_team"))),
              {"product_line_id": "product_line", "__team": "team", "period": "period"}, {"freight": "freight"})]))
    if monthly:
        f = credit_note_rate(f, rates, F.col("ou"), F.col("branch2"), F.col("customer"))
    ranged = F.lit(False)
    for source, lines in RANGE_LINES.items():
        ranged = ranged | ((F.col("source") == source) & F.upper("product_line_id").isin(lines))
    qty, fee = _d("all_qty"), -(_d("freight") * _d("all_qty"))

    def converted(amount: Column, rate: str) -> Column:
        return F.when(acc, per_unit_ratio(amount, rate)).otherwise(amount)

    f = f.withColumns({
        "revenue_usd_hedge_rate": converted(_d("revenue"), "fx_rate"), "revenue_fxdiff": converted(_d("revenue"), "fx_rate_ex"),
        "revenue_rmb": F.when(acc, _d("revenue")),
        "local_cogs_amount": converted(_d("local_cogs"), "fx_rate"),
        "local_cogs_amount_fxdiff": converted(_d("local_cogs"), "fx_rate_ex"), "local_cogs_amount_rmb": F.when(acc, _d("local_cogs")),
        "total_ship_fee_company": converted(fee, "fx_rate"), "total_ship_fee_company_fxdiff": converted(fee, "fx_rate_ex"),
        "total_ship_fee_company_rmb": F.when(acc, fee),
        "cost_period": F.when(ranged, F.coalesce("__range", F.lit(NEWEST_FIRST))).otherwise(F.lit(NEWEST_FIRST)),
        "funding": _d("funding_unit") * (F.when(qty < 0, F.lit(0.0)).otherwise(qty) if monthly else qty)})
    if monthly:
        notes = {"credit_note_hedge_rate": _d("cn") * z("revenue_usd_hedge_rate"), "credit_note_fxdiff": _d("cn") * z("revenue_fxdiff"),
                 "credit_note_rmb": F.when(acc, _d("cn") * z("revenue_rmb"))}
    else:
        note = _d("sheet_credit_note")
        notes = {"credit_note_hedge_rate": converted(note, "fx_rate"), "credit_note_fxdiff": converted(note, "fx_rate_ex"),
                 "credit_note_rmb": F.when(acc, note)}
    f = f.withColumns(notes)
    f = f.withColumns({
        "net_revenue_usd_agp": z("revenue_usd_hedge_rate") - z("credit_note_hedge_rate"),
        "net_revenue_fxdiff": z("revenue_fxdiff") - z("credit_note_fxdiff"),
        "net_revenue_rmb": F.when(acc, z("revenue_rmb") - z("credit_note_rmb"))})
    return f.select(*[c for c in LOCAL_COLUMNS if c in f.columns])


# fixed values: territories of the simulation rows per source
TERRITORIES = {"ACCRAW": ["CHINA"], "ACIRAW": ["NA", "LATAM"]}

PART = {"part_number": "part_number"}
MODEL = {"model": "model_name", "cpu_sku": "cpu"}
SIM_MODEL = {"model": "model", "cpu_sku": "cpu_sku"}
BRANCH = {"branch": "sales_team"} | MODEL


def cost_families(cost_pn: DataFrame, cost_pn_ex: DataFrame, simulation: DataFrame, aci_cost: DataFrame, aci_cost_ex: DataFrame,
                  cost_branch: DataFrame, cost_branch_ex: DataFrame) -> list[Series]:
    """The candidate costs of all families and both sets, as series for :func:`fuse`.

    Standard and ex item costs are averages per part and per model + cpu, exact at the row's cost period; simulation costs
    are SUM/SUM per unit and source, exact at the row's period; the USD source's own costs are exact only, the
    branches' averages latest only.  Simulation columns carry their source as a suffix until :func:`per_source`."""
    out = []
    for table, sfx in ((cost_pn, ""), (cost_pn_ex, "_ex")):
        for on, shape in ((PART, "hqpn"), (MODEL, "hqmodelcpu")):
            out.append(Series(table, on, "mean", "item_cost_usd", exact={f"item_cost_usd_{shape}{sfx}": "cost_period"},
                              latest={f"item_cost_usd_{shape}_max{sfx}": "period"}))
    for source, territories in TERRITORIES.items():
        rows = simulation.where(F.col("territory").isin(territories)).withColumn("month", F.substring("estimate_revenue_date", 1, 6))
        for on, shape in ((PART, "1179pn"), (SIM_MODEL, "1179modelcpu")):
            for value, sfx in (("cogs_amount", ""), ("cogs_amount_fxdiff", "_fxdiff")):
                out.append(Series(rows, on, "ratio", value, "all_qty", "month",
                                  exact={f"cogs_amount_{shape}{sfx}|{source}": "period"},
                                  latest={f"cogs_amount_{shape}_max{sfx}|{source}": "period"}))
    for table, sfx in ((aci_cost, ""), (aci_cost_ex, "_ex")):
        out.append(Series(table, {"part_number": "item"}, "max", "item_cost_usd", exact={f"aci_cost_item_cost_usd{sfx}": "period"}))
    for table, sfx in ((cost_branch, ""), (cost_branch_ex, "_ex")):
        out.append(Series(table, BRANCH, "mean", "item_cost_usd", latest={f"hq_model_cpu_branch_item_cost_usd{sfx}": "period"}))
    return out


CANDIDATES = [f"{name}{sfx}" for sfx, sim in (("", ""), ("_ex", "_fxdiff")) for name in (
    "item_cost_usd_hqpn", "item_cost_usd_hqpn_max", "item_cost_usd_hqmodelcpu", "item_cost_usd_hqmodelcpu_max",
    "aci_cost_item_cost_usd", "hq_model_cpu_branch_item_cost_usd")] + [
    f"cogs_amount_1179{shape}{sfx}" for sfx in ("", "_fxdiff") for shape in ("pn", "pn_max", "modelcpu", "modelcpu_max")]


def per_source(f: DataFrame) -> DataFrame:
    """The simulation candidates of the row's own source."""
    names = sorted({c.split("|")[0] for c in f.columns if "|" in c})
    picked = {n: F.coalesce(*[F.when(F.col("source") == s, _d(F.col(f"`{n}|{s}`"))) for s in TERRITORIES]) for n in names}
    return f.withColumns(picked).drop(*[c for c in f.columns if "|" in c])


# fixed values: the candidates per (source, cost mode) in order, for the costs and for the costs at the ex rate
COST_WATERFALL = {
    "hq_asc": {
        ("ACCRAW", "exact"): ["item_cost_usd_hqpn", "item_cost_usd_hqpn_max", "item_cost_usd_hqmodelcpu", "item_cost_usd_hqmodelcpu_max",
                              "cogs_amount_1179pn", "cogs_amount_1179pn_max", "cogs_amount_1179modelcpu",
                              "cogs_amount_1179modelcpu_max"],
        ("ACCRAW", "newest"): ["item_cost_usd_hqpn_max", "item_cost_usd_hqmodelcpu_max", "cogs_amount_1179pn_max",
                               "cogs_amount_1179modelcpu_max"],
        ("ACIRAW", None): ["aci_cost_item_cost_usd", "item_cost_usd_hqpn_max", "hq_model_cpu_branch_item_cost_usd",
                           "cogs_amount_1179pn_max", "cogs_amount_1179modelcpu_max"],
    },
    "hq_asc_fxdiff": {
        ("ACCRAW", "exact"): ["item_cost_usd_hqpn_ex", "item_cost_usd_hqpn_max_ex", "item_cost_usd_hqmodelcpu_ex",
                              "item_cost_usd_hqmodelcpu_max_ex", "cogs_amount_1179pn_fxdiff", "cogs_amount_1179pn_max_fxdiff",
                              "cogs_amount_1179modelcpu_fxdiff", "cogs_amount_1179modelcpu_max_fxdiff"],
        ("ACCRAW", "newest"): ["item_cost_usd_hqpn_max_ex", "item_cost_usd_hqmodelcpu_max_ex", "cogs_amount_1179pn_fxdiff",
                               "cogs_amount_1179pn_max_fxdiff", "cogs_amount_1179modelcpu_fxdiff",
                               "cogs_amount_1179modelcpu_max_fxdiff"],
        ("ACIRAW", None): ["aci_cost_item_cost_usd_ex", "item_cost_usd_hqpn_max_ex", "hq_model_cpu_branch_item_cost_usd_ex",
                           "cogs_amount_1179pn_max_fxdiff", "cogs_amount_1179modelcpu_max_fxdiff"],
    },
}


def cost_waterfall(which: str) -> Column:
    """Per (source, cost mode) a different ordered COALESCE of candidates; a NULL cost period of the RMB source
    has no mode and no cost."""
    newest = F.col("cost_period") == NEWEST_FIRST
    modes = {"exact": ~newest, "newest": newest, None: F.lit(True)}
    return F.coalesce(*[F.when((F.col("source") == source) & modes[mode], F.coalesce(*[_d(c) for c in names]))
                        for (source, mode), names in COST_WATERFALL[which].items()])


def enrichment(part_attrs: DataFrame, simulation: DataFrame, hq_fee: DataFrame, opp: DataFrame, extra: DataFrame,
               sellout: DataFrame, incentives: DataFrame, item_map: DataFrame, csc: DataFrame, csc_local: DataFrame, fx: DataFrame,
               costs: Sequence[Series]) -> list[Fused]:
    """J1 of D23: all lookups of the enriched fact, fused per key set.  Stored snapshots are read at their latest day;
    incentives per component reach finished parts through the component map (J16-J18)."""
    attrs = {"model": "model_name", "segment": "segmentation", "gpu": "gpu", "cpu_vendor": "cpu_vendor", "cpu_platform": "cpu_platform",
             "cpu_sku": "cpu", "lcd_code": "lcd_code", "cpu_n": "cpu_n", "acc_segment": "acc_segment", "is_cte": "cte"}
    sim = simulation.withColumns({"month": F.substring("estimate_revenue_date", 1, 6), "freight_amt": F.col("freight_cost") * F.col("all_qty")})
    to_parts = item_map.select(F.col("item_no").alias("os_part_number"), "part_number").where("part_number IS NOT NULL").distinct()
    line = {"product_line_id": "product_line", "period": "period"}
    return fuse([
        Value(latest_snapshot(part_attrs), PART, attrs),
        Series(opp, {"part_number": "sku90pn"}, "sum", "opp_rebate", exact={"opp_unit": "period"}),
        Series(extra, PART, "sum", "extra_rebate", exact={"extra_unit": "period"}),
        Series(sellout, PART, "sum", "reb", exact={"sellout_unit": "period"}),
        Series(sim, PART, "ratio", "freight_amt", "all_qty", "month", exact={"freight_cost_unit": "period"}),
        Series(latest_snapshot(incentives).join(shuffled(to_parts), "os_part_number"), PART, "max", "inc", exact={"os_unit": "period"}),
        Value(hq_fee, line, {"acc_hqshipfee": "acc_hqshipfee"}),
        Value(fx, line, {"fx_rate": "fx_rate", "fx_rate_ex": "fx_rate_ex"}),
        Value(csc.where(F.col("country_code") == "CN"), line | {"warranty": "warranty", "ou": "ledger_short_name"},
              {"reserve_margin": "reserve_margin"}),
        Value(csc_local, line | {"__channel": "channel_code"}, {"csc_local": "csc"}),
        *costs])


# the columns of the enriched fact that are the combined fact's own
PASSED = [c for c in LOCAL_COLUMNS if c not in ("country_code", "sheet_csc_ratio", "sheet_csc_amt")]


def with_candidates(local: DataFrame, fused: Sequence[Fused]) -> DataFrame:
    """The combined fact with every lookup and candidate cost."""
    refurbish = F.col("business_type") == "REFURBISH"
    channel = F.when(refurbish, F.col("business_type")).otherwise(F.concat("business_type", F.lit("-"), "country_code"))
    return per_source(attach(local.withColumn("__channel", channel), fused))


def enriched_fact(local: DataFrame, fused: Sequence[Fused], monthly: bool) -> DataFrame:
    """The enriched fact.  Monthly takes 0 for the per-unit amounts of negative quantities (C11) and the USD
    source's CSC ratio from the channel table; weekly takes ratio and amount from the sheet."""
    f = with_candidates(local, fused)
    acc, qty = F.col("source") == "ACCRAW", _d("all_qty")

    def amount(unit: str) -> Column:
        return F.when(qty < 0, F.lit(0.0)).otherwise(_d(unit) * qty) if monthly else _d(unit) * qty

    fee, other_fee = _d("acc_hqshipfee"), _d("freight_cost_unit") * qty
    ratio = F.when(acc, _d("reserve_margin")).otherwise(_d("csc_local") if monthly else _d("sheet_csc_ratio"))
    rmb_margin = _d("revenue_rmb") * ratio

    def csc(rate: str, revenue: str) -> Column:
        return F.when(acc, per_unit_ratio(rmb_margin, rate)).otherwise(_d(revenue) * ratio if monthly else _d("sheet_csc_amt"))

    asc, asc_fx = cost_waterfall("hq_asc"), cost_waterfall("hq_asc_fxdiff")
    return f.select(
        *PASSED, *[_d(c).alias(c) for c in CANDIDATES],
        "model", "segment", "gpu", "cpu_vendor", "cpu_platform", "cpu_sku", "lcd_code", "cpu_n", "acc_segment", "is_cte",
        ratio.alias("csc_ratio"), csc("fx_rate", "revenue_usd_hedge_rate").alias("csc_amt"),
        csc("fx_rate_ex", "revenue_fxdiff").alias("csc_amt_fxdiff"), F.when(acc, rmb_margin).alias("csc_amt_rmb"),
        F.when(acc, fee).alias("ship_fee_hq"), F.when(acc, fee * qty).alias("total_ship_fee_hq"),
        F.when(acc, _d("total_ship_fee_company") + fee * qty).otherwise(other_fee).alias("total_ship_fee"),
        F.when(acc, _d("total_ship_fee_company_fxdiff") + fee * qty).otherwise(other_fee).alias("total_ship_fee_fxdiff"),
        asc.alias("hq_asc"), asc_fx.alias("hq_asc_fxdiff"), (asc * qty).alias("cogs_amount"), (asc_fx * qty).alias("cogs_amount_fxdiff"),
        amount("opp_unit").alias("opp_amount"), amount("extra_unit").alias("extra_rebate"),
        amount("sellout_unit").alias("nv_sellout_rebate"), amount("os_unit").alias("os_incentive"))


def gross_profit(mapped: DataFrame, fx: DataFrame) -> DataFrame:
    """The eight-stage gross-profit calculation (formulas of SURVEY D24).

    Each stage reads the previous stage's columns; RMB figures only for the
    RMB source; the 'NV' incentive exclusion applies to USD only (q7)."""
    s1 = mapped.withColumns({
        "local_gp": z("revenue_usd_hedge_rate") - z("credit_note_hedge_rate") - z("local_cogs_amount")
        - z("total_ship_fee_company") - z("csc_amt"),
        "local_gp_fxdiff": z("revenue_fxdiff") - z("credit_note_fxdiff") - z("local_cogs_amount_fxdiff")
        - z("total_ship_fee_company_fxdiff") - z("csc_amt_fxdiff"),
        "gp_pod": z("net_revenue_usd_agp") - z("cogs_amount") - z("total_ship_fee") - z("csc_amt"),
        "gp_pod_fxdiff": z("net_revenue_fxdiff") - z("cogs_amount_fxdiff") - z("total_ship_fee_fxdiff")
        - z("csc_amt_fxdiff"),
    })
    os_usd = F.when(F.col("product_line_id") != "NV", z("os_incentive")).otherwise(F.lit(0.0))
    s2 = s1.withColumns({
        "hq_gp": F.col("gp_pod") - F.col("local_gp"),
        "hq_gp_usd_fxdiff": F.col("gp_pod_fxdiff") - F.col("local_gp_fxdiff"),
        "gp_net": F.col("gp_pod") + z("extra_rebate") + z("nv_sellout_rebate") + z("funding") + os_usd,
        "gp_net_fxdiff": F.col("gp_pod_fxdiff") + z("extra_rebate") + z("nv_sellout_rebate") + z("funding") + os_usd,
    })
    no_qty = (F.col("all_qty") == 0) | F.col("all_qty").isNull()
    s3 = s2.withColumns({
        "hq_gp_unit": F.when(no_qty, F.lit(0.0)).otherwise(F.col("hq_gp") / _d("all_qty")),
        "hq_gp_unit_fxdiff": F.when(no_qty, F.lit(0.0)).otherwise(F.col("hq_gp_usd_fxdiff") / _d("all_qty")),
    })
    s4 = s3.withColumns({"hq_asp": z("hq_asc") + F.col("hq_gp_unit"),
                         "hq_asp_fxdiff": z("hq_asc_fxdiff") + F.col("hq_gp_unit_fxdiff")})
    s5 = s4.withColumns({"hq_rev": F.col("hq_asp") * z("all_qty"),
                         "hq_rev_usd_fxdiff": F.col("hq_asp_fxdiff") * z("all_qty")})
    rate = latest_snapshot(fx) if "ds" in fx.columns else fx
    s6 = attach(s5, fuse([Value(rate, {"product_line_id": "product_line", "period": "period"}, {"rmb_fx_rate": "fx_rate"})]))
    acc = F.col("source") == "ACCRAW"
    fxr = z("rmb_fx_rate")
    s6 = s6.withColumns({
        "total_ship_fee_rmb": F.when(acc, z("total_ship_fee_company_rmb") + z("total_ship_fee_hq") * fxr),
        "cogs_amount_rmb": F.when(acc, z("cogs_amount") * fxr),
        "opp_amount_rmb": F.when(acc, z("opp_amount") * fxr),
        "extra_rebate_rmb": F.when(acc, z("extra_rebate") * fxr),
        "nv_sellout_rebate_rmb": F.when(acc, z("nv_sellout_rebate") * fxr),
        "funding_rmb": F.when(acc, z("funding") * fxr),
        "os_incentive_rmb": F.when(acc, z("os_incentive") * fxr),
    })
    s7 = s6.withColumns({
        "local_gp_rmb": F.when(acc, z("revenue_rmb") - z("credit_note_rmb") - z("local_cogs_amount_rmb")
                               - z("total_ship_fee_company_rmb") - z("csc_amt_rmb")),
        "gp_pod_rmb": F.when(acc, z("revenue_rmb") - z("credit_note_rmb") - z("cogs_amount_rmb")
                             - z("total_ship_fee_rmb") - z("csc_amt_rmb")),
    })
    return s7.withColumns({
        "hq_gp_rmb": F.when(acc, z("gp_pod_rmb") - z("local_gp_rmb")),
        "gp_net_rmb": F.when(acc, z("gp_pod_rmb") + z("extra_rebate_rmb") + z("nv_sellout_rebate_rmb")
                             + z("funding_rmb") + z("os_incentive_rmb")),
    })


def accumulate(history: DataFrame, batch: DataFrame, ds: str, load_time: Column) -> DataFrame:
    """The stored accumulator (latest snapshot) without the batch's periods
    ∪ the batch, as the all-text contract with audit columns (U5 + K9 + K7).

    The batch's period set is bounded by the calendar and broadcast: Spark cannot tell
    its size from the batch's plan and would move the whole history to its few periods."""
    hist = latest_snapshot(history)
    periods = batch.select("period").distinct()
    keep = hist.join(F.broadcast(periods), "period", "left_anti")
    new = stringify_contract(batch, ACCUM_CONTRACT)
    out = stringify_contract(keep, ACCUM_CONTRACT).unionByName(new)
    return out.withColumns({"dw_ins_time": load_time, "ds": F.lit(ds)})


def weekly_accumulate(weekly_history: DataFrame, batch: DataFrame, monthly_accum: DataFrame, ds: str,
                      load_time: Column) -> DataFrame:
    """Weekly accumulator whose restated month comes from the monthly
    accumulator: provisional periods except the monthly table's latest period
    ∪ the monthly rows of that period (U6, NULL-safe when monthly is empty)."""
    weekly = accumulate(weekly_history, batch, ds, load_time).drop("dw_ins_time", "ds")
    monthly = latest_snapshot(monthly_accum)
    restated = F.coalesce(monthly.select(F.max("period")).scalar(), F.lit(""))
    mrows = stringify_contract(monthly.where(F.col("period") == restated), ACCUM_CONTRACT)
    out = weekly.where(~F.col("period").eqNullSafe(restated)).unionByName(mrows)
    return out.withColumns({"dw_ins_time": load_time, "ds": F.lit(ds)})
