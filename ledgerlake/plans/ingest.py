"""Ingest facts (D1-D12): uploaded sales sheets → cleaned, classified,
FX-converted fact rows in a fixed contract, and the smaller sheet loaders.

Every step is a column expression or a key-deduplicated lookup join; the
reference's row-wise ``apply`` / ``iterrows`` become built-in expressions.
Ratios (FX conversions) are DOUBLE computed from exact decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import text as X
from ledgerlake.functions.dates import (
    normalize_period, period_month, period_quarter, period_year, safe_number, serial_or_text_date,
)
from ledgerlake.operators import lookup as L
from ledgerlake.operators import rules as R
from ledgerlake.operators.aggregate import mean, unpivot_matrix
from ledgerlake.operators.cleanse import enforce_contract, require_key

# fixed values: RMB-source exclusions and the retail bill-to suffix
ACC_ORDER_EXCLUDE = ["RTN", "RETURN", "DISCOUNT", "REJECT"]
ACC_SERIES_EXCLUDE = ["NB ACCY", "NR-ACCESSORY"]
RETAIL_SUFFIX = r"(BTC|BTC1|NC|3C)$"

ACC_WEEKLY_CONTRACT = [
    "source", "ou", "warranty", "org", "period", "year", "month", "quarter", "order_type", "bill_to_location",
    "csid", "item", "item_description", "quantity", "distribution_type", "distribution", "apply_prod_line",
    "revenue_rmb", "revenue_usd_hedge_rate", "revenue_fxdiff", "credit_note_rmb", "credit_note_hedge_rate",
    "credit_note_fxdiff", "net_revenue_rmb", "net_revenue_usd_agp", "net_revenue_fxdiff", "local_cogs_amount_rmb",
    "local_cogs_amount", "local_cogs_amount_fxdiff"]
ACC_MONTHLY_CONTRACT = [c for c in ACC_WEEKLY_CONTRACT
                        if not c.startswith("credit_note") and not c.startswith("net_revenue")]
ACI_WEEKLY_CONTRACT = [
    "source", "sheet", "sales_type", "part_no", "business_type", "territory", "territory2", "order_type", "branch",
    "period", "year", "month", "quarter", "country_id", "country_chinese", "cust_full_name", "quantity",
    "revenue_usd_hedge_rate", "net_revenue_usd_agp", "cogs_amount", "csc_unit_cost", "total_csc_cost"]
ACI_MONTHLY_CONTRACT = [
    "source", "region", "revenue_country", "type", "business_type", "product_line", "period", "year", "month",
    "quarter", "sold_to_customer", "item", "item_description", "quantity", "sales_amount", "material_cost_amt",
    "ar_trx_type", "country_chinese", "territory", "territory2", "order_type", "branch"]


def exact_double(x) -> Column:
    """An exact decimal (≤ 6 decimals) as DOUBLE, correctly rounded in any engine."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(38,6)").cast("double")


def fx_div(amount: Column, rate: str) -> Column:
    """Amount ÷ rate; zero or missing rate → NULL."""
    r = exact_double(F.col(rate))
    return F.when(r != 0, exact_double(amount) / r)


def _period_parts(df: DataFrame) -> DataFrame:
    df = df.withColumn("period", normalize_period("period"))
    return df.withColumns({"year": period_year("period"), "month": period_month("period"),
                           "quarter": period_quarter("period")})


def acc_fact(sheet: DataFrame, org_map: DataFrame, ordertype_map: DataFrame, dist_map: DataFrame, fx: DataFrame,
             monthly: bool) -> DataFrame:
    """D1 (weekly) / D2 (monthly): the RMB-source fact.

    Filters (keyword exclusion on order type, FG category or whole-unit flag,
    excluded series, '-M' items) → OU prefix → org and order-type map-or-keep →
    calendar parts → retail/channel class → distribution lookup → FX at the
    hedge and the ex rate.  Monthly negates the cost and has no credit note."""
    df = sheet.withColumn("source", F.lit("ACC"))
    df = R.keyword_exclude(df, "order_type", ACC_ORDER_EXCLUDE)
    df = df.where(F.trim("is_complete") == "Y") if monthly else df.where(F.trim("category") == "FG")
    df = df.where(~F.coalesce(F.trim("series").isin(ACC_SERIES_EXCLUDE), F.lit(False)))
    df = R.contains_filter(df, "item", "-M")
    df = df.withColumn("ou", X.left("ou", 4))
    df = L.map_or_keep(df, "org", L.dedupe_lookup(org_map, ["org"], ["product_type"]), "org", "product_type")
    df = _period_parts(df)
    df = L.map_or_keep(df, "order_type", L.dedupe_lookup(ordertype_map, ["order_type"], ["order_type2"]),
                       "order_type", "order_type2")
    df = df.withColumn("bill_to_location", R.regex_class("bill_to_location", RETAIL_SUFFIX, "Retail", "Channel"))
    df = df.withColumn("distribution_type", F.trim("class_code"))
    df = L.star_enrich(df, [
        L.LookupSpec(dist_map, {"distribution_type": "distribution_type"}, {"distribution": "distribution"}),
        L.LookupSpec(fx, {"product_line": "apply_prod_line", "period": "period"},
                     {"fx_rate": "fx_rate", "fx_rate_ex": "fx_rate_ex"}),
    ])
    rev = safe_number("sales_net" if monthly else "sales_revenue")
    cost = safe_number("sales_cost")
    cost = -cost if monthly else cost
    amounts = {
        "revenue_rmb": rev, "revenue_usd_hedge_rate": fx_div(rev, "fx_rate"), "revenue_fxdiff": fx_div(rev, "fx_rate_ex"),
        "local_cogs_amount_rmb": cost, "local_cogs_amount": fx_div(cost, "fx_rate"),
        "local_cogs_amount_fxdiff": fx_div(cost, "fx_rate_ex"),
    }
    if not monthly:
        cn = -safe_number("sales_discount")
        net = safe_number("sales_net")
        amounts.update({
            "credit_note_rmb": cn, "credit_note_hedge_rate": fx_div(cn, "fx_rate"),
            "credit_note_fxdiff": fx_div(cn, "fx_rate_ex"), "net_revenue_rmb": net,
            "net_revenue_usd_agp": fx_div(net, "fx_rate"), "net_revenue_fxdiff": fx_div(net, "fx_rate_ex")})
    df = df.withColumns(amounts)
    out = enforce_contract(df, ACC_MONTHLY_CONTRACT if monthly else ACC_WEEKLY_CONTRACT)
    return require_key(out, "period")


def _contains_ci(c: str, needle: str) -> Column:
    return F.coalesce(F.upper(F.col(c)).contains(needle.upper()), F.lit(False))


def aci_classify(df: DataFrame, sales_type: str, sales_group: str, region: str, country: str) -> DataFrame:
    """C4 cascades of the USD source: business type, territory, order type, branch."""
    st = F.upper(F.trim(F.col(sales_type)))
    rc = F.upper(F.trim(F.col(country)))
    sg = F.upper(F.trim(F.col(sales_group)))
    reg = F.upper(F.trim(F.col(region)))
    return df.withColumns({
        "business_type": R.override_cascade(F.col(sales_type), [
            (_contains_ci(sales_group, "Channel"), F.lit("Channel")),
            (_contains_ci(sales_group, "Refurbish"), F.lit("Refurbish")),
            (_contains_ci(sales_group, "Retail"), F.lit("Direct Retail"))]),
        "territory": R.override_cascade(reg, [(reg == "NA", F.lit("ACI")), (reg == "SA", F.lit("LATAM"))]),
        "territory2": R.override_cascade(reg, [(reg == "SA", F.lit("LATAM"))]),
        "order_type": R.override_cascade(F.lit("Standard"), [(st == "CSC", F.lit("CSC")),
                                                             (st == "REFURBISH", F.lit("Refurbish"))]),
        "branch": R.override_cascade(F.trim(F.col(sales_type)), [
            ((rc == "US") & (sg == "RETAIL"), F.lit("US-Retail")),
            (st == "CHANNEL-US", F.lit("US-CHANNEL")),
            (rc == "CA", F.lit("CA"))]),
    })


def country_chinese(df: DataFrame, countries: DataFrame, country: str, upper_keys: bool) -> DataFrame:
    """Chinese country name by id, else by name (weekly compares upper-cased
    keys, monthly the trimmed text as is)."""
    norm = (lambda c: F.upper(F.trim(c))) if upper_keys else (lambda c: F.trim(c))
    cn = countries.select(norm(F.col("country_id")).alias("cid"), norm(F.col("country_name")).alias("cname"),
                          "country_zh")
    return L.fallback_lookup(df, cn, [{"cid": norm(F.col(country))}, {"cname": norm(F.col(country))}],
                             "country_zh", "country_chinese")


def aci_weekly(sheet: DataFrame, countries: DataFrame) -> DataFrame:
    """D3: the USD-source weekly fact: CSC rows and non '-M' parts dropped,
    cascades, calendar parts, country name, net = revenue − credit note."""
    df = sheet.withColumn("source", F.lit("ACI"))
    df = df.where(F.coalesce(F.trim("sales_type") != "CSC", F.lit(True)))
    df = R.contains_filter(df, "part_no", "-M")
    df = aci_classify(df, "sales_type", "sales_group", "region", "revenue_country")
    df = _period_parts(df)
    df = df.withColumn("country_id", F.trim("revenue_country"))
    df = country_chinese(df, countries, "revenue_country", upper_keys=True)
    rev = F.coalesce(safe_number("revenue_amt"), F.lit(0).cast("decimal(38,15)"))
    cn = F.coalesce(safe_number("total_cn_amt"), F.lit(0).cast("decimal(38,15)"))
    df = df.withColumns({
        "quantity": safe_number("sales_qty_fg"), "revenue_usd_hedge_rate": rev,
        "net_revenue_usd_agp": (rev - cn).cast("decimal(38,15)"), "cogs_amount": safe_number("cogs_amt"),
        "csc_unit_cost": safe_number("csc_unit_cost"), "total_csc_cost": safe_number("total_csc_cost")})
    return enforce_contract(df, ACI_WEEKLY_CONTRACT)


def aci_monthly(sheet: DataFrame, countries: DataFrame) -> DataFrame:
    """The USD-source monthly fact ('Other' type dropped, '-M' items,
    product-line membership, cascades; the cost keeps its sign, q9)."""
    df = sheet.select(
        F.lit("ACI").alias("source"), "region", "revenue_country", F.col("sales_type").alias("type"),
        F.col("sales_group").alias("business_type_raw"), F.col("sheet").alias("product_line"), "period",
        F.col("cust_full_name").alias("sold_to_customer"), F.col("part_no").alias("item"), "item_description",
        F.col("sales_qty_fg").alias("quantity"), F.col("revenue_amt").alias("sales_amount"),
        F.col("cogs_amt").alias("material_cost_amt"), "ar_trx_type")
    df = df.where(F.coalesce(F.col("type") != "Other", F.lit(True)))
    df = R.contains_filter(df, "item", "-M")
    df = R.in_filter(df, "product_line", ["NB", "NR", "NV"], normalize="upper")
    df = aci_classify(df, "type", "business_type_raw", "region", "revenue_country")
    df = _period_parts(df)
    df = country_chinese(df, countries, "revenue_country", upper_keys=False)
    df = df.withColumns({"quantity": safe_number("quantity"), "sales_amount": safe_number("sales_amount"),
                         "material_cost_amt": safe_number("material_cost_amt")})
    return enforce_contract(df, ACI_MONTHLY_CONTRACT)


# what the combined fact takes from either source's fact; amounts in the source's own currency
SALES_COLUMNS = ["source", "product_line_id", "year", "quarter", "month", "period", "sold_to_customer", "order_type", "business_type",
                 "product_type", "distribution", "distribution_type", "territory", "territory2", "branch", "country_id",
                 "country_chinese", "country_code", "ou", "warranty", "csid", "part_number", "description", "all_qty", "revenue",
                 "local_cogs", "sheet_credit_note", "sheet_csc_ratio", "sheet_csc_amt"]
# fixed values: places of the RMB source
RMB_PLACE, RMB_COUNTRY, RMB_COUNTRY_NAME = "ACC", "CN", "中國大陸"


def combined_sales(acc: DataFrame, aci: DataFrame, monthly: bool) -> DataFrame:
    """U3 + P5 of D10: both sources' facts in one contract, as :func:`~ledgerlake.plans.grossprofit.local_data` reads it."""
    def amount(column) -> Column:
        return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,6)")

    def typed(**columns) -> list[Column]:
        missing = {c: F.lit(None).cast("decimal(20,6)" if c.startswith("sheet_") else "string") for c in SALES_COLUMNS}
        named = missing | {c: F.col(x) if isinstance(x, str) else x for c, x in columns.items()}
        return [named[c].alias(c) for c in SALES_COLUMNS]

    same = {c: c for c in ("year", "quarter", "month", "period", "order_type")}
    place, country = F.lit(RMB_PLACE), F.lit(RMB_COUNTRY)
    a = acc.select(*typed(
        **same, source=F.lit("ACCRAW"), product_line_id="apply_prod_line", business_type="bill_to_location", product_type="org",
        distribution="distribution", distribution_type="distribution_type", territory=place, territory2=place, branch=place,
        country_id=country, country_chinese=F.lit(RMB_COUNTRY_NAME), country_code=country, ou="ou", warranty="warranty", csid="csid",
        part_number="item", description="item_description", all_qty=amount(safe_number("quantity")), revenue=amount("revenue_rmb"),
        local_cogs=amount("local_cogs_amount_rmb"), **({} if monthly else {"sheet_credit_note": amount("credit_note_rmb")})))
    place = {c: c for c in ("business_type", "territory", "territory2", "branch", "country_chinese")}
    if monthly:
        own = dict(product_line_id="product_line", sold_to_customer="sold_to_customer", country_id=F.trim("revenue_country"),
                   country_code=F.trim("revenue_country"), part_number="item", description="item_description",
                   revenue=amount("sales_amount"), local_cogs=amount("material_cost_amt"))
    else:
        own = dict(product_line_id="sheet", sold_to_customer="cust_full_name", country_id="country_id", country_code="country_id",
                   part_number="part_no", revenue=amount("revenue_usd_hedge_rate"), local_cogs=amount("cogs_amount"),
                   sheet_credit_note=amount(F.col("revenue_usd_hedge_rate") - F.col("net_revenue_usd_agp")),
                   sheet_csc_ratio=amount("csc_unit_cost"), sheet_csc_amt=amount("total_csc_cost"))
    b = aci.select(*typed(**same, **place, **own, source=F.lit("ACIRAW"), all_qty=amount("quantity")))
    return a.unionByName(b)


# fixed values: key-part detail order types kept and the excluded group flag
FIN_ORDER_TYPES = ["B&S-RM EX-113", "B&S-RM EX Book-113"]
FIN_NO_GROUP = "無B&S Group"


def finance_keypart(detail: DataFrame, item_code: DataFrame, product_line: str) -> DataFrame:
    """Key-part detail: conjunctive filter (P15), category waterfall
    (pattern → item-code lookup → DDR prefixes → FLASH prefix → SSD, C2), date
    text or serial → gl_yearmonth (F7)."""
    df = detail.where((F.col("ag_no_check") != FIN_NO_GROUP) & (F.col("material_cost") != 0)
                      & F.col("order_type").isin(FIN_ORDER_TYPES))
    ic = L.dedupe_lookup(item_code, ["item_code"], ["category"], normalize_keys=False).select(
        F.col("item_code").alias("__ic"), F.col("category").alias("__cat"))
    df = df.join(ic, F.substring("item_no", 1, 2) == F.col("__ic"), "left")
    desc = F.col("item_description")
    ddr = desc.startswith("DDR") | desc.startswith("LPD") | desc.startswith("GDDR") | desc.startswith("LP")
    cat = (F.when(desc.contains("BRA"), F.lit("BR")).when(F.col("__cat").isNotNull(), F.col("__cat"))
           .when(ddr, F.lit("DDR")).when(desc.startswith("FLASH"), F.lit("FLASH")).otherwise(F.lit("SSD")))
    gl = serial_or_text_date("gl_date")
    return df.select("order_type", "item_no", "item_description", "quantity", "net_sale_amount", "material_cost",
                     "ag_no", cat.alias("category"), gl.alias("gl_date"),
                     F.date_format(gl, "yyyyMM").alias("gl_yearmonth"), F.lit(product_line).alias("product_line"),
                     F.lit(0).alias("cogs_price"), F.lit(0).alias("equo_price"), F.lit(0).alias("bs_gap"))


def load_fx(matrix: DataFrame, label: str) -> DataFrame:
    """D12 FX matrix: period × currency columns → rows (R1), label attached."""
    value_cols = [c for c in matrix.columns if c != "period"]
    return unpivot_matrix(matrix, ["period"], value_cols, "product_line", "fx_rate", label=label, label_col="label")


def load_shipunit(sheet: DataFrame, country_group: DataFrame) -> DataFrame:
    """D12 shipping unit: NB rows keyed by geo, NR/NV by territory."""
    geo = country_group.select("geo", F.col("country_code").alias("country")).distinct()
    ter = country_group.select("territory", F.col("country_code").alias("country")).distinct()
    nb = sheet.where(F.col("product_line") == "NB").join(geo, "geo", "left")
    nrnv = sheet.where(F.col("product_line").isin("NR", "NV")).join(ter, "territory", "left")
    cols = ["product_line", "ship_way_type", "unit_shipfee", "unit_storage_fee", "period", "freq", "country"]
    return nb.select(*cols).unionByName(nrnv.select(*cols))


def load_opp(sheet: DataFrame) -> DataFrame:
    """D12 OPP rebate: needed fields, duplicates removed (A5)."""
    return sheet.select("sku90pn", "opp_rebate", "period", F.lit("monthly").alias("freq"), "product_line").distinct()


def load_model_cost(sheet: DataFrame) -> DataFrame:
    """D12 model/CPU cost: average per (team, model, cpu, period); the pandas
    loader drops NULL group keys (A1)."""
    src = sheet.na.drop(subset=["sales_team", "model_name", "cpu", "period"])
    return src.groupBy("sales_team", "model_name", "cpu", "period").agg(mean("item_cost_usd").alias("item_cost_usd"))


def load_funding(sheet: DataFrame) -> DataFrame:
    """D12 funding: zero rows dropped, NULL / unparseable kept."""
    return R.nonzero_or_null(sheet, "funding")


# fixed values: the channels of the second rule of the USD source, and the name that the others start with
RETAIL_CHANNELS = ["ACI-Retail", "Channel-SA"]
OTHER_CHANNEL = "Other Channel"


def credit_note_rate(fact: DataFrame, rates: DataFrame, ou: Column, branch2: Column, customer: Column) -> DataFrame:
    """``cn`` per row, the first rule that finds a rate.

    RMB source: (line, ou, distribution type, period).  USD source: 0 for
    refurbished goods; else (line, branch2, period) among the retail channels;
    (line, customer-country, period) among the named ones; (line, country, period)
    among the other channels.  Keys are trimmed; of repeated keys the greatest rate
    counts; a NULL key part finds nothing."""
    codes = ["product_line", "legal_entity", "channel_code", "period"]
    table = rates.select(F.upper(F.trim("source")).alias("source"), *[F.trim(c).alias(c) for c in codes], "cn")
    rmb, usd = F.col("source") == "ACCRAW", F.col("source") == "ACIRAW"
    channel = F.col("channel_code")
    retail, other = channel.isin(RETAIL_CHANNELS), channel.startswith(OTHER_CHANNEL)
    line = {"product_line": F.trim("product_line_id"), "period": F.trim("period")}
    country = F.trim("country_code")
    rules = [
        {"where": rmb, "fact_where": rmb,
         "keys": line | {"legal_entity": F.trim(ou), "channel_code": F.trim("distribution_type")}},
        {"const": 0, "fact_where": usd & (F.upper(F.trim("business_type")) == "REFURBISH")},
        {"where": usd & retail, "fact_where": usd, "keys": line | {"channel_code": F.trim(branch2)}},
        {"where": usd & ~retail & ~other, "fact_where": usd,
         "keys": line | {"channel_code": F.concat(F.trim(customer), F.lit("-"), country)}},
        {"where": usd & other, "fact_where": usd, "keys": line | {"legal_entity": country}},
    ]
    out = L.match_cascade(fact, table, rules, "cn", "cn")
    return out.withColumn("cn", F.col("cn").cast("decimal(8,4)"))


# fixed values: the cost period of rows without a range, and the lines that have ranges, per source
NEWEST_FIRST = "由新到舊"
RANGE_LINES = {"ACCRAW": ["NB"], "ACIRAW": ["NR", "NV", "NB"]}


def cost_period(fact: DataFrame, ranges: DataFrame, out: str = "cost_period") -> DataFrame:
    """``cost_range`` of the row's (part, period as version) for the lines of its
    source that have ranges (J14, J13: of repeated keys the greatest); newest first
    for all others and where the range is missing or NULL.  Keys are trimmed."""
    rows = L.dedupe_lookup(ranges, ["pn", "version"], ["cost_range"])
    rows = rows.select(F.col("pn").alias("__pn"), F.col("version").alias("__version"), F.col("cost_range").alias("__range"))
    ranged = F.lit(False)
    for source, lines in RANGE_LINES.items():
        ranged = ranged | ((F.col("source") == source) & F.upper("product_line_id").isin(lines))
    found = fact.join(rows, ranged & (F.trim("part_number") == F.col("__pn")) & (F.trim("period") == F.col("__version")), "left")
    return found.withColumn(out, F.coalesce("__range", F.lit(NEWEST_FIRST))).drop("__pn", "__version", "__range")
