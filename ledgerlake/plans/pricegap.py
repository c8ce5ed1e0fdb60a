"""Key-part price-gap marts (D13-D21) as DataFrame → DataFrame functions.

Each function takes the *stored* snapshots it depends on (never an unsaved
frame of the same run) and returns one lazy plan.  Shapes at scale:

* every source is read through :func:`latest_snapshot` (runtime partition filter);
* lookups are deduplicated before joining; mapping fan-outs (component → many
  finished parts) are intended and bounded by the bill of material;
* the period skeleton is a generator over a calendar-bounded period array, not
  a cartesian join; the carry-forward is three equi-joins;
* "first row per group" and "latest per key" are arg-max aggregates (partial
  aggregation, skew-safe), not windows over potentially hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import money as M
from ledgerlake.functions.dates import add_months_period
from ledgerlake.operators import asof as W
from ledgerlake.operators import lookup as L
from ledgerlake.operators import rules as R
from ledgerlake.operators import spine as S
from ledgerlake.operators.aggregate import mean
from ledgerlake.sources.snapshot import anchor_value, latest_snapshot, max_of

# fixed values: categories the key-part gap keeps, and the category waterfall
KEYPART_CATEGORIES = ["BATT", "SSD", "LCD", "HDD", "DDR", "FLASH"]
BRACKET_PATTERN = "%BRA%"
DDR_PREFIXES = {"DDR": "DDR", "LPD": "DDR", "GDDR": "DDR", "LP": "DDR"}
QUOTE_PROJECTS = ["NB", "NR", "NV"]


def _gap_exact(x) -> Column:
    """A double gap term as an exact DECIMAL(38,9) so that sums are order-free."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(38,9)")


def _sum_where(rows: Column, term: Column) -> Column:
    """``SUM(CASE WHEN rows THEN term ELSE 0 END)`` without adding up the zeros: exact decimals are slow to add."""
    total, others = F.sum(F.when(rows, term)), F.count(F.when(~F.coalesce(rows, F.lit(False)), F.lit(1)))
    return F.when(others > 0, F.coalesce(total, F.lit(0).cast("decimal(38,9)"))).otherwise(total)


def component_map(quotes: DataFrame, patterns: DataFrame, bom: DataFrame) -> DataFrame:
    """Component item → (group, description, tag) → finished parts.

    Per item the quote row with a group number wins, then the latest month (W3).
    Only the picked descriptions are matched to the pattern table (J3; the greatest
    tag counts).  The BOM is reduced to main components with summed quantity (A4)
    and left-joined (J16)."""
    q = latest_snapshot(quotes) if "ds" in quotes.columns else quotes
    q = q.where(F.col("buying_mode") == "B").where(F.upper("product_no").isin(QUOTE_PROJECTS))
    rank = F.when(F.col("ag_no").isNotNull(), F.lit(0)).otherwise(F.lit(1))
    best = W.priority_pick(q, ["item_no"], rank, "group_no", ["ag_no", "item_desc"])
    tags = (L.like_join(best.select("item_desc").distinct(), "item_desc", patterns.select("pattern", "tag"), "pattern")
            .groupBy("item_desc").agg(F.max("tag").alias("tag")))
    best = best.join(tags, "item_desc", "left").withColumn("tag", F.coalesce(F.col("tag"), F.lit("")))
    main = bom.where(F.col("substitute_type") == "M").groupBy("part_number_kp", "part_number_90").agg(
        F.sum("kp_qty").alias("kp_qty"))
    out = best.join(L.shuffled(main), best["item_no"] == main["part_number_kp"], "left")
    return out.select("item_no", "ag_no", "item_desc", F.col("part_number_90").alias("part_number"), "tag", "kp_qty")


def _categorise(df: DataFrame, item_code: DataFrame, desc: str, item: str) -> DataFrame:
    ic = item_code.select(F.col("item_code").alias("__ic"), F.col("category").alias("__ic_cat"))
    j = df.join(ic, F.substring(F.col(item), 1, 2) == F.col("__ic"), "left")
    cat = R.category_waterfall([(F.col(desc).like(BRACKET_PATTERN), "BR")], F.col("__ic_cat"), desc,
                               DDR_PREFIXES, "SSD")
    return j.withColumn("category", cat).drop("__ic", "__ic_cat")


def gap_history(final: DataFrame, history: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Skeleton of every product × every target period, then carry-forward
    (J7 + W5): current value → stored value of that period → stored value of
    the latest stored period.  The last is found per product, before the periods multiply the rows."""
    items = S.latest_stored(S.key_union([final, history], keys), history, keys, "period", values)
    periods = final.select("period").unionByName(history.select("period"))
    skel = S.period_skeleton(items, periods)
    filled = S.carry_forward(skel, final.where(F.col("period").isNotNull()), history, keys, "period", values)
    return filled


def newest_report(report: DataFrame) -> DataFrame:
    """The last month of the newest report.  Callers store it: every maximum in it reads the whole report."""
    rep = latest_snapshot(report)
    return rep.where(F.col("gl_yearmonth") == max_of(rep, "gl_yearmonth"))


def _report_window(rep: DataFrame) -> tuple[DataFrame, Column, list[Column]]:
    """The rows of :func:`newest_report`, their month, and it with the two after it."""
    first = anchor_value(rep, "gl_yearmonth")
    return rep, first, [first, add_months_period(first, 1), add_months_period(first, 2)]


def _report_prices(rep: DataFrame, keys: list[str], ntd_fx: DataFrame, month: Column) -> DataFrame:
    """Unit price ``rep_equo`` and unit cost ``rep_cogs`` of a report per key, at the month's rate."""
    fx = ntd_fx.where((F.col("period") == month) & (F.col("product_line") == "NB")).select(F.max("fx_rate")).scalar()
    total = {n: F.sum(F.col(c).try_cast("decimal(38,15)")).alias(n)
             for n, c in (("net", "net_sale_amount"), ("cost", "material_cost"), ("qty", "quantity"))}
    return rep.groupBy(*keys).agg(*total.values()).select(
        *keys, M.ratio(M.ratio("net", "qty"), fx).alias("rep_equo"), M.ratio(M.ratio("cost", "qty"), fx).alias("rep_cogs"))


def keypart_gap(quotes: DataFrame, report: DataFrame, ntd_fx: DataFrame, history: DataFrame,
                item_code: DataFrame) -> DataFrame:
    """Key-part price gap with history: the run's prices laid on the product × period skeleton and filled from the
    stored history."""
    return keypart_filled(keypart_now(quotes, newest_report(report), ntd_fx, item_code), history)


def keypart_now(quotes: DataFrame, newest: DataFrame, ntd_fx: DataFrame, item_code: DataFrame) -> DataFrame:
    """D14's prices of this run.

    Quotes of the report's anchor month and the two after it are averaged per
    (line, category, group, month); the report gives unit price and cost per
    group converted at the anchor month's rate; both are full-outer joined."""
    rep, first, months = _report_window(newest)
    scm = quotes.where((F.col("buying_mode") == "B") & F.col("group_no").isin(*months))
    scm = _categorise(scm.withColumn("product_line", F.upper("product_no")), item_code, "item_desc", "item_no")
    scm_avg = (scm.where(F.upper("category").isin(KEYPART_CATEGORIES))
               .groupBy("product_line", "category", "ag_no", F.col("group_no").alias("period"))
               .agg(mean("po_price").alias("scm_price")))
    rep_data = _report_prices(rep, ["product_line", "category", "ag_no"], ntd_fx, first)
    return S.full_outer_coalesce(scm_avg, rep_data, ["product_line", "category", "ag_no"]).select(
        "product_line", "category", "ag_no", "period",
        F.when(F.col("period") == first, F.col("rep_equo")).otherwise(F.col("scm_price")).alias("equo_price"),
        F.col("rep_cogs").alias("cogs_price"))


def keypart_filled(final: DataFrame, history: DataFrame) -> DataFrame:
    """The rows of :func:`keypart_now` with every period and the stored prices."""
    hist = latest_snapshot(history).select("product_line", "category", "ag_no", "period", "equo_price", "cogs_price")
    filled = gap_history(final, hist, ["product_line", "category", "ag_no"], ["equo_price", "cogs_price"])
    return filled.withColumn("bs_gap", F.col("cogs_price") - F.col("equo_price"))


def processor_class(item) -> Column:
    """D15's category of an item number (fixed values)."""
    item = F.col(item) if isinstance(item, str) else item
    return (F.when(item.startswith("02135") | item.startswith("01"), F.lit("CPU"))
            .when(item.startswith("02"), F.lit("C.S")))


def cpugpu_gap(quotes: DataFrame, report: DataFrame, ntd_fx: DataFrame, pac: DataFrame, history: DataFrame) -> DataFrame:
    """CPU/GPU price gap: the run's prices on the skeleton, filled from the stored history."""
    return cpugpu_filled(cpugpu_now(quotes, newest_report(report), ntd_fx, pac), history)


def cpugpu_now(quotes: DataFrame, newest: DataFrame, ntd_fx: DataFrame, pac: DataFrame) -> DataFrame:
    """D15's prices of this run.

    Quote averages per (line, item, month) of the report's three months, the
    report's unit price and cost per (line, item), and the anchor month's standard
    price meet in full outer joins on (line, item) (J5, J6).  An item's first month
    takes the report's price (W4).  A standard price alone has no line (by SQL equality)."""
    rep, first, months = _report_window(newest)
    scm = R.prefix_filter(quotes.where((F.col("buying_mode") == "B") & F.col("group_no").isin(*months)), "item_no", ["01", "02"])
    scm_avg = (scm.groupBy(F.upper("product_no").alias("product_line"), "item_no", F.col("group_no").alias("period"))
               .agg(mean("po_price").alias("scm_price")))
    priced = _report_prices(rep, ["product_line", "item_no"], ntd_fx, first)
    standard = (latest_snapshot(pac).where(F.col("period") == first)
                .groupBy(F.col("product_line").alias("p_line"), F.col("pn").alias("p_item"))
                .agg(F.max("pac").cast("double").alias("pac")))
    j = S.full_outer_coalesce(scm_avg, priced, ["product_line", "item_no"])
    j = j.join(standard, (F.col("product_line") == F.col("p_line")) & (F.col("item_no") == F.col("p_item")), "full")
    j = W.first_in_group(j.withColumn("category", processor_class(F.coalesce("item_no", "p_item"))),
                         ["product_line", "item_no"], "period", "is_first")
    return j.select(*CPUGPU_KEYS, "period", F.when(F.col("is_first"), F.col("rep_equo")).otherwise(F.col("scm_price")).alias("equo_price"),
                    F.col("rep_cogs").alias("cogs_price"), "pac")


CPUGPU_KEYS = ["product_line", "category", "item_no"]


def cpugpu_filled(final: DataFrame, history: DataFrame) -> DataFrame:
    """The rows of :func:`cpugpu_now` with every period and the stored prices.  An item without category matches no
    stored value (by SQL equality).  ``rebate`` is standard price less cost."""
    keys = CPUGPU_KEYS
    hist = latest_snapshot(history).select(*keys, "period", "equo_price", "cogs_price", "pac").distinct()
    filled = gap_history(final, hist, keys, ["equo_price", "cogs_price", "pac"])
    return filled.withColumns({"bs_gap": F.col("cogs_price") - F.col("equo_price"), "rebate": F.col("pac") - F.col("cogs_price")})


def keypart_gap_by_part(gap: DataFrame, missed: DataFrame, item_map: DataFrame) -> DataFrame:
    """Gaps per group (plus manual rows keyed by item) exploded to finished
    parts by the component map — by group, else by item (J10) — and pivoted into
    one column per category family (A3)."""
    acc = gap.select("product_line", "category", "ag_no", F.lit(None).cast("string").alias("item_no"), "period",
                     "bs_gap")
    man = missed.select("product_line", "category", F.lit(None).cast("string").alias("ag_no"), "item_no", "period",
                        "bs_gap")
    rows = acc.unionByName(man).distinct()
    m = item_map.withColumn("map_pl", F.substring("part_number", 3, 2))
    by_group = m.select(F.col("map_pl").alias("g_pl"), F.col("ag_no").alias("g_ag"),
                        F.col("part_number").alias("g_pn"), F.col("kp_qty").alias("g_qty")).distinct()
    by_item = m.select(F.col("map_pl").alias("i_pl"), F.col("item_no").alias("i_item"),
                       F.col("part_number").alias("i_pn"), F.col("kp_qty").alias("i_qty")).distinct()
    j = (rows.join(by_group, (rows["product_line"] == F.col("g_pl")) & (rows["ag_no"] == F.col("g_ag")), "left")
         .join(by_item, (rows["product_line"] == F.col("i_pl")) & (rows["item_no"] == F.col("i_item")), "left"))
    j = j.select("product_line", "period", "category", "bs_gap",
                 F.coalesce("g_pn", "i_pn").alias("part_number"),
                 F.coalesce("g_qty", "i_qty", F.lit(0)).alias("kp_qty"))
    term = _gap_exact(F.col("bs_gap") * F.col("kp_qty").cast("double"))
    fam = {"lcd_gap": ["LCD"], "ssd_gap": ["SSD", "HDD", "FLASH"], "ddr_gap": ["DDR"], "batt_gap": ["BATT"]}
    return j.groupBy("product_line", "period", "part_number").agg(*[
        _sum_where(F.upper("category").isin(cats), term).alias(name) for name, cats in fam.items()])


def cpugpu_gap_by_part(gap: DataFrame, item_map: DataFrame) -> DataFrame:
    """CPU/GPU gap and rebate per finished part of the item's own line (J1 + A3)."""
    m = item_map.select(F.substring("part_number", 3, 2).alias("product_line"), "item_no", "part_number", "kp_qty").distinct()
    j = gap.join(m, ["product_line", "item_no"], "left")
    qty = F.col("kp_qty").cast("double")

    def piv(cat, col):
        return _sum_where(F.col("category") == cat, _gap_exact(F.col(col) * qty))

    return j.groupBy("product_line", "period", "part_number").agg(
        piv("CPU", "bs_gap").alias("cpu_gap"), piv("CPU", "rebate").alias("cpu_rebate"),
        piv("C.S", "bs_gap").alias("gpu_gap"), piv("C.S", "rebate").alias("gpu_rebate"))


# fixed values: the one variant rule of the extra rebate (NV + this CPU only for this model)
VARIANT_CPU = "PROMO"
VARIANT_MODEL = "Brand#13"


def extra_rebate(result: DataFrame, item_map: DataFrame, rebates: DataFrame) -> DataFrame:
    """Extra rebate expanded to finished parts: part → component item →
    rebate on (item, line) (J18); the left join filtered on the rebate is an
    inner join (J9); the variant rule is an implication filter (P13)."""
    res = latest_snapshot(result).select("product_line", "part_number", "model_name").distinct()
    grp = item_map.select("item_no", F.col("part_number").alias("m_pn")).distinct()
    reb = latest_snapshot(rebates).select(F.col("item_no").alias("r_item"), F.col("product_line").alias("r_pl"),
                                          "cpu", "extra_rebate", "period").distinct()
    j = (res.join(L.shuffled(grp), res["part_number"] == grp["m_pn"], "left")
         .join(L.shuffled(reb), (F.col("item_no") == F.col("r_item")) & (res["product_line"] == F.col("r_pl"))
               & F.col("extra_rebate").isNotNull(), "inner"))
    j = j.where(R.implication(F.col("product_line") == "NV", F.upper("cpu") == VARIANT_CPU,
                              F.col("model_name") == VARIANT_MODEL))
    return j.select("product_line", "cpu", "extra_rebate", "period", "part_number", "model_name").distinct()


def sellout_rebate(result: DataFrame, item_map: DataFrame, sellout: DataFrame) -> DataFrame:
    """NV sell-out rebate expanded to finished parts (J18 + J9 + A5)."""
    res = latest_snapshot(result).where(F.col("product_line") == "NV").select("product_line", "part_number").distinct()
    grp = item_map.select("item_no", F.col("part_number").alias("m_pn")).distinct()
    so = latest_snapshot(sellout).select(F.col("item_no").alias("s_item"), F.col("product_line").alias("s_pl"),
                                         "reb", "period").distinct()
    j = (res.join(L.shuffled(grp), res["part_number"] == grp["m_pn"], "left")
         .join(L.shuffled(so), (F.col("item_no") == F.col("s_item")) & (res["product_line"] == F.col("s_pl"))
               & F.col("reb").isNotNull(), "inner"))
    return j.select("product_line", "period", "part_number", "reb").distinct()


def costgap_spine(kp: DataFrame, cg: DataFrame, nv: DataFrame, extra: DataFrame, opp: DataFrame) -> DataFrame:
    """Key spine over five inputs, each measure attached, NULL → 0 (J8 + U4)."""
    keys = ["product_line", "period", "part_number"]
    frames = [
        (kp, ["lcd_gap", "ssd_gap", "ddr_gap", "batt_gap"]),
        (cg, ["cpu_gap", "cpu_rebate", "gpu_gap", "gpu_rebate"]),
        (nv.select(*keys, F.col("reb").cast(M.MONEY).alias("nv_rebate")), ["nv_rebate"]),
        (extra.select(*keys, F.col("extra_rebate").cast(M.MONEY).alias("cpu_extra_rebate")), ["cpu_extra_rebate"]),
        (opp.select("product_line", "period", F.col("sku90pn").alias("part_number"),
                    F.col("opp_rebate").cast(M.MONEY).alias("opp_rebate")), ["opp_rebate"]),
    ]
    return S.key_spine([(f.select(*keys, *ms), ms) for f, ms in frames], keys)


def explode_item_list(kp_gap: DataFrame, cpu_gap: DataFrame, item_map: DataFrame, os_incentive: DataFrame
                      ) -> DataFrame:
    """Items whose cost must be exploded: items of the stored key-part gaps
    (via group), CPU/GPU items and OS-incentive parts (U4).  Groups and pairs are made distinct before they meet: a
    group has a gap per category and period, and all of them lead to the same items."""
    pairs = item_map.select("ag_no", "item_no").distinct()
    a = kp_gap.select("ag_no").distinct().join(pairs, "ag_no", "left").select("item_no")
    b = cpu_gap.select("item_no")
    c = latest_snapshot(os_incentive).select(F.col("os_part_number").alias("item_no"))
    return a.unionByName(b).unionByName(c).distinct()
