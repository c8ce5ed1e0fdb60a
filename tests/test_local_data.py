"""The combined fact on hand rows: the rules for both sources, monthly and weekly."""

import pytest

from ledgerlake.plans import grossprofit as GP
from ledgerlake.plans import ingest as I

NEWEST = I.NEWEST_FIRST


@pytest.fixture(scope="module")
def made(spark):
    columns = ["l_orderkey long", "l_linenumber int", *[f"{c} string" for c in (
        "source product_line_id year quarter month period sold_to_customer order_type business_type product_type distribution "
        "distribution_type territory territory2 branch country_id country_chinese country_code ou warranty csid part_number description").split()],
        "all_qty double", "revenue double", "local_cogs double", "sheet_credit_note double", "sheet_csc_ratio double", "sheet_csc_amt double"]

    def row(key, source, line, part, qty, revenue, cogs, note, customer=None, business="Retail", branch="ACC", country="CN", ou=None, dist=None):
        return (key, 1, source, line, "2024", "Q1", "01", "202401", customer, None, business, None, None, dist, "T", "T", branch, country, "z",
                country, ou, "12", None, part, None, qty, revenue, cogs, note, 0.1, 9.0)

    rows = [row(1, "ACCRAW", "NB", "p1", 2.0, 100.0, 60.0, 8.0, ou="OU1", dist="O"),
            row(2, "ACCRAW", "NR", "p1", -2.0, 100.0, 60.0, 8.0, ou="OU9", dist="O"),  # no rate; the line's fx rate is 0
            row(3, "ACIRAW", "NB", "p1", 2.0, 100.0, 60.0, 8.0, "big WALMART store", branch="US-Retail", country="US"),
            row(4, "ACIRAW", "NB", "p2", 2.0, 100.0, 60.0, 8.0, "Best Buy 7", branch="x", country="CA"),
            row(5, "ACIRAW", "NB", "p2", 2.0, None, None, None, None, "REFURBISH", branch=None, country="CA")]
    table = lambda ddl, *data: spark.createDataFrame(list(data), ddl)
    return (table(", ".join(columns), *rows),
            table("product_line string, period string, fx_rate double, fx_rate_ex double", ("NB", "202401", 5.0, 4.0), ("NR", "202401", 0.0, None)),
            table("product_line string, sales_team string, period string, freight double", ("NB", "acc", "202401", 1.5), ("NB", " us-retail ", "202401", 2.0)),
            table("pn string, period string, funding double", (" p1 ", "202401", 3.0), ("p1", "202401", 1.0), ("p1", "202402", 9.0)),
            table("pn string, version string, cost_range string", (" p1", "202401 ", "202312"), ("p2", "202401", None)),
            table("source string, product_line string, legal_entity string, channel_code string, period string, cn double",
                  ("ACCRAW", "NB", "OU1", "O", "202401", 0.1), ("ACIRAW", "NB", "US", "ACI-Retail", "202401", 0.2),
                  ("ACIRAW", "NB", "CA", "BBY-CA", "202401", 0.3), ("ACIRAW", "NB", "CA", "Other Channel 1", "202401", 0.4)))


def rows(made, monthly, *columns):
    return {r.l_orderkey: tuple(r)[1:] for r in GP.local_data(*made, monthly).select("l_orderkey", *columns).collect()}


def test_monthly_credit_note_by_rule_and_net_revenue(made):
    got = rows(made, True, "revenue_usd_hedge_rate", "credit_note_hedge_rate", "credit_note_fxdiff", "credit_note_rmb",
               "net_revenue_usd_agp", "net_revenue_rmb")
    assert got[1] == (20.0, 2.0, 2.5, 10.0, 18.0, 90.0)
    assert got[2] == (None, None, None, None, 0.0, 100.0)
    assert got[3] == (100.0, 20.0, 20.0, None, 80.0, None)
    assert got[4] == (100.0, 30.0, 30.0, None, 70.0, None)  # the named channel before the other channels
    assert got[5] == (None, 0.0, 0.0, None, 0.0, None)  # refurbished goods


def test_weekly_credit_note_of_the_sheet(made):
    got = rows(made, False, "credit_note_hedge_rate", "credit_note_fxdiff", "credit_note_rmb", "net_revenue_usd_agp")
    assert got[1] == (1.6, 2.0, 8.0, 18.4) and got[2] == (None, None, 8.0, 0.0) and got[3] == (8.0, 8.0, None, 92.0)
    assert got[5] == (None, None, None, 0.0)


def test_fee_funding_cost_period_and_names(made):
    fee = ("total_ship_fee_company", "total_ship_fee_company_fxdiff", "total_ship_fee_company_rmb")
    got = rows(made, True, *fee, "funding", "cost_period", "customer", "branch2")
    assert got[1] == (-0.6, -0.75, -3.0, 6.0, "202312", None, "ACC")
    assert got[2] == (None, None, None, 0.0, NEWEST, None, "ACC")  # no freight, no funding below zero, a line without ranges
    assert got[3] == (-4.0, -4.0, None, 6.0, "202312", "Walmart", "ACI-Retail")
    assert got[4] == (None, None, None, None, NEWEST, "BBY", "Channel-US")
    assert got[5][-3:] == (NEWEST, "Others", "Channel-US")
    weekly = rows(made, False, "funding", "customer")
    assert weekly[2] == (-6.0, None) and weekly[4] == (None, "Best Buy")


def test_row_count_and_columns(made):
    for monthly in (True, False):
        out = GP.local_data(*made, monthly)
        assert out.count() == 5 and out.columns == GP.LOCAL_COLUMNS
