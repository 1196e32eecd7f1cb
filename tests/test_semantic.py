from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyforge.plans import semantic


@pytest.fixture()
def investors(spark):
    rows = [(1, "HNW", "LOW", D("10.5"), D("100"), D("40")), (2, "HNW", "HIGH", D("-2"), D("10"), D("5")),
            (3, "PENSION", "LOW", D("7"), D("0"), D("1"))]
    df = spark.createDataFrame(rows, "investor_id long, investor_segment string, risk_rating string, "
                                     "assets_under_management decimal(38,8), total_subscriptions decimal(38,2), "
                                     "total_redemptions decimal(38,2)")
    for c in ("holdings_value", "cash_balance", "total_fees", "activity_count", "instruments_held",
              "kyc_status", "country", "tenure_days"):
        df = df.withColumn(c, F.lit(0))
    return semantic.investors_view(df)


def test_query_by_dimension_with_synonyms(investors):
    out = investors.query(["client segment"], ["number of clients", "total AUM", "net new money"])
    got = {r["investor_segment"]: (r["investor_count"], r["total_aum"], r["total_net_flows"]) for r in out.collect()}
    assert got == {"HNW": (2, D("8.5"), D("65")), "PENSION": (1, D("7"), D("-1"))}


def test_grand_total_and_filter(investors):
    r = investors.query([], ["investors.investor_count", "avg_aum"]).first()
    assert r["investor_count"] == 3
    r = investors.query([], ["investor_count"], where="risk_rating = 'LOW'").first()
    assert r["investor_count"] == 2


def test_resolve_errors(investors):
    with pytest.raises(KeyError):
        investors.resolve("no such thing")
    assert investors.resolve("Mandate Type").name == "investor_segment"


def test_positions_total_trades_accepts_fact_and_physical_name(spark):
    df = spark.createDataFrame([(1, "S", 3, D("1"))], "investor_id long, symbol string, trade_count long, market_value decimal(38,2)")
    for c in ("gross_exposure", "unrealized_pnl", "net_quantity", "asset_class", "investor_segment",
              "risk_rating", "earnings_sentiment"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    v = semantic.positions_view(df)
    assert v.query([], ["total_trades"]).first()[0] == 3
    assert v.query(["ticker"], ["number of positions"]).first()["position_count"] == 1


def test_semantic_view_in_sql(spark, investors):
    investors.create_view()
    got = {r[0]: r[1] for r in spark.sql(
        "SELECT investor_segment, sum(aum) AS total_aum FROM investors GROUP BY investor_segment").collect()}
    api = {r["investor_segment"]: r["total_aum"] for r in investors.query(["investor_segment"], ["total_aum"]).collect()}
    assert got == api


def test_metric_table_and_view_comments_reach_the_user(spark, investors):
    out = investors.query(["investor_segment"], ["total_aum"])
    assert out.schema["total_aum"].metadata["comment"] and out.schema["investor_segment"].metadata["comment"]
    told = {(r.kind, r.name): r for r in investors.describe(spark).collect()}
    assert told["view", "investor_360_sv"].comment and told["table", "investors"].synonyms == ["clients", "accounts", "client book"]
    assert told["metric", "total_aum"].expression == "sum(aum)" and told["metric", "avg_aum"].comment
    assert len(told) == 2 + len(investors.facts) + len(investors.dimensions) + len(investors.metrics)


def test_comments_travel_as_metadata_and_ambiguity_is_an_error(spark, investors):
    proj = investors._projected()
    assert proj.schema["aum"].metadata.get("comment") == "Cash plus valued holdings, in account currency"
    import dataclasses
    clash = dataclasses.replace(investors, metrics=investors.metrics + [
        semantic.Member("aum_total_2", "sum(aum)", ("total AUM",))])
    with pytest.raises(KeyError, match="ambiguous"):
        clash.resolve("total aum")
