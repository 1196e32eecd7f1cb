from pyspark.sql import functions as F

from tallyforge.sources import schemas, synth


def test_deterministic_and_in_domain(spark):
    a = synth.customers(spark, 200, seed=5).collect()
    b = synth.customers(spark.range(1).sparkSession, 200, seed=5).collect()
    assert a == b
    assert {r["segment"] for r in a} <= set(schemas.SEGMENTS)
    assert {r["risk_rating"] for r in a} <= set(schemas.RISK_RATINGS)


def test_trade_fields(spark):
    t = synth.trades(spark, 500, n_customers=20)
    assert t.filter(F.col("notional") != F.round(F.col("quantity") * F.col("price"), 2)).count() == 0
    assert t.agg(F.min("customer_id"), F.max("customer_id")).first() == (1, 20)
    tx = synth.transactions(spark, 500)
    bad = tx.filter(~F.col("txn_type").isin("TRADE_BUY", "TRADE_SELL") & F.col("symbol").isNotNull()).count()
    assert bad == 0


def test_risk_breach_flag(spark):
    r = synth.risk_metrics(spark, 300)
    assert r.filter(F.col("limit_breach_flag") != (F.col("var_95") > F.col("risk_limit"))).count() == 0
    assert r.filter(F.col("net_exposure") > F.col("gross_exposure")).count() == 0
