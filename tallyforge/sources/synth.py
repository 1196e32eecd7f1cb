"""Seeded synthetic landing data (for demos and tests at any size).

Rows come from ``spark.range(n)`` and every random draw is a pure function of
(seed, row id, draw name) through ``xxhash64``, so a given (n, seed) gives the
same rows on any cluster layout, and generation is fully parallel (no driver
loop, no shuffle). Ranges follow the source-system definitions (no negative
prices or quantities). Pick-lists repeat values to weight them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S

# Weighted pick-lists of the landing generators.
SEGMENT_PICKS = ["INSTITUTIONAL", "PENSION", "ENDOWMENT", "HNW", "WEALTH"]
KYC_PICKS = ["VERIFIED", "VERIFIED", "VERIFIED", "PENDING", "REVIEW"]
RISK_PICKS = ["LOW", "LOW", "MEDIUM", "HIGH"]
COUNTRY_PICKS = ["US", "US", "GB", "CA", "DE", "SG"]
ASSET_CLASS_PICKS = ["EQUITY", "EQUITY", "ETF", "BOND", "FX", "CRYPTO"]
TXN_TYPE_PICKS = ["DEPOSIT", "WITHDRAWAL", "TRADE_BUY", "TRADE_SELL", "FEE"]
SIDE_PICKS = ["BUY", "SELL"]
BOOK_PICKS = ["EQUITY", "FIXED_INCOME", "FX", "DERIVATIVES"]
STATUS_PICKS = ["FILLED", "FILLED", "FILLED", "PARTIAL", "CANCELLED"]

_RES = 1_000_000


def _u(seed: int, draw: str) -> Column:
    """Uniform [0, 1) draw for the current row."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(draw)), F.lit(_RES)) / F.lit(float(_RES))


def _int(seed: int, draw: str, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi] (inclusive)."""
    return (F.lit(lo) + F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(draw)), F.lit(hi - lo + 1))).cast("long")


def _pick(seed: int, draw: str, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (_int(seed, draw, 1, len(values))).cast("int"))


def _num(seed: int, draw: str, lo: float, hi: float, t) -> Column:
    return F.round(F.lit(lo) + _u(seed, draw) * (hi - lo), t.scale).cast(t)


def _symbol(n: Column) -> Column:
    return F.concat(F.lit("SYM"), F.lpad(n.cast("string"), 3, "0"))


def customers(spark: SparkSession, n: int = 1000, seed: int = 7, as_of: str = "2026-01-01") -> DataFrame:
    key = F.col("id") + 1
    now = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        key.alias("customer_id"),
        F.concat(F.lit("First"), key.cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), key.cast("string")).alias("last_name"),
        F.concat(F.lit("cust"), key.cast("string"), F.lit("@example.com")).alias("email"),
        _pick(seed, "segment", SEGMENT_PICKS).alias("segment"),
        _pick(seed, "kyc", KYC_PICKS).alias("kyc_status"),
        _pick(seed, "risk", RISK_PICKS).alias("risk_rating"),
        _pick(seed, "country", COUNTRY_PICKS).alias("country"),
        F.date_sub(F.lit(as_of).cast("date"), _int(seed, "onboard", 0, 2200).cast("int")).alias("onboarded_date"),
        now.alias("updated_at"), now.alias("_ingested_at"), F.lit(False).alias("_deleted"),
    )


def instrument_prices(spark: SparkSession, n: int = 50, seed: int = 7, as_of: str = "2026-01-01") -> DataFrame:
    now = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        _symbol(F.col("id") + 1).alias("symbol"),
        _pick(seed, "asset", ASSET_CLASS_PICKS).alias("asset_class"),
        _num(seed, "price", 10, 1000, S.PRICE).alias("price"),
        F.lit("USD").alias("currency"),
        F.lit(as_of).cast("date").alias("as_of_date"),
        now.alias("updated_at"), now.alias("_ingested_at"), F.lit(False).alias("_deleted"),
    )


def transactions(spark: SparkSession, n: int = 50000, n_customers: int = 1000, n_symbols: int = 50,
                 seed: int = 7, as_of: str = "2026-01-01") -> DataFrame:
    rn = F.col("id") + 1
    kind = _pick(seed, "type", TXN_TYPE_PICKS)
    trade = kind.isin("TRADE_BUY", "TRADE_SELL")
    now = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        rn.alias("txn_id"),
        (F.lit(100000) + F.pmod(rn, F.lit(n_customers))).alias("account_id"),
        (F.lit(1) + F.pmod(rn, F.lit(n_customers))).alias("customer_id"),
        F.timestamp_add("DAY", -_int(seed, "ts", 0, 365), now).alias("txn_ts"),
        kind.alias("txn_type"),
        F.when(trade, _symbol(_int(seed, "sym", 1, n_symbols))).alias("symbol"),
        F.when(trade, _num(seed, "qty", 1, 100, S.QTY)).alias("quantity"),
        _num(seed, "amount", 0, 10000, S.MONEY).alias("amount"),
        F.lit("USD").alias("currency"),
        _num(seed, "balance", 0, 50000, S.MONEY).alias("balance_after"),
        now.alias("updated_at"), now.alias("_ingested_at"), F.lit(False).alias("_deleted"),
    )


def trades(spark: SparkSession, n: int = 20000, n_customers: int = 1000, n_symbols: int = 50,
           seed: int = 7, as_of: str = "2026-01-01") -> DataFrame:
    rn = F.col("id") + 1
    q = _num(seed, "qty", 1, 500, S.QTY)
    p = _num(seed, "price", 10, 1000, S.PRICE)
    now = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        rn.alias("trade_id"),
        (F.lit(1) + F.pmod(rn, F.lit(n_customers))).alias("customer_id"),
        _symbol(_int(seed, "sym", 1, n_symbols)).alias("symbol"),
        _pick(seed, "side", SIDE_PICKS).alias("side"),
        q.alias("quantity"), p.alias("price"),
        F.round(q * p, 2).cast(S.MONEY).alias("notional"),
        _pick(seed, "book", BOOK_PICKS).alias("book"),
        _pick(seed, "status", STATUS_PICKS).alias("status"),
        F.timestamp_add("DAY", -_int(seed, "ts", 0, 365), now).alias("trade_ts"),
        now.alias("updated_at"), now.alias("_ingested_at"), F.lit(False).alias("_deleted"),
    )


def risk_metrics(spark: SparkSession, n: int = 1000, seed: int = 7, as_of: str = "2026-01-01") -> DataFrame:
    gross = _num(seed, "gross", 10000, 1000000, S.MONEY)
    var95 = _num(seed, "var", 5000, 205000, S.MONEY)
    limit = _num(seed, "limit", 50000, 250000, S.MONEY)
    now = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")
    share = F.lit(0.2) + _int(seed, "net", 0, 60) / F.lit(100.0)
    return spark.range(n).select(
        (F.col("id") + 1).alias("customer_id"),
        F.lit(as_of).cast("date").alias("as_of_date"),
        gross.alias("gross_exposure"),
        F.round(gross * share.cast("decimal(5,2)"), 2).cast(S.MONEY).alias("net_exposure"),
        var95.alias("var_95"), limit.alias("risk_limit"),
        (var95 > limit).alias("limit_breach_flag"),
        now.alias("updated_at"), now.alias("_ingested_at"), F.lit(False).alias("_deleted"),
    )


def synth(spark: SparkSession, table: str, n: int, seed: int = 7, **kw) -> DataFrame:
    """Generator by bronze table name."""
    gens = {"customers": customers, "instrument_prices": instrument_prices, "transactions": transactions,
            "trades": trades, "risk_metrics": risk_metrics}
    return gens[table](spark, n, seed=seed, **kw)
