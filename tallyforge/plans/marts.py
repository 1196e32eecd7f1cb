"""Gold models: investor_360 (AUM), portfolio_risk, investor_risk.

Plan shape (per model):

* investor_360 — transactions are scanned once and aggregated per (customer,
  symbol), then per customer (flow sums, last activity, newest balance via
  ``max_by``, holdings). Both aggregates are partial before their shuffle, so a
  customer holding a third of all rows is pre-reduced on every map task. The
  price dimension is joined without a hint: AQE broadcasts it when its runtime
  size is under the session threshold and falls back to a sort-merge join
  otherwise. The join to customers is on customer_id, where both sides are
  already hash-partitioned by their aggregate.
* portfolio_risk — trade executions -> positions per (customer, symbol),
  priced, joined to customers and to the newest earnings record per symbol.
* investor_risk — positions rolled up per investor, joined with the newest
  risk snapshot.

Money is kept in decimals with fixed published scales (see ``schemas``), so
results are exact and engine-independent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import latest_by_key, newest_first_key
from ..sources import schemas as S

_EXACT_QTY = T.DecimalType(19, 4)     # qty x price then fits decimal(38,8) exactly
_EXACT_VALUE = T.DecimalType(37, 8)   # operands of value sums/differences


def _built_at(built_at) -> Column | None:
    if built_at is None:
        return None
    if built_at is True:
        return F.current_timestamp().cast("timestamp_ntz").alias("_built_at")
    if isinstance(built_at, dt.datetime):
        built_at = built_at.isoformat(sep=" ")
    return F.lit(str(built_at)).cast("timestamp_ntz").alias("_built_at")


# ---------------------------------------------------------------- cash book

def cash_activity(tx: DataFrame) -> DataFrame:
    """Per customer: activity count, flow sums, last activity and newest balance.

    Newest balance = balance_after of the newest transaction by (txn_ts, txn_id),
    NULL timestamps last. One hash aggregate covers flows and balance (the
    ordering pair is one fixed-width key, see ``newest_first_key``).
    """
    amount = F.col("amount")
    kind = F.col("txn_type")
    return tx.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("activity_count"),
        F.sum(F.when(kind == "DEPOSIT", amount).otherwise(F.lit(0))).cast(S.MONEY_SUM).alias("total_subscriptions"),
        F.sum(F.when(kind == "WITHDRAWAL", amount).otherwise(F.lit(0))).cast(S.MONEY_SUM).alias("total_redemptions"),
        F.sum(F.when(kind == "FEE", amount).otherwise(F.lit(0))).cast(S.MONEY_SUM).alias("total_fees"),
        F.max("txn_ts").alias("last_activity_ts"),
        F.max_by("balance_after", newest_first_key("txn_ts", "txn_id")).alias("cash_balance"),
    )


def cash_flows(tx: DataFrame) -> DataFrame:
    return cash_activity(tx).select("customer_id", "activity_count", "total_subscriptions",
                                    "total_redemptions", "total_fees", "last_activity_ts")


def latest_balance(tx: DataFrame) -> DataFrame:
    return cash_activity(tx).select("customer_id", "cash_balance")


def cash_positions(tx: DataFrame) -> DataFrame:
    """Net cash-book quantity per (customer, symbol): +TRADE_BUY, -TRADE_SELL."""
    kind = F.col("txn_type")
    q = F.col("quantity")
    return (tx.filter(kind.isin("TRADE_BUY", "TRADE_SELL") & F.col("symbol").isNotNull())
              .groupBy("customer_id", "symbol")
              .agg(F.sum(F.when(kind == "TRADE_BUY", q).when(kind == "TRADE_SELL", -q).otherwise(F.lit(0)))
                   .cast(S.QTY_SUM).alias("net_quantity")))


def holdings(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Value of priced positions and number of non-flat instruments per customer.

    Unpriced symbols drop out (inner join). Positions are unique per
    (customer, symbol) and prices per symbol, so counting non-flat rows equals
    the distinct count of their symbols without a distinct aggregate.
    """
    p = positions.join(prices.select("symbol", "price"), "symbol", "inner")
    value = F.col("net_quantity").cast(_EXACT_QTY) * F.col("price")
    return p.groupBy("customer_id").agg(
        F.sum(value).cast(S.VALUE_SUM).alias("holdings_value"),
        F.count_if(F.col("net_quantity") != 0).alias("instruments_held"),
    )


def cash_book(tx: DataFrame, prices: DataFrame) -> DataFrame:
    """Flows, newest balance and holdings per customer from ONE scan of the transactions:
    first per (customer, symbol), where net quantities meet their price, then
    rolled up per customer. Both aggregates are partial before their exchange; the
    newest balance travels with its ordering key."""
    kind, amount, q = F.col("txn_type"), F.col("amount"), F.col("quantity")

    def flow(name: str) -> Column:
        return F.sum(F.when(kind == name, amount).otherwise(F.lit(0))).cast(S.MONEY_SUM)

    newest = newest_first_key("txn_ts", "txn_id")
    per_symbol = tx.groupBy("customer_id", "symbol").agg(
        F.count(F.lit(1)).alias("n"), flow("DEPOSIT").alias("deposits"), flow("WITHDRAWAL").alias("withdrawals"),
        flow("FEE").alias("fees"), F.max("txn_ts").alias("ts"), F.max(newest).alias("newest"),
        F.max_by("balance_after", newest).alias("balance"),
        F.sum(F.when(kind == "TRADE_BUY", q).when(kind == "TRADE_SELL", -q).otherwise(F.lit(0))).cast(S.QTY_SUM).alias("net"))
    priced = per_symbol.join(prices.select(F.col("symbol").alias("s"), "price"), F.col("symbol") == F.col("s"), "left")
    value = F.col("net").cast(_EXACT_QTY) * F.col("price")
    return priced.groupBy("customer_id").agg(
        F.sum("n").alias("activity_count"), F.sum("deposits").cast(S.MONEY_SUM).alias("total_subscriptions"),
        F.sum("withdrawals").cast(S.MONEY_SUM).alias("total_redemptions"), F.sum("fees").cast(S.MONEY_SUM).alias("total_fees"),
        F.max("ts").alias("last_activity_ts"), F.max_by("balance", "newest").alias("cash_balance"),
        F.sum(value).cast(S.VALUE_SUM).alias("holdings_value"),
        F.count_if(F.col("price").isNotNull() & (F.col("net") != 0)).alias("instruments_held"))


def investor_360(customers: DataFrame, tx: DataFrame, prices: DataFrame, built_at=None) -> DataFrame:
    c = customers.alias("c")
    j = c.join(cash_book(tx, prices).alias("f"), F.col("c.customer_id") == F.col("f.customer_id"), "left")
    cash = F.coalesce(F.col("f.cash_balance"), F.lit(0).cast(S.MONEY)).cast(S.MONEY)
    hold = F.coalesce(F.col("f.holdings_value"), F.lit(0).cast(S.VALUE_SUM)).cast(S.VALUE_SUM)
    cols = [
        F.col("c.customer_id").alias("investor_id"),
        F.col("c.first_name"), F.col("c.last_name"), F.col("c.email"),
        F.col("c.segment").alias("investor_segment"),
        F.col("c.kyc_status"), F.col("c.risk_rating"), F.col("c.country"),
        F.col("c.onboarded_date"), F.col("c.tenure_days"),
        F.coalesce(F.col("f.activity_count"), F.lit(0).cast("long")).alias("activity_count"),
        F.coalesce(F.col("f.total_subscriptions"), F.lit(0).cast(S.MONEY_SUM)).alias("total_subscriptions"),
        F.coalesce(F.col("f.total_redemptions"), F.lit(0).cast(S.MONEY_SUM)).alias("total_redemptions"),
        F.coalesce(F.col("f.total_fees"), F.lit(0).cast(S.MONEY_SUM)).alias("total_fees"),
        cash.alias("cash_balance"),
        hold.alias("holdings_value"),
        F.coalesce(F.col("f.instruments_held"), F.lit(0).cast("long")).alias("instruments_held"),
        (cash.cast(_EXACT_VALUE) + hold.cast(_EXACT_VALUE)).cast(S.VALUE_SUM).alias("assets_under_management"),
        F.col("f.last_activity_ts").cast("timestamp_ntz").alias("last_activity_ts"),
    ]
    b = _built_at(built_at)
    return j.select(*cols, *([b] if b is not None else []))


# ------------------------------------------------------------- trading book

def trade_positions(trades: DataFrame) -> DataFrame:
    """Net quantity / cost and execution count per (customer, symbol).

    Only CANCELLED executions are excluded (a NULL status drops too, as in SQL
    three-valued logic); anything not BUY, NULL included, counts as a sell.
    """
    buy = F.col("side") == "BUY"
    return (trades.filter(F.col("status") != "CANCELLED")
                  .groupBy("customer_id", "symbol")
                  .agg(F.sum(F.when(buy, F.col("quantity")).otherwise(-F.col("quantity"))).cast(S.QTY_SUM).alias("net_quantity"),
                       F.sum(F.when(buy, F.col("notional")).otherwise(-F.col("notional"))).cast(S.MONEY_SUM).alias("net_cost"),
                       F.count(F.lit(1)).alias("trade_count")))


def latest_earnings(transcripts: DataFrame, enrich=None) -> DataFrame:
    """Newest transcript per symbol by fiscal period (string order), ties broken
    by file name, then by a digest of the text: exactly one row per symbol, also
    when a file name repeats.

    ``transcripts`` are enriched transcripts, or — with ``enrich`` (raw ->
    enriched) — the raw landing rows: then the newest file per symbol is chosen
    first and only those files go through the text job, one per symbol instead of
    the whole corpus.
    """
    rows = transcripts.withColumn("_digest", F.md5("parsed_text"))
    order = {"order": ["fiscal_period"], "tiebreak": ["file_name", "_digest"]}
    if enrich is None:
        e = rows.select("symbol", "fiscal_period", "file_name", "_digest", "sentiment", "summary")
        return latest_by_key(e, "symbol", **order).select("symbol", "sentiment", "summary")
    newest = latest_by_key(rows.select("symbol", "fiscal_period", "file_name", "_digest"), "symbol", **order).select(
        F.col("symbol").alias("s"), F.col("file_name").alias("f"), F.col("_digest").alias("d"))
    chosen = rows.join(newest, F.col("symbol").eqNullSafe(F.col("s")) & F.col("file_name").eqNullSafe(F.col("f"))
                       & F.col("_digest").eqNullSafe(F.col("d")), "left_semi").drop("_digest")
    # a file delivered twice with the same text is chosen twice: one row of the equal ones
    signals = enrich(chosen).select("symbol", "sentiment", "summary")
    return signals.groupBy("symbol").agg(F.max(F.struct("sentiment", "summary")).alias("e")).select("symbol", "e.sentiment", "e.summary")


def portfolio_risk(customers: DataFrame, trades: DataFrame, prices: DataFrame,
                   earnings: DataFrame | None, built_at=None, enrich=None) -> DataFrame:
    """Positions valued at the newest price, with the newest earnings signals.
    ``earnings`` are enriched transcripts, or raw ones with ``enrich`` (see
    :func:`latest_earnings`)."""
    pos = trade_positions(trades).filter(F.col("net_quantity") != 0).alias("p")
    pr = prices.select("symbol", "price", "asset_class").alias("pr")
    c = customers.select("customer_id", "segment", "risk_rating").alias("c")
    j = (pos.join(pr, F.col("p.symbol") == F.col("pr.symbol"), "inner")
            .join(c, F.col("p.customer_id") == F.col("c.customer_id"), "inner"))
    if earnings is not None:
        e = latest_earnings(earnings, enrich).alias("e")
        j = j.join(e, F.col("p.symbol") == F.col("e.symbol"), "left")
        sentiment, summary = F.col("e.sentiment"), F.col("e.summary")
    else:
        sentiment = summary = F.lit(None)
    mv = F.col("p.net_quantity").cast(_EXACT_QTY) * F.col("pr.price")
    cols = [
        F.col("p.customer_id").alias("investor_id"),
        F.col("c.segment").alias("investor_segment"),
        F.col("c.risk_rating"),
        F.col("p.symbol"),
        F.col("pr.asset_class"),
        F.col("p.net_quantity"),
        F.col("p.trade_count"),
        F.col("pr.price").alias("last_price"),
        F.round(mv, 2).cast(S.MONEY_SUM).alias("market_value"),
        F.round(F.abs(mv), 2).cast(S.MONEY_SUM).alias("gross_exposure"),
        F.round(mv.cast(_EXACT_VALUE) - F.col("p.net_cost").cast(_EXACT_VALUE), 2).cast(S.MONEY_SUM).alias("unrealized_pnl"),
        sentiment.cast("string").alias("earnings_sentiment"),
        summary.cast("string").alias("earnings_summary"),
    ]
    b = _built_at(built_at)
    return j.select(*cols, *([b] if b is not None else []))


def investor_risk(customers: DataFrame, risk: DataFrame, portfolio: DataFrame) -> DataFrame:
    pos = (portfolio.groupBy(F.col("investor_id").alias("customer_id"))
                    .agg(F.sum("gross_exposure").cast(S.MONEY_SUM).alias("derived_gross_exposure"),
                         F.count(F.lit(1)).alias("instruments_held"))).alias("pos")
    c = customers.alias("c")
    r = risk.alias("r")
    j = (c.join(r, F.col("c.customer_id") == F.col("r.customer_id"), "left")
          .join(pos, F.col("c.customer_id") == F.col("pos.customer_id"), "left"))
    return j.select(
        F.col("c.customer_id").alias("investor_id"),
        F.col("c.segment").alias("investor_segment"),
        F.col("c.risk_rating"), F.col("c.country"),
        F.col("r.as_of_date"), F.col("r.gross_exposure"), F.col("r.net_exposure"),
        F.col("r.var_95"), F.col("r.risk_limit"), F.col("r.limit_breach_flag"),
        F.coalesce(F.col("pos.derived_gross_exposure"), F.lit(0).cast(S.MONEY_SUM)).alias("portfolio_gross_exposure"),
        F.coalesce(F.col("pos.instruments_held"), F.lit(0).cast("long")).alias("instruments_held"),
    )
