"""Silver models: live rows, newest version per key, normalised codes.

Each function is ``DataFrame -> DataFrame`` and lazy; nothing runs until the
caller acts. Deleted rows are removed *before* the newest version is taken
(the contract "latest non-deleted record"), and newest-first ordering puts
NULL timestamps last.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import initcap_words
from ..operators.cdc import latest_by_key, live_rows

AS_OF_DEFAULT = None  # None -> current_date() at run time


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (dt.date, dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def stg_customers(customers: DataFrame, as_of=AS_OF_DEFAULT) -> DataFrame:
    c = latest_by_key(customers, "customer_id", order=["updated_at"], tiebreak=["_ingested_at"])
    return c.select(
        "customer_id",
        initcap_words("first_name").alias("first_name"),
        initcap_words("last_name").alias("last_name"),
        F.lower("email").alias("email"),
        F.upper("segment").alias("segment"),
        F.upper("kyc_status").alias("kyc_status"),
        F.upper("risk_rating").alias("risk_rating"),
        F.upper("country").alias("country"),
        "onboarded_date",
        F.datediff(_as_of(as_of), F.col("onboarded_date")).alias("tenure_days"),
    )


def stg_instrument_prices(prices: DataFrame) -> DataFrame:
    p = latest_by_key(prices, "symbol", order=["as_of_date", "updated_at"], tiebreak=["_ingested_at"])
    return p.select(
        "symbol",
        F.upper("asset_class").alias("asset_class"),
        "price",
        F.upper("currency").alias("currency"),
        "as_of_date",
    )


def stg_transactions(transactions: DataFrame) -> DataFrame:
    # no de-duplication: every change row is a cash-book event
    return live_rows(transactions).select(
        "txn_id", "account_id", "customer_id", "txn_ts",
        F.upper("txn_type").alias("txn_type"),
        "symbol", "quantity", "amount",
        F.upper("currency").alias("currency"),
        "balance_after",
    )


def stg_trades(trades: DataFrame) -> DataFrame:
    # no de-duplication: every change row is an execution
    return live_rows(trades).select(
        "trade_id", "customer_id", "symbol",
        F.upper("side").alias("side"),
        "quantity", "price", "notional",
        F.upper("book").alias("book"),
        F.upper("status").alias("status"),
        "trade_ts",
    )


def stg_risk_metrics(risk: DataFrame) -> DataFrame:
    r = latest_by_key(risk, "customer_id", order=["as_of_date", "updated_at"], tiebreak=["_ingested_at"])
    return r.select(
        "customer_id", "as_of_date", "gross_exposure", "net_exposure",
        "var_95", "risk_limit", "limit_breach_flag",
    )
