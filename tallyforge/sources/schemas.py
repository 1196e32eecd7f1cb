"""Bronze (landing) schemas and value domains.

Bronze tables carry two change-feed metadata columns: ``_ingested_at`` and
``_deleted`` (soft-delete flag; NULL means live).
"""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _D, _TS, _B = T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()
PRICE = T.DecimalType(18, 4)
QTY = T.DecimalType(18, 4)
MONEY = T.DecimalType(18, 2)

# Published output types (fixed so that every engine reports the same scale).
MONEY_SUM = T.DecimalType(38, 2)
QTY_SUM = T.DecimalType(38, 4)
VALUE_SUM = T.DecimalType(38, 8)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_CDC = (("updated_at", _TS), ("_ingested_at", _TS), ("_deleted", _B))

CUSTOMERS = _struct(
    ("customer_id", _L), ("first_name", _S), ("last_name", _S), ("email", _S),
    ("segment", _S), ("kyc_status", _S), ("risk_rating", _S), ("country", _S),
    ("onboarded_date", _D), *_CDC)

INSTRUMENT_PRICES = _struct(
    ("symbol", _S), ("asset_class", _S), ("price", PRICE), ("currency", _S),
    ("as_of_date", _D), *_CDC)

TRANSACTIONS = _struct(
    ("txn_id", _L), ("account_id", _L), ("customer_id", _L), ("txn_ts", _TS),
    ("txn_type", _S), ("symbol", _S), ("quantity", QTY), ("amount", MONEY),
    ("currency", _S), ("balance_after", MONEY), *_CDC)

TRADES = _struct(
    ("trade_id", _L), ("customer_id", _L), ("symbol", _S), ("side", _S),
    ("quantity", QTY), ("price", PRICE), ("notional", MONEY), ("book", _S),
    ("status", _S), ("trade_ts", _TS), *_CDC)

RISK_METRICS = _struct(
    ("customer_id", _L), ("as_of_date", _D), ("gross_exposure", MONEY),
    ("net_exposure", MONEY), ("var_95", MONEY), ("risk_limit", MONEY),
    ("limit_breach_flag", _B), *_CDC)

EARNINGS_TRANSCRIPTS = _struct(
    ("file_name", _S), ("symbol", _S), ("fiscal_period", _S),
    ("parsed_text", _S), ("loaded_at", _TS))

# Document stage listing: one row per file.
DOC_STAGE = _struct(("file_name", _S), ("content", _S))

BRONZE = {
    "customers": CUSTOMERS,
    "instrument_prices": INSTRUMENT_PRICES,
    "transactions": TRANSACTIONS,
    "trades": TRADES,
    "risk_metrics": RISK_METRICS,
}

# Accepted value domains of the data contracts.
SEGMENTS = ["INSTITUTIONAL", "PENSION", "ENDOWMENT", "HNW", "WEALTH"]
RISK_RATINGS = ["LOW", "MEDIUM", "HIGH"]
SIDES = ["BUY", "SELL"]
SENTIMENTS = ["positive", "negative", "neutral", "mixed"]
TXN_TYPES = ["DEPOSIT", "WITHDRAWAL", "TRADE_BUY", "TRADE_SELL", "FEE"]
TRADE_STATUSES = ["FILLED", "PARTIAL", "CANCELLED"]
KYC_STATUSES = ["VERIFIED", "PENDING", "REVIEW"]
ASSET_CLASSES = ["EQUITY", "ETF", "BOND", "FX", "CRYPTO"]
BOOKS = ["EQUITY", "FIXED_INCOME", "FX", "DERIVATIVES"]

# Declared schemas of the driver tables: reading with a declared schema skips
# the footer-inference job of every scan and fails fast on a changed layout.
DRIVER_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
