"""Driver tables -> bronze change-feed tables.

The test data is a TPC-H-like star (customer, part, orders, lineitem,
documents). The bronze tables of the investor model are derived from it with
integer arithmetic only, so that any SQL engine can derive identical rows.
Every derivation is a narrow projection over one scan (versions are produced
with ``explode`` instead of a self-union, so each driver table is read once),
except trades, which needs the order's customer and therefore one equi-join
of lineitem with orders on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S

# Mapping of driver categories to investor-model categories.
# Lower/mixed case on purpose, so that the silver layer's normalisation has work.
SEGMENT_BY_MKTSEGMENT = {
    "AUTOMOBILE": "institutional",
    "BUILDING": "pension",
    "FURNITURE": "endowment",
    "HOUSEHOLD": "hnw",
    "MACHINERY": "wealth",
}
ASSET_CLASS_BY_PTYPE = {
    "ECONOMY": "equity",
    "MEDIUM": "equity",
    "STANDARD": "etf",
    "PROMO": "bond",
    "SMALL": "fx",
    "LARGE": "crypto",
}
COUNTRY_BY_NATION_MOD6 = {2: "gb", 3: "ca", 4: "de", 5: "sg"}  # anything else: "us"
TXN_TYPE_BY_MOD5 = ["deposit", "withdrawal", "trade_buy", "trade_sell", "fee"]
BOOK_BY_MOD4 = ["equity", "fixed_income", "fx", "derivatives"]

LOADED_AT = "2026-01-01 00:00:00"

# Fixed values of the derivation: symbols SYM000 .. SYM999, of which the last two
# never get a price; customer ids from UNKNOWN_ID on belong to nobody.
SYMBOLS = 1000
PRICED_SYMBOLS = 998
UNKNOWN_ID = 10_000_000
# Sentences added to the texts by doc_id % 5: positive, negative, mixed, outlook, none.
PLANTED_SENTENCES = (
    " We had a record quarter with strong growth and robust momentum. We expect further gains next year.",
    " Demand was weak and margins declined under pressure. Losses and headwinds will persist.",
    " Strong growth met weak demand and losses.",
    " Our guidance and outlook for the coming year follow in due course.",
    "",
)


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _date(s: str) -> Column:
    return F.lit(s).cast("date")


def _lookup(mapping: dict, key: Column) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), key)


def _symbol(n: Column) -> Column:
    return F.concat(F.lit("SYM"), F.lpad(n.cast("string"), 3, "0"))


def _owner(unknown: Column) -> Column:
    """The order's customer, or nobody's id where ``unknown`` holds (a broken reference)."""
    return F.when(unknown, F.col("o_custkey") + UNKNOWN_ID).otherwise(F.col("o_custkey"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its declared schema (no schema-inference job)."""
    return spark.read.schema(S.DRIVER_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


_read = read_table


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    # version 0 for every customer, version 1 (a later update) for every tenth
    c = c.withColumn("ver", F.explode(F.when(key % 10 == 0, F.array(F.lit(0), F.lit(1)))
                                      .otherwise(F.array(F.lit(0)))))
    ver, text = F.col("ver"), key.cast("string")
    risk = (key + ver) % 4
    nat6 = F.col("c_nationkey") % 6
    updated = F.when(ver == 1, _ts("2024-02-01 00:00:00")).otherwise(_ts("2024-01-01 00:00:00"))
    return c.select(
        key.alias("customer_id"),
        # several words, hyphens, apostrophes and brackets: work for the word rule
        F.when(key % 4 == 0, F.concat(F.lit("FIRST"), text))
         .when(key % 4 == 1, F.concat(F.lit("mary-jane "), text))
         .when(key % 4 == 2, F.concat(F.lit("o'NEIL ann"), text))
         .otherwise(F.concat(F.lit("JEAN luc."), text, F.lit("x"))).alias("first_name"),
        F.when(key % 3 == 0, F.concat(F.lit("last"), text))
         .when(key % 3 == 1, F.concat(F.lit("van DER berg-"), text, F.lit("b")))
         .otherwise(F.concat(F.lit("d'ARC (smith) "), text)).alias("last_name"),
        F.concat(F.lit("Cust"), key.cast("string"), F.lit("@Example.com")).alias("email"),
        _lookup(SEGMENT_BY_MKTSEGMENT, F.col("c_mktsegment")).alias("segment"),
        F.when(key % 5 <= 2, "verified").when(key % 5 == 3, "pending").otherwise("review").alias("kyc_status"),
        F.when(risk <= 1, "low").when(risk == 2, "medium").otherwise("high").alias("risk_rating"),
        F.coalesce(_lookup(COUNTRY_BY_NATION_MOD6, nat6), F.lit("us")).alias("country"),
        F.date_add(_date("2019-01-01"), (key % 2200).cast("int")).alias("onboarded_date"),
        updated.alias("updated_at"),
        updated.alias("_ingested_at"),
        F.when((ver == 1) & (key % 50 == 0), F.lit(True))
         .when(key % 7 == 0, F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)).alias("_deleted"),
    )


def instrument_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part is a price version of the symbol ``p_partkey % 998`` for the day
    ``p_partkey div 998``; every third has a later correction of the same day."""
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    key = F.col("p_partkey")
    p = p.withColumn("ver", F.explode(F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1)))
                                      .otherwise(F.array(F.lit(0)))))
    ver = F.col("ver")
    updated = F.when(ver == 1, _ts("2024-01-03 00:00:00")).otherwise(_ts("2024-01-02 00:00:00"))
    return p.select(
        _symbol(key % PRICED_SYMBOLS).alias("symbol"),
        _lookup(ASSET_CLASS_BY_PTYPE, F.split(F.col("p_type"), " ").getItem(0)).alias("asset_class"),
        (F.col("p_retailprice").cast(S.PRICE) + 9 * ver).cast(S.PRICE).alias("price"),
        F.lit("usd").alias("currency"),
        F.date_add(_date("2024-01-01"), F.floor(key / PRICED_SYMBOLS).cast("int")).alias("as_of_date"),
        updated.alias("updated_at"),
        updated.alias("_ingested_at"),
        F.lit(False).alias("_deleted"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    key = F.col("o_orderkey")
    kind = key % 5
    is_trade = kind.isin(2, 3)
    amount = F.col("o_totalprice").cast(S.MONEY)
    return o.select(
        key.alias("txn_id"),
        (F.lit(100000) + F.col("o_custkey")).alias("account_id"),
        _owner(key % 103 == 0).alias("customer_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("txn_ts"),
        F.element_at(F.array(*[F.lit(t) for t in TXN_TYPE_BY_MOD5]), (kind + 1).cast("int")).alias("txn_type"),
        F.when(is_trade, _symbol((key + F.col("o_custkey")) % SYMBOLS)).alias("symbol"),
        F.when(is_trade, (F.lit(1) + key % 100).cast(S.QTY)).alias("quantity"),
        amount.alias("amount"),
        F.lit("usd").alias("currency"),
        (amount - F.lit(100000)).cast(S.MONEY).alias("balance_after"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("_ingested_at"),
        (key % 97 == 0).alias("_deleted"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    t = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    ln = F.col("l_linenumber") % 5
    return t.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        _owner(F.col("l_orderkey") % 101 == 0).alias("customer_id"),
        _symbol(F.col("l_partkey") % SYMBOLS).alias("symbol"),
        F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("side"),
        F.col("l_quantity").cast(S.QTY).alias("quantity"),
        F.col("l_extendedprice").cast(S.PRICE).alias("price"),
        F.col("l_extendedprice").cast(S.MONEY).alias("notional"),
        F.element_at(F.array(*[F.lit(b) for b in BOOK_BY_MOD4]), (F.col("l_suppkey") % 4 + 1).cast("int")).alias("book"),
        F.when(ln == 3, "partial").when(ln == 4, "cancelled").otherwise("filled").alias("status"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("trade_ts"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("updated_at"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("_ingested_at"),
        (F.col("l_orderkey") % 89 == 0).alias("_deleted"),
    )


def risk_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey")
    key = F.col("c_custkey")
    # snapshot 0 for all but every 40th customer, snapshot 1 for every fourth
    c = c.withColumn("ver", F.explode(F.array_compact(F.array(
        F.when(key % 40 != 39, F.lit(0)), F.when(key % 4 == 0, F.lit(1))))))
    ver = F.col("ver")
    gross = (F.lit(10000) + (key * 7919 + ver) % 990000).cast(S.MONEY)
    var95 = (F.lit(5000) + (key * 7919 + 31 * ver) % 200000).cast(S.MONEY)
    limit = (F.lit(50000) + (key * 104729) % 200000).cast(S.MONEY)
    as_of = F.date_add(_date("2024-01-01"), ver)
    return c.select(
        key.alias("customer_id"),
        as_of.alias("as_of_date"),
        gross.alias("gross_exposure"),
        (gross - key % 5000).cast(S.MONEY).alias("net_exposure"),
        var95.alias("var_95"),
        limit.alias("risk_limit"),
        (var95 > limit).alias("limit_breach_flag"),
        as_of.cast("timestamp_ntz").alias("updated_at"),
        as_of.cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(False).alias("_deleted"),
    )


def document_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document stage: one file per driver document, ``(path, file_name, content)``.

    Names follow the transcript convention ``EARNINGS_SYMnnn_yyyyQn_d<id>.<ext>``
    (upper-case ``.PDF`` mostly, some ``.txt`` and ``.html``); every 50th document
    gets a name without keys, every 100th the name of the document before it, in
    another folder. HTML files hold the text as a page.
    """
    d = _read(spark, sf_dir, "documents").select("doc_id", "text")
    did = F.col("doc_id")
    own = F.when(did % 100 == 9, did - 1).otherwise(did)      # the id in the name
    ext = F.when(own % 10 == 3, F.lit(".html")).when(own % 10 == 6, F.lit(".txt")).otherwise(F.lit(".PDF"))
    earnings = F.concat(
        F.lit("EARNINGS_"), _symbol(own % SYMBOLS), F.lit("_"), (F.lit(2024) + own % 3).cast("string"),
        F.lit("Q"), (F.lit(1) + own % 4).cast("string"), F.lit("_d"), own.cast("string"), ext)
    notes = F.concat(F.lit("NOTES_d"), did.cast("string"), F.lit(".PDF"))
    planted = F.element_at(F.array(*[F.lit(x) for x in PLANTED_SENTENCES]), (did % 5 + 1).cast("int"))
    text = F.concat("text", planted)
    named = d.select(did, F.when(did % 50 == 7, notes).otherwise(earnings).alias("file_name"), text.alias("text"))
    return named.select(
        F.concat(F.lit("stage/"), did.cast("string"), F.lit("/"), "file_name").alias("path"), "file_name",
        F.when(F.col("file_name").endswith(".html"), F.concat(F.lit("<html><body><p>"), "text", F.lit("</p></body></html>")))
         .otherwise(F.col("text")).alias("content"))


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five change-feed bronze tables plus the document stage (lazy)."""
    return {
        "customers": customers(spark, sf_dir),
        "instrument_prices": instrument_prices(spark, sf_dir),
        "transactions": transactions(spark, sf_dir),
        "trades": trades(spark, sf_dir),
        "risk_metrics": risk_metrics(spark, sf_dir),
        "doc_stage": document_stage(spark, sf_dir),
    }
