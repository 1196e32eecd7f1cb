import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators import cdc
from tallyforge.sources import adapter, schemas
from tallyforge.streaming import feed, keyed_state

SF = "/root/testdata/sf0.001"
INCLUDE = r"(core_banking\.transactions|customer_crm\.customers|market_ref\.instrument_prices|trading\.trades|trading\.risk_metrics)"
SOURCES = {"customers": "customer_crm.customers", "instrument_prices": "market_ref.instrument_prices", "transactions": "core_banking.transactions",
           "trades": "trading.trades", "risk_metrics": "trading.risk_metrics"}
KEYS, ORDER = ["customer_id"], ["updated_at", "_ingested_at"]


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_five_tables_from_one_feed(spark, scratch):
    bronze = adapter.bronze(spark, SF)
    entries = None
    for i, (table, source) in enumerate(SOURCES.items()):
        part = feed.to_feed(bronze[table], source, f"monotonically_increasing_id() * 8 + {i}")
        entries = part if entries is None else entries.unionByName(part)
    other = spark.createDataFrame([("audit.log", "c", -1, '{"x": 1}'), ("trading.trades_old", "c", -2, "{}"), (None, "c", -3, "{}")], feed.FEED)
    entries.unionByName(other).repartition(6).write.json(f"{scratch}/log")
    feed.land_feed(spark, f"{scratch}/log", f"{scratch}/raw", f"{scratch}/ck", INCLUDE, schemas.BRONZE, max_files_per_trigger=2)
    for table in SOURCES:
        got, want = feed.read_table(spark, f"{scratch}/raw", table), bronze[table]
        assert got.columns == [*want.columns, "_operation", "_sequence"]
        assert [f.dataType for f in got.schema][:-2] == [f.dataType for f in want.schema]
        assert rows_of(got, want.columns) == rows_of(want, want.columns)
        assert got.filter("(_operation = 'd') <> coalesce(_deleted, false)").count() == 0
    for left_out in ("log", "trades_old"):
        with pytest.raises(FileNotFoundError):
            feed.read_table(spark, f"{scratch}/raw", left_out)


def test_added_columns_repeats_deletes_and_broken_rows(spark, scratch):
    schema = {"t": T.StructType([T.StructField("id", T.LongType()), T.StructField("_deleted", T.BooleanType())])}
    first = [("s.t", "c", 1, '{"id": 1}'), ("s.t", "c", 2, '{"id": 2, "_deleted": false}')]
    second = [("s.t", "u", 3, '{"id": 1, "note": "new", "n": 5}'), ("s.t", "d", 4, '{"id": 2}'), ("s.t", "c", 2, '{"id": 2, "_deleted": false}'),
              ("s.t", "c", 5, "not json"), ("s.t", "c", 6, None), ("S.T", "c", 7, '{"id": 9}')]
    for part in (first, second):
        spark.createDataFrame(part, feed.FEED).coalesce(1).write.mode("append").json(f"{scratch}/log")
        feed.land_feed(spark, f"{scratch}/log", f"{scratch}/raw", f"{scratch}/ck", r"s\.t", schema)
    got = rows_of(feed.read_table(spark, f"{scratch}/raw", "t"), ["_sequence", "id", "_deleted", "_operation", "note", "n"])
    assert got == [(1, 1, None, "c", None, None), (2, 2, False, "c", None, None), (3, 1, None, "u", "new", "5"), (4, 2, True, "d", None, None)]
    assert sorted(r["sequence"] for r in spark.read.parquet(f"{scratch}/raw/_rejected/*/*").collect()) == [5, 6]


def test_keyed_state_any_order_any_batching_and_restart(spark, scratch):
    """Late, repeated and deleted versions in three deliveries, one file a micro-batch; the
    stream is started anew for each and goes on from its state."""
    changes = adapter.customers(spark, SF).filter("customer_id % 2 = 0")
    cut = F.lit("2024-02-01").cast("timestamp_ntz")
    late, early = changes.filter(F.col("updated_at") >= cut), changes.filter(F.col("updated_at") < cut)
    for part in (late, early.unionByName(late), early):
        part.repartition(2).write.mode("append").parquet(f"{scratch}/src")
        keyed_state.apply_stream(spark, f"{scratch}/src", schemas.CUSTOMERS, KEYS, ORDER, f"{scratch}/out", f"{scratch}/ck", max_files_per_trigger=2)
    names = schemas.CUSTOMERS.fieldNames()
    want = rows_of(cdc.live_view(cdc.apply_changes(None, changes, KEYS, ORDER)), names)
    assert rows_of(keyed_state.live_table(spark, f"{scratch}/out", KEYS), names) == want
    found = keyed_state.read_changes(spark, f"{scratch}/out")
    # only changes come out: no key twice in one state, nothing from repeated deliveries
    assert found.count() == found.select("customer_id", "updated_at").distinct().count() <= changes.count()
    last = found.agg(F.max("epoch")).first()[0]
    assert found.filter(F.col("epoch") == last).select("updated_at").distinct().count() <= 1


def test_keyed_state_kinds_of_changes(spark, scratch):
    schema = "id long, v string, at long, _deleted boolean"
    steps = [[(1, "a", 1, False), (2, "x", 5, True)], [(1, "b", 3, None), (1, "old", 2, False)], [(1, "b", 4, True), (2, "late", 4, False)],
             [(1, "c", 5, False), (3, None, None, False)], [(3, "n", 0, False), (1, "c", 5, False)]]
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/src/{i}")
        keyed_state.apply_stream(spark, f"{scratch}/src/*", spark.createDataFrame([], schema).schema, ["id"], ["at"], f"{scratch}/out", f"{scratch}/ck")
    got = sorted((r["epoch"], r["id"], r["v"], r["_change"]) for r in keyed_state.read_changes(spark, f"{scratch}/out").collect())
    assert got == [(0, 1, "a", "insert"), (1, 1, "b", "update"), (2, 1, "b", "delete"), (3, 1, "c", "insert"), (3, 3, None, "insert"), (4, 3, "n", "update")]


def test_keyed_state_calls_python_per_bucket_not_per_key(spark, scratch):
    """Composite keys with NULLs and long numbers; the state has a row per bucket however many keys there are."""
    big = (1 << 60) + 1
    schema = "id long, part string, n long, at long, _deleted boolean"
    first = [(big + i, ["a", None][i % 2], big + i if i % 3 else None, 1, False) for i in range(300)] + [(None, "z", 1, None, False)]
    second = [(big + i, ["a", None][i % 2], big - i, 2, i % 2 == 0) for i in range(0, 300, 3)] + [(None, "z", 2, None, False)]
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{scratch}/src/{i}")
        query = keyed_state.apply_stream(spark, f"{scratch}/src/*", spark.createDataFrame([], schema).schema, ["id", "part"], ["at"],
                                         f"{scratch}/out", f"{scratch}/ck", buckets=16)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 16
    live = {r[:2]: r[2:4] for r in map(tuple, keyed_state.live_table(spark, f"{scratch}/out", ["id", "part"]).collect())}
    want = {r[:2]: r[2:4] for r in first} | {r[:2]: r[2:4] for r in second}
    held = {k: v for k, v in want.items() if k[0] is None or not any(k == r[:2] and r[4] for r in second)}
    assert {k: v for k, v in live.items() if k[0] is not None} == {k: v for k, v in held.items() if k[0] is not None}
    assert len(live) == len(held) == 251


def test_log_and_stored_batch_are_compressed(spark, scratch):
    """Row texts repeat their column names: the log takes a fraction of its text, in files of bounded rows."""
    bronze = adapter.transactions(spark, SF)
    entries = feed.to_feed(bronze, SOURCES["transactions"], "monotonically_increasing_id()").cache()
    feed.append_log(entries, f"{scratch}/log")
    feed.append_log(entries.limit(0), f"{scratch}/log")
    files = [f for f in spark.read.json(f"{scratch}/log", schema=feed.FEED).inputFiles()]
    assert files and all(f.endswith(".json.gz") for f in files)
    text = entries.agg(F.sum(F.length("row"))).first()[0]
    size = spark.read.format("binaryFile").load(f"{scratch}/log/*.gz").agg(F.sum("length")).first()[0]
    assert size < 0.25 * text
    feed.land_feed(spark, f"{scratch}/log", f"{scratch}/raw", f"{scratch}/ck", INCLUDE, schemas.BRONZE)
    got = feed.read_table(spark, f"{scratch}/raw", "transactions")
    assert all(".zstd." in f for f in got.inputFiles()) and rows_of(got, bronze.columns) == rows_of(bronze, bronze.columns)
