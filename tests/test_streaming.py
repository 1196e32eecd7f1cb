import os

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import cdc
from tallyforge.sources import adapter, schemas
from tallyforge.streaming import changefeed, documents as docstream

KEYS, ORDER = "customer_id", ["updated_at", "_ingested_at"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*schemas.CUSTOMERS.fieldNames()).collect())


def test_stream_apply_replay_equals_batch(spark, scratch):
    changes = adapter.customers(spark, "/root/testdata/sf0.001")
    src, state, ck = f"{scratch}/src", f"{scratch}/state", f"{scratch}/ck"
    # deliver the later updates first, then the initial load: order must not matter
    late = changes.filter(F.col("updated_at") >= F.lit("2024-02-01").cast("timestamp_ntz"))
    early = changes.filter(F.col("updated_at") < F.lit("2024-02-01").cast("timestamp_ntz"))
    late.write.parquet(f"{src}/b1")
    changefeed.stream_apply(spark, f"{src}/*", schemas.CUSTOMERS, KEYS, ORDER, state, ck)
    early.write.parquet(f"{src}/b2")
    early.write.parquet(f"{src}/b3")  # re-delivery of the same rows
    changefeed.stream_apply(spark, f"{src}/*", schemas.CUSTOMERS, KEYS, ORDER, state, ck)
    live = changefeed.read_live(spark, state, KEYS, ORDER)
    batch = cdc.live_view(cdc.apply_changes(None, changes, KEYS, ORDER))
    assert _rows(live) == _rows(batch)
    # compaction keeps the state, and so do changes that come after it
    assert changefeed.compact(spark, state, KEYS, ORDER) == 0        # each epoch may still be written
    changefeed.stream_apply(spark, f"{src}/*", schemas.CUSTOMERS, KEYS, ORDER, state, ck, max_files_per_trigger=1)
    assert _rows(changefeed.read_live(spark, state, KEYS, ORDER)) == _rows(batch)


def test_new_checkpoint_on_an_old_state_loses_nothing(spark, scratch):
    """A stream that starts over counts its epochs from 0 again, in a folder of its own."""
    changes = adapter.customers(spark, "/root/testdata/sf0.001").cache()
    state = f"{scratch}/state"
    for part in range(3):
        src = f"{scratch}/src{part}"
        changes.filter(F.col("customer_id") % 3 == part).repartition(3).write.parquet(src)
        changefeed.stream_apply(spark, src, schemas.CUSTOMERS, KEYS, ORDER, state, f"{scratch}/ck{part}", max_files_per_trigger=1)
    want = _rows(cdc.live_view(cdc.apply_changes(None, changes, KEYS, ORDER)))
    assert _rows(changefeed.read_live(spark, state, KEYS, ORDER)) == want
    assert changefeed.compact(spark, state, KEYS, ORDER) >= 3
    assert _rows(changefeed.read_live(spark, state, KEYS, ORDER)) == want
    changefeed.compact(spark, state, KEYS, ORDER)
    assert _rows(changefeed.read_live(spark, state, KEYS, ORDER)) == want
    changes.unpersist()


def test_state_faults_are_raised(spark, scratch):
    with pytest.raises(FileNotFoundError):
        changefeed.read_state(spark, f"{scratch}/nothing", KEYS, ORDER)
    os.makedirs(f"{scratch}/bad/run=x/epoch=0")
    with open(f"{scratch}/bad/run=x/epoch=0/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        changefeed.read_state(spark, f"{scratch}/bad", KEYS, ORDER).count()


def test_sync_takes_new_and_changed_files(spark, scratch):
    src, out = f"{scratch}/stage", f"{scratch}/landed"
    os.makedirs(f"{src}/sub")

    def put(name, data, when):
        with open(f"{src}/{name}", "wb") as f:
            f.write(data)
        os.utime(f"{src}/{name}", (when, when))

    def landed():
        return sorted((r.path.rsplit("/stage/", 1)[1], r.symbol, r.parsed_text, r.error) for r in docstream.current_documents(spark, out).collect())

    put("EARNINGS_SYM001_2026Q1.pdf", b"first", 1_700_000_000)
    put("skip.txt", b"no", 1_700_000_000)
    assert docstream.sync_documents(spark, src, out) == 1
    assert docstream.sync_documents(spark, src, out) == 0
    put("sub/EARNINGS_SYM001_2026Q1.pdf", b"same name", 1_700_000_100)
    put("EARNINGS_SYM001_2026Q1.pdf", b"second", 1_700_000_200)          # rewritten in place
    put("old.PDF", b"\xff\xfe%PDF", 1_600_000_000)                       # late, with an old time, and binary
    assert docstream.sync_documents(spark, src, out) == 3
    assert landed() == [("EARNINGS_SYM001_2026Q1.pdf", "SYM001", "second", None), ("old.PDF", None, None, "not UTF-8 text"),
                        ("sub/EARNINGS_SYM001_2026Q1.pdf", "SYM001", "same name", None)]
    assert docstream.sync_documents(spark, src, out) == 0


def test_docs_sync_lands_the_texts(spark):
    from tallyforge import registry
    sf = "/root/testdata/sf0.001"
    got = registry.queries()["docs_sync_texts"](spark, sf).select("doc_id", "text_chars", "text_digest")
    docs = adapter.read_table(spark, sf, "documents").select(
        "doc_id", F.length("text").cast("long").alias("text_chars"), F.sha2("text", 256).alias("text_digest"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
