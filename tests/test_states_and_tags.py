import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import governance, quality, slice_metrics, tag_lineage
from tallyforge.plans import semantic
from tallyforge.plans.lattice import Lattice

INVESTORS = [(i, ["HNW", "PENSION", None][i % 3], ["LOW", "HIGH"][i % 2], "verified", ["US", "GB", "DE", "JP"][i % 4], i, i * 1000, i * 10, i, i * 7, i * 2, i % 5, 1, 2)
             for i in range(1, 60)]
SCHEMA = ("investor_id long, investor_segment string, risk_rating string, kyc_status string, country string, tenure_days int, assets_under_management decimal(18,2), "
          "holdings_value decimal(18,2), cash_balance decimal(18,2), total_subscriptions decimal(18,2), total_redemptions decimal(18,2), total_fees decimal(18,2), "
          "activity_count long, instruments_held long")


@pytest.fixture(scope="module")
def investors(spark):
    return spark.createDataFrame([(*r[:6], *r[6:]) for r in INVESTORS], SCHEMA.replace("decimal(18,2)", "int")).select(
        *[F.col(c).cast("decimal(18,2)") if "decimal" in t else F.col(c) for c, t in (x.strip().split(" ", 1) for x in SCHEMA.split(", "))])


METRICS = ["investor_count", "total_aum", "avg_aum", "total_net_flows"]


def test_lattice_answers_equal_the_direct_query(spark, scratch, investors):
    view = semantic.investors_view(investors)
    lattice = Lattice.build(view, f"{scratch}/lattice", ["client segment", "risk", "country"], METRICS,
                            levels=[["investor_segment", "risk_rating"], ["country"], []])
    for dims in ([], ["country"], ["risk level"], ["client segment", "risk"], ["country", "risk_rating"], ["investor_segment", "risk_rating", "country"]):
        got, want = lattice.query(dims, METRICS), view.query(dims, METRICS)
        assert got.columns == want.columns
        exact = lambda df: sorted((tuple(round(float(x), 6) if i >= len(dims) else str(x) for i, x in enumerate(r)) for r in df.collect()), key=repr)
        assert exact(got) == exact(want)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" not in plan and "lattice" in got.inputFiles()[0]              # stored states, not the base
    assert "/coarser/level=" in lattice.level_of(frozenset(["country"])) and lattice.level_of(frozenset(["country", "risk_rating"])).endswith("/finest")
    got = {r["country"]: r["total_aum"] for r in lattice.query(["country"], ["total_aum"], where={"risk": ["LOW"], "client segment": ["HNW", None]}).collect()}
    want = {r["country"]: r["total_aum"] for r in view.query(["country"], ["total_aum"], where="risk_rating = 'LOW' AND coalesce(investor_segment, 'HNW') = 'HNW'").collect()}
    assert got == want
    with pytest.raises(KeyError):
        lattice.query(["tenure_days"], ["total_aum"])
    with pytest.raises(KeyError):
        lattice.query([], ["total_cash"])
    assert Lattice.build(semantic.investors_view(investors.limit(0)), f"{scratch}/none", ["risk"], METRICS).query(["risk"], METRICS).count() == 0


SPECS = [quality.row_count(), quality.null_count("email"), quality.duplicate_count("id"), quality.count_where("neg", "x < 0", "x")]


def test_slices_that_did_not_change_are_not_read(spark, scratch):
    path, root = f"{scratch}/table", f"{scratch}/metrics"
    rows = [(i % 40 if i % 11 else None, None if i % 6 == 0 else "e", i - 50, f"s{i % 4}") for i in range(200)]
    schema = "id long, email string, x int, part string"
    spark.createDataFrame(rows, schema).write.partitionBy("part").parquet(path)

    def whole():
        return sorted(map(tuple, quality.metrics(spark.read.parquet(path), SPECS, "t").collect()))

    def run(hour):
        totals, read = slice_metrics.measure(spark, path, "part", SPECS, "t", root, dt.datetime(2026, 1, 1, hour))
        return sorted(map(tuple, totals.collect())), read

    assert run(0) == (whole(), ["s0", "s1", "s2", "s3"])
    assert run(1) == (whole(), [])
    first = whole()
    spark.createDataFrame([(500, None, -1), (1, "e", 3)], "id long, email string, x int").write.mode("append").parquet(f"{path}/part=s2")
    spark.createDataFrame([(7, "e", 3), (7, "e", 3), (None, "e", 1)], "id long, email string, x int").write.parquet(f"{path}/part=new")
    spark.createDataFrame([(2, "e", 3)], "id long, email string, x int").write.mode("overwrite").parquet(f"{path}/part=s0")
    assert run(2) == (whole(), ["new", "s0", "s2"]) and whole() != first
    plan = slice_metrics.changed_rows(spark, path, "part", ["s2"])
    assert {f.rsplit("/", 2)[-2] for f in plan.inputFiles()} >= {"part=s2"}
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(?coalesce\(part#", scan)
    history = spark.read.parquet(f"{root}/history")
    assert history.count() == 3 * len(SPECS) and history.select("measured_at").distinct().count() == 3


def test_tags_follow_expressions_joins_and_tables(spark, investors):
    people = spark.createDataFrame([(1, "a@x.org", "Ann", "US"), (2, None, "Bob", "GB")], "id long, email string, first_name string, country string")
    people = governance.tag_pii(people, {"email": "EMAIL", "first_name": "NAME", "country": "COUNTRY"}, ("email", "first_name"))
    orders = spark.createDataFrame([(1, 10), (2, 20)], "id long, amount long")
    derived = people.join(orders, "id").select(
        "id", "amount", F.upper("email").alias("address"), F.concat("first_name", F.lit("!")).alias("greeting"), F.coalesce("email", "first_name").alias("contact"),
        F.length("email").alias("n"), F.col("country").alias("land"), F.explode(F.split("email", "@")).alias("piece"))
    derived = derived.unionByName(derived).groupBy("id", "address", "greeting", "contact", "n", "land", "piece").agg(F.sum("amount").alias("total"), F.max("address").alias("last"))
    tags = tag_lineage.derived_tags(derived)
    kind = {c: (t.get("pii"), t.get("semantic_category")) for c, t in tags.items()}
    assert kind == {"id": (None, None), "total": (None, None), "address": ("Y", "EMAIL"), "last": ("Y", "EMAIL"), "greeting": ("Y", "DERIVED"),
                    "contact": ("Y", "DERIVED"), "n": ("Y", "DERIVED"), "land": (None, "COUNTRY"), "piece": ("Y", "DERIVED")}
    python = people.mapInArrow(lambda b: b, people.schema).select("country")
    assert tag_lineage.derived_tags(python)["country"]["pii"] == "Y"
    spark.sql("CREATE DATABASE IF NOT EXISTS tags_test")
    try:
        stored = tag_lineage.publish(derived, "tags_test.derived", roles=("analyst", "admin"))
        assert {f.name for f in stored.schema.fields if (f.metadata or {}).get("pii") == "Y"} == {"address", "last", "greeting", "contact", "n", "piece"}
        assert sorted(r["address"] for r in stored.collect() if r["address"]) == ["A@X.ORG", "A@X.ORG"]
        seen = spark.table("tags_test.derived_for_analyst").select("id", "address", "greeting", "n", "land", "total").distinct().collect()
        assert sorted(map(tuple, seen)) == [(1, "****@X.ORG", "****MASKED****", "****MASKED****", "US", 20)]
        assert sorted(map(tuple, spark.table("tags_test.derived_for_admin").collect())) == sorted(map(tuple, stored.collect()))
        # governance.apply_masking works on the propagated tags as well
        masked = governance.apply_masking(tag_lineage.propagate(derived), "analyst")
        assert {r["contact"] for r in masked.collect()} == {"****MASKED****"}
    finally:
        spark.sql("DROP DATABASE tags_test CASCADE")
