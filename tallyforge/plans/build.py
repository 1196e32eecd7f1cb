"""Gated build of the silver and gold models.

``build`` runs every model as soon as the models it reads are done, several
independent ones at a time. Silver models stay lazy (views); gold models are
rebuilt as catalog tables of their layer and read back, so their tests and
their dependants read the stored table instead of re-running the upstream plan,
and a failed build never replaces a table. After each model its tests run; when
an error-severity test fails, every model downstream of it is skipped
(reported, not built).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality as Q
from ..operators import signals
from ..session import materialize
from ..sources import documents, schemas, sinks
from . import marts, staging

# The data contracts: 32 tests over 9 models.
MODEL_TESTS: dict[str, list[Q.DataTest]] = {
    "stg_customers": [
        Q.not_null("customer_id"), Q.unique("customer_id"),
        Q.accepted_values("segment", schemas.SEGMENTS),
        Q.accepted_values("risk_rating", schemas.RISK_RATINGS),
    ],
    "stg_instrument_prices": [Q.not_null("symbol"), Q.unique("symbol"), Q.not_null("price")],
    "stg_transactions": [
        Q.not_null("txn_id"), Q.unique("txn_id"), Q.not_null("customer_id"),
        Q.relationships("customer_id", "stg_customers", "customer_id"),
    ],
    "stg_trades": [
        Q.not_null("trade_id"), Q.unique("trade_id"), Q.not_null("customer_id"),
        Q.relationships("customer_id", "stg_customers", "customer_id"),
        Q.accepted_values("side", schemas.SIDES),
    ],
    "stg_risk_metrics": [Q.not_null("customer_id"), Q.unique("customer_id"), Q.not_null("var_95")],
    "stg_earnings_transcripts": [
        Q.not_null("symbol"), Q.accepted_values("sentiment", schemas.SENTIMENTS),
    ],
    "investor_360": [
        Q.not_null("investor_id"), Q.unique("investor_id"), Q.not_null("assets_under_management"),
        Q.accepted_values("investor_segment", schemas.SEGMENTS),
    ],
    "portfolio_risk": [
        Q.not_null("investor_id"), Q.not_null("symbol"), Q.not_null("gross_exposure"),
        Q.accepted_values("earnings_sentiment", schemas.SENTIMENTS, where="earnings_sentiment is not null"),
    ],
    "investor_risk": [Q.not_null("investor_id"), Q.unique("investor_id"), Q.not_null("var_95")],
}

# Model -> upstream models (silver depends on bronze sources, not listed).
DEPENDS_ON: dict[str, tuple[str, ...]] = {
    "stg_customers": (), "stg_instrument_prices": (), "stg_transactions": (), "stg_trades": (),
    "stg_risk_metrics": (), "stg_earnings_transcripts": (),
    "investor_360": ("stg_customers", "stg_transactions", "stg_instrument_prices"),
    "portfolio_risk": ("stg_customers", "stg_trades", "stg_instrument_prices", "stg_earnings_transcripts"),
    "investor_risk": ("stg_customers", "stg_risk_metrics", "portfolio_risk"),
}
GOLD = ("investor_360", "portfolio_risk", "investor_risk")

def model_builders(bronze: Mapping[str, DataFrame], as_of=None, built_at=True,
                   text_options: Mapping | None = None) -> dict[str, Callable[[dict], DataFrame]]:
    """Model name -> function(built models) -> DataFrame."""
    text_options = dict(text_options or {})
    return {
        "stg_customers": lambda m: staging.stg_customers(bronze["customers"], as_of),
        "stg_instrument_prices": lambda m: staging.stg_instrument_prices(bronze["instrument_prices"]),
        "stg_transactions": lambda m: staging.stg_transactions(bronze["transactions"]),
        "stg_trades": lambda m: staging.stg_trades(bronze["trades"]),
        "stg_risk_metrics": lambda m: staging.stg_risk_metrics(bronze["risk_metrics"]),
        "stg_earnings_transcripts": lambda m: signals.stg_earnings_transcripts(
            documents.transcripts_raw(bronze["doc_stage"], pattern="%"), **text_options),
        "investor_360": lambda m: marts.investor_360(
            m["stg_customers"], m["stg_transactions"], m["stg_instrument_prices"], built_at=built_at),
        "portfolio_risk": lambda m: marts.portfolio_risk(
            m["stg_customers"], m["stg_trades"], m["stg_instrument_prices"], m["stg_earnings_transcripts"],
            built_at=built_at),
        "investor_risk": lambda m: marts.investor_risk(m["stg_customers"], m["stg_risk_metrics"], m["portfolio_risk"]),
    }


# Models read by more than one consumer downstream whose derivation costs a
# shuffle or the text job: stored once when models are evaluated together
# without a sink.
SHARED = ("stg_customers", "stg_trades", "stg_earnings_transcripts", "portfolio_risk")


def lazy_models(bronze: Mapping[str, DataFrame], as_of=None, built_at=None, text_options=None,
                materialize_as=None, store=SHARED) -> dict[str, DataFrame]:
    """All nine models (no sink, no gating). With ``materialize_as(df, name)``
    the models named in ``store`` are computed once and stored."""
    builders = model_builders(bronze, as_of, built_at, text_options)
    built: dict[str, DataFrame] = {}
    for name in DEPENDS_ON:
        df = builders[name](built)
        if materialize_as is not None and name in store:
            df = materialize_as(df, name)
        built[name] = df
    return built


SILVER = tuple(n for n in DEPENDS_ON if n.startswith("stg_"))


def register_views(models: Mapping[str, DataFrame], names=SILVER, prefix: str = "") -> None:
    """Silver models are views: register them by name (evaluated on read)."""
    for n in names:
        if n in models:
            models[n].createOrReplaceTempView(f"{prefix}{n}")


@dataclass
class BuildResult:
    models: dict[str, DataFrame]
    status: dict[str, str]          # success | failed_tests | skipped
    tests: list[tuple]              # (model, test, column, failures, severity)


def build(spark: SparkSession, bronze: Mapping[str, DataFrame], sink: str | None = None,
          fmt: str = "parquet", as_of=None, built_at=None, tests: Mapping | None = None,
          text_options=None, schema: str | None = None, threads: int = 4) -> BuildResult:
    """Build the models, gold as tables ``<schema>.<model>`` (default schema: the marts
    layer; its database lies below ``sink`` or in the session's warehouse), run tests
    after each model and skip dependants of failed models. Up to ``threads`` models
    run at once; Spark shares the cluster between their jobs."""
    tests = MODEL_TESTS if tests is None else tests
    layer = sinks.schema_name(schema, "marts")
    sinks.create_layers(spark, (layer,), sink)
    built_at = built_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    builders = model_builders(bronze, as_of, built_at, text_options)
    built: dict[str, DataFrame] = {}
    status: dict[str, str] = {}
    results: dict[str, list[tuple]] = {}

    def one(name: str) -> tuple[DataFrame, list[tuple], bool]:
        df = builders[name](built)
        if name == "stg_earnings_transcripts":
            df = materialize(df, name)   # the text job runs once per build
        if name in GOLD:
            df = sinks.replace_table(df, f"{layer}.{name}", fmt)
        specs = tests.get(name, [])
        rows = Q.run_tests({**built, name: df}, {name: specs}).collect() if specs else []   # one small row per test
        sev = {(t.kind, t.column): t.severity for t in specs}
        found = [(r["model"], r["test"], r["column"], r["failures"], sev[(r["test"], r["column"])]) for r in rows]
        return df, found, any(f[3] > 0 and f[4] == "error" for f in found)

    with ThreadPoolExecutor(threads) as pool:
        running: dict = {}
        while len(status) < len(DEPENDS_ON):
            for name, ups in DEPENDS_ON.items():
                # tests may read a parent that is no upstream of the model itself
                needs = {*ups, *(t.to for t in tests.get(name, []) if t.to)} - {name}
                if name in status or name in running.values() or any(u not in status for u in needs):
                    continue
                if any(status[u] != "success" for u in ups):
                    status[name] = "skipped"
                else:
                    running[pool.submit(one, name)] = name
            if not running:
                continue
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                built[name], results[name], failed = done.result()
                status[name] = "failed_tests" if failed else "success"
    register_views(built)
    in_order = [n for n in DEPENDS_ON if n in results]
    return BuildResult(built, {n: status[n] for n in DEPENDS_ON}, [r for n in in_order for r in results[n]])


def build_report(spark: SparkSession, result: BuildResult) -> DataFrame:
    """``DataFrame[model, status, tests_run, tests_failed]`` of a build."""
    counts: dict[str, list[int]] = {}
    for model, _test, _col, failures, _sev in result.tests:
        c = counts.setdefault(model, [0, 0])
        c[0] += 1
        c[1] += int(failures > 0)
    rows = [(m, s, *counts.get(m, [0, 0])) for m, s in result.status.items()]
    return spark.createDataFrame(rows, "model string, status string, tests_run int, tests_failed int")
