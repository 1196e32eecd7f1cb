"""Registered queries of stores that live on: landed feeds, keyed stream state, vector
cells, roll-up levels, metric states, tags and views in the catalog.

Imported by ``registry``, which holds the silver and gold queries.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import oracle as O
from .operators import governance, quality, search, sentence_graph, slice_metrics, tag_lineage
from .operators.vector_cells import VectorCells
from .plans import build, semantic
from .plans.lattice import Lattice
from .registry import COMMON_OUTLOOK, Silver, _NEIGHBOURS_SQL, _q, register
from .session import drop_databases, materialize, scratch_folder
from .sources import adapter, layout, schemas
from .streaming import feed, keyed_state

# ------------------------------------------------------------- change feeds

_CUSTOMERS_LIVE = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST,
                                _ingested_at DESC NULLS LAST) AS rn FROM b_customers)
WHERE rn = 1 AND coalesce(_deleted, FALSE) = FALSE"""


@register("cdc_keyed_state", _q(_CUSTOMERS_LIVE))
def q_cdc_keyed_state(spark, sf_dir):
    """The customer feed through the stream's state store: later updates first, then the
    initial load with the updates once more, by one stream that is started twice."""
    root = scratch_folder(spark, "cdc_keyed_state")
    changes = adapter.customers(spark, sf_dir)
    late = F.col("updated_at") >= F.lit("2024-02-01").cast("timestamp_ntz")
    for part in (changes.filter(late), changes):
        part.write.mode("append").parquet(f"{root}/landing")
        keyed_state.apply_stream(spark, f"{root}/landing", schemas.CUSTOMERS, ["customer_id"], ["updated_at", "_ingested_at"],
                                 f"{root}/changes", f"{root}/checkpoint")
    return keyed_state.live_table(spark, f"{root}/changes", ["customer_id"]).select(*schemas.CUSTOMERS.fieldNames())


# The sources that the connector includes, and their landing tables.
FEED_SOURCES = {"transactions": "core_banking.transactions", "customers": "customer_crm.customers",
                "instrument_prices": "market_ref.instrument_prices", "trades": "trading.trades", "risk_metrics": "trading.risk_metrics"}
FEED_INCLUDE = "(" + "|".join(s.replace(".", r"\.") for s in FEED_SOURCES.values()) + ")"


def _row_text(columns, cast: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS {cast}), '-')" for c in columns)


_FEED_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS landed, CASE WHEN coalesce(_deleted, FALSE) THEN 'd' ELSE 'c' END AS operation, "
    f"md5({_row_text(schemas.BRONZE[t].fieldNames(), 'VARCHAR')}) AS digest FROM b_{t}" for t in FEED_SOURCES)


@register("bronze_from_feed", _q(_FEED_SQL))
def q_bronze_from_feed(spark, sf_dir):
    """All five bronze tables from one log of changes, a source outside the include list among
    them; a digest of every landed row."""
    root = scratch_folder(spark, "bronze_from_feed")
    bronze = adapter.bronze(spark, sf_dir)
    bronze["audit"] = bronze["risk_metrics"].limit(5)              # a source that is not included
    for i, t in enumerate([*FEED_SOURCES, "audit"]):
        feed.append_log(feed.to_feed(bronze[t], FEED_SOURCES.get(t, f"internal.{t}"), f"monotonically_increasing_id() * 8 + {i}"), f"{root}/log")
    feed.land_feed(spark, f"{root}/log", f"{root}/raw", f"{root}/checkpoint", FEED_INCLUDE, schemas.BRONZE)
    parts = [feed.read_table(spark, f"{root}/raw", t).select(F.lit(t).alias("landed"), F.col("_operation").alias("operation"),
                                                            F.md5(F.expr(_row_text(schemas.BRONZE[t].fieldNames(), "STRING"))).alias("digest"))
             for t in FEED_SOURCES]
    return functools.reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ vectors

def _cells(spark, sf_dir):
    emb = adapter.read_table(spark, sf_dir, "embeddings")
    queries = emb.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return emb, queries, VectorCells.build(emb, scratch_folder(spark, "vector_cells"), k=5)


@register("cosine_cells")
def q_cosine_cells(spark, sf_dir):
    """The 5 nearest vectors in the nearest cells of every vector whose id is divisible by 50.
    Approximate: no SQL; its recall is ``cosine_cells_recall``."""
    _, queries, cells = _cells(spark, sf_dir)
    return cells.search(queries, 5)


@register("cosine_cells_recall", f"""SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours, TRUE AS recall_reaches_90
FROM ({_NEIGHBOURS_SQL})""")
def q_cosine_cells_recall(spark, sf_dir):
    """The cells' recall against the exact neighbours, ties counted as found."""
    emb, queries, cells = _cells(spark, sf_dir)
    exact = search.cosine_topk(emb, queries, 5)
    reached = cells.recall(emb, queries, 5) >= 0.9
    return exact.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"), F.lit(reached).alias("recall_reaches_90"))


# ------------------------------------------------------------ roll-up levels

_LEVELS = ([], ["investor_segment"], ["risk_rating", "country"], ["investor_segment", "kyc_status"],
           ["investor_segment", "risk_rating", "kyc_status", "country"])
_LEVEL_DIMS = ["investor_segment", "risk_rating", "kyc_status", "country"]
_LEVEL_SQL = "\nUNION ALL ".join(
    f"""SELECT '{",".join(d)}' AS level, {", ".join(c if c in d else f"NULL AS {c}" for c in _LEVEL_DIMS)}, count(investor_id) AS investor_count,
       sum(assets_under_management) AS total_aum, round(avg(CAST(assets_under_management AS DOUBLE)), 6) AS avg_aum,
       sum(total_subscriptions) - sum(total_redemptions) AS total_net_flows
FROM investor_360 {"GROUP BY " + ", ".join(d) if d else ""}""" for d in _LEVELS)


@register("rollup_lattice", _q(_LEVEL_SQL))
def q_rollup_lattice(spark, sf_dir):
    """Investor metrics at five dimension sets, answered from stored states of one pass."""
    metrics = ["investor_count", "total_aum", "avg_aum", "total_net_flows"]
    view = semantic.investors_view(Silver(spark, sf_dir).investor_360)
    lattice = Lattice.build(view, scratch_folder(spark, "rollup_lattice"), _LEVEL_DIMS, metrics,
                            levels=[["investor_segment", "kyc_status"], ["risk_rating", "country"], []])
    parts = []
    for dims in _LEVELS:
        found = lattice.query(dims, metrics).withColumn("avg_aum", F.round(F.col("avg_aum").cast("double"), 6))
        parts.append(found.select(F.lit(",".join(dims)).alias("level"), *(F.col(c) if c in dims else F.lit(None).cast("string").alias(c) for c in _LEVEL_DIMS), *metrics))
    return functools.reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------ metric states

_SLICE_METRICS = [quality.row_count(), quality.null_count("email", "null_email"), quality.duplicate_count("investor_id", "dup_investor_id"),
                  quality.count_where("negative_aum", "assets_under_management < 0", "assets_under_management")]
_SLICED = "SELECT investor_id, email, assets_under_management, investor_id % 8 AS part FROM investor_360"
_SLICE_VALUES = """SELECT {at} AS measured_at, 'investor_360' AS "table", u.metric, u."column", u.value FROM (
  SELECT count(*) AS n, count(*) FILTER (email IS NULL) AS e, count(*) FILTER (assets_under_management < 0) AS a,
         count(*) - count(DISTINCT investor_id) - max(CASE WHEN investor_id IS NULL THEN 1 ELSE 0 END) AS d FROM ({rows})) m,
  LATERAL (VALUES ('row_count', NULL, n), ('null_email', 'email', e), ('dup_investor_id', 'investor_id', d),
                  ('negative_aum', 'assets_under_management', a)) AS u(metric, "column", value)"""
_DELIVERED = f"""SELECT * FROM ({_SLICED}) WHERE part <> 3
  UNION ALL SELECT investor_id - CASE WHEN investor_id % 16 = 3 THEN 3 ELSE 0 END, NULL, assets_under_management, part FROM ({_SLICED}) WHERE part = 3"""


@register("dq_metric_slices", _q(
    _SLICE_VALUES.format(at="TIMESTAMP '2026-01-01 00:00:00'", rows=_SLICED) + "\nUNION ALL "
    + _SLICE_VALUES.format(at="TIMESTAMP '2026-01-01 01:00:00'", rows=_DELIVERED)))
def q_dq_metric_slices(spark, sf_dir):
    """Two metric runs over investor_360 in eight slices; before the second one slice is
    delivered again with other rows (ids that other slices have, no addresses)."""
    root = scratch_folder(spark, "dq_metric_slices")
    rows = materialize(Silver(spark, sf_dir).investor_360().select("investor_id", "email", "assets_under_management", (F.col("investor_id") % 8).alias("part")),
                       "investor_slices")
    rows.repartition("part").write.partitionBy("part").parquet(f"{root}/table")

    def run(hour: int) -> list[str]:
        return slice_metrics.measure(spark, f"{root}/table", "part", _SLICE_METRICS, "investor_360", f"{root}/metrics", dt.datetime(2026, 1, 1, hour))[1]

    run(0)
    third = rows.filter("part = 3").select((F.col("investor_id") - F.when(F.col("investor_id") % 16 == 3, 3).otherwise(0)).alias("investor_id"),
                                           F.lit(None).cast("string").alias("email"), "assets_under_management")
    third.write.mode("overwrite").parquet(f"{root}/table/part=3")
    if run(1) not in ([], ["3"]):
        raise RuntimeError("slices were measured that did not change")
    return spark.read.parquet(f"{root}/metrics/history").select("measured_at", "table", "metric", "column", "value")


# ------------------------------------------------------- tags and the catalog

def _derived(spark, sf_dir):
    s = Silver(spark, sf_dir)
    tagged = governance.tag_pii(s.investor_360().select("investor_id", "first_name", "last_name", "email", "country", "cash_balance"),
                                governance.INVESTOR_TAGS, governance.INVESTOR_PII)
    risk = s.investor_risk().select("investor_id", "var_95")
    return tagged.join(risk, "investor_id", "left").select(
        "investor_id", F.concat_ws(" ", "first_name", "last_name").alias("full_name"), F.upper("email").alias("address"),
        F.substring_index("email", "@", -1).alias("domain"), F.lower("country").alias("land"), "cash_balance", "var_95")


def _published(spark, sf_dir, role):
    name = f"tags_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_folder(spark, name)}'")
    drop_databases(spark, name)
    tag_lineage.publish(_derived(spark, sf_dir), f"{name}.investor_contacts", roles=(role,))
    return spark, name


_DERIVED_SQL = """SELECT i.investor_id, {full_name} AS full_name, {address} AS address, {domain} AS domain, lower(i.country) AS land, i.cash_balance, r.var_95
FROM investor_360 i LEFT JOIN investor_risk r ON r.investor_id = i.investor_id"""


@register("masked_derived_analyst", _q(_DERIVED_SQL.format(
    full_name="'****MASKED****'", address="regexp_replace(upper(i.email), '^[^@]+', '****')", domain="'****MASKED****'")))
def q_masked_derived_analyst(spark, sf_dir):
    """Columns made from tagged ones, stored with the tags they inherit and read through the analyst's view."""
    spark, name = _published(spark, sf_dir, "analyst")
    return spark.table(f"{name}.investor_contacts_for_analyst")


@register("masked_derived_admin", _q(_DERIVED_SQL.format(
    full_name="concat_ws(' ', i.first_name, i.last_name)", address="upper(i.email)", domain="split_part(i.email, '@', -1)")))
def q_masked_derived_admin(spark, sf_dir):
    """The same table through the admin's view."""
    spark, name = _published(spark, sf_dir, "admin")
    return spark.table(f"{name}.investor_contacts_for_admin")


@register("derived_column_tags", """SELECT * FROM (VALUES ('address', 'EMAIL', TRUE), ('domain', 'DERIVED', TRUE), ('full_name', 'DERIVED', TRUE), ('land', 'COUNTRY', FALSE))
AS t("column", category, pii) WHERE (SELECT count(*) FROM customer) > 0""")
def q_derived_column_tags(spark, sf_dir):
    """The tags that the stored table keeps for its derived columns."""
    spark, name = _published(spark, sf_dir, "analyst")
    found = [(f.name, f.metadata.get(governance.SEMANTIC_TAG), f.metadata.get(governance.PII_TAG) == "Y")
             for f in spark.table(f"{name}.investor_contacts").schema.fields if f.metadata]
    return spark.createDataFrame(found, "column string, category string, pii boolean")


# --------------------------------------------------- comments and silver views

def _members(view: semantic.SemanticView) -> list[tuple]:
    return [(kind, m.name, m.expr, m.comment) for kind, members in (("fact", view.facts), ("dimension", view.dimensions)) for m in members]


def _comments_sql() -> str:
    quoted = lambda s: "NULL" if s is None else "'" + s.replace("'", "''") + "'"
    parts = [f"SELECT 'investor_360_sv' AS view, '{kind}' AS kind, '{name}' AS member, {quoted(comment)} AS comment, count({expr}) AS filled FROM investor_360"
             for kind, name, expr, comment in _members(semantic.investors_view(None))]
    return "\nUNION ALL ".join(parts)


@register("semantic_comments", _q(_comments_sql()))
def q_semantic_comments(spark, sf_dir):
    """Every fact and dimension of the investors' view with its comment, as the rows' schema
    carries it, and how many rows have a value."""
    view = semantic.investors_view(Silver(spark, sf_dir).investor_360)
    name = view.create_view(f"investors_{uuid.uuid4().hex}")
    rows = spark.table(name)
    comments = {f.name: (f.metadata or {}).get("comment") for f in rows.schema.fields}
    own = _members(view)
    counts = rows.agg(*(F.count(m).alias(m) for _, m, _, _ in own))
    spark.catalog.dropTempView(name)
    lines = F.array(*(F.struct(F.lit(view.name).alias("view"), F.lit(kind).alias("kind"), F.lit(m).alias("member"),
                               F.lit(comments[m]).cast("string").alias("comment"), F.col(m).alias("filled")) for kind, m, _, _ in own))
    return counts.select(F.explode(lines).alias("r")).select("r.*")


@register("silver_views", _q("\nUNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS n FROM {m}" for m in build.SILVER)))
def q_silver_views(spark, sf_dir):
    """The silver models registered as views and counted through their names."""
    prefix = f"silver_{uuid.uuid4().hex}_"
    build.register_views(build.lazy_models(adapter.bronze(spark, sf_dir), as_of=O.AS_OF), prefix=prefix)
    counts = [spark.sql(f"SELECT '{m}' AS model, count(*) AS n FROM {prefix}{m}") for m in build.SILVER]
    for m in build.SILVER:
        spark.catalog.dropTempView(f"{prefix}{m}")
    return functools.reduce(DataFrame.unionByName, counts)


# ------------------------------------------------------------ sentence graph

def _graph_sql(terms) -> str:
    rounds = []
    for n in range(sentence_graph.ROUNDS):
        rounds.append(f"""x{n} AS (SELECT s.path, s.i, s.w, CASE WHEN s.total > 0 THEN {sentence_graph.UNIT} * r.rank // s.total ELSE 0 END AS x
        FROM size s JOIN r{n} r ON r.path = s.path AND r.i = s.i),
y{n} AS (SELECT k.path, k.t, sum(x.x)::BIGINT AS y FROM k JOIN x{n} x ON x.path = k.path AND x.i = k.i GROUP BY k.path, k.t),
g{n} AS (SELECT k.path, k.i, sum(y.y)::BIGINT AS got FROM k JOIN y{n} y ON y.path = k.path AND y.t = k.t GROUP BY k.path, k.i),
r{n + 1} AS (SELECT x.path, x.i, {15 * sentence_graph.UNIT // 100} + 85 * (g.got - x.w * x.x) // {100 * sentence_graph.UNIT} AS rank
         FROM x{n} x JOIN g{n} g ON g.path = x.path AND g.i = x.i)""")
    words = ", ".join(f"'{t}'" for t in terms)
    return f"""
, sent AS (SELECT path, file_name, i, l[i] AS s FROM (SELECT path, file_name, l, unnest(range(1, len(l) + 1)) AS i
           FROM (SELECT path, file_name, regexp_extract_all(parsed_text, '{O.SENTENCE_RE}') AS l FROM transcripts_raw)))
, k AS (SELECT DISTINCT path, i, unnest(regexp_extract_all(lower(s), '{O.TOKEN_RE}')) AS t FROM sent)
, h AS (SELECT path, t, count(*) AS n FROM k GROUP BY path, t)
, size AS (SELECT k.path, k.i, count(*) AS w, sum(h.n - 1)::BIGINT AS total FROM k JOIN h ON h.path = k.path AND h.t = k.t GROUP BY k.path, k.i)
, r0 AS (SELECT path, i, {sentence_graph.UNIT}::BIGINT AS rank FROM size)
, {(chr(10) + ", ").join(rounds)}
, best AS (SELECT r.path, r.i, r.rank, row_number() OVER (PARTITION BY r.path ORDER BY r.rank DESC, r.i) AS n
           FROM r{sentence_graph.ROUNDS} r WHERE EXISTS (SELECT 1 FROM k WHERE k.path = r.path AND k.i = r.i AND k.t IN ({words})))
SELECT s.file_name, b.rank AS summary_rank, regexp_replace(regexp_replace(s.s, '[ \t\n\r\f]+', ' ', 'g'), '^ +| +$', '', 'g') AS summary
FROM best b JOIN sent s ON s.path = b.path AND s.i = b.i WHERE b.n = 1"""


@register("outlook_sentence_graph", O.with_ctes_and(_graph_sql(COMMON_OUTLOOK)))
def q_outlook_sentence_graph(spark, sf_dir):
    """The most central sentence with an outlook word (common words, so that most texts have one)."""
    raw = Silver(spark, sf_dir).transcripts_raw()
    found = sentence_graph.central_sentences(raw.select("path", "file_name", "parsed_text"), terms=COMMON_OUTLOOK)
    return found.filter("summary IS NOT NULL").select("file_name", "summary_rank", "summary")


# -------------------------------------------------------------- layout blocks

def _layout_sql() -> str:
    dropped = "html"
    for pattern in layout.DROPPED:
        dropped = f"regexp_replace({dropped}, '{pattern}', ' ', 'g')"
    text = "coalesce(string_agg(tok, ' ' ORDER BY pos) FILTER (tok NOT LIKE '<%' OR length(tok) = 1), '')"
    for entity, ch in layout.ENTITIES:
        text = f"replace({text}, '{entity}', {'chr(39)' if ch == chr(39) else chr(39) + ch + chr(39)})"
    tags = ", ".join(f"'{t}'" for t in layout.BLOCK_TAGS)
    kinds = " ".join(f"WHEN tag = '{t}' THEN '{k}'" for t, k in layout.KINDS.items())
    newest = ", ".join(f"max(CASE WHEN level = {n} THEN no END) OVER before AS at{n}, "
                       f"last_value(CASE WHEN level = {n} THEN text END IGNORE NULLS) OVER before AS name{n}" for n in range(1, 7))
    above = ", ".join("CASE WHEN " + " AND ".join([f"at{n} IS NOT NULL", f"(level IS NULL OR level > {n})",
                                                   *(f"coalesce(at{o} < at{n}, TRUE)" for o in range(1, n))]) + f" THEN name{n} END" for n in range(1, 7))
    cells = ", ".join(f"CASE WHEN kind = 'cell' THEN {c} END AS {c}" for c in ("table_no", "row_no", "cell_no"))
    return f"""
WITH t AS (SELECT page_id, l[i] AS tok, i AS pos FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i
           FROM (SELECT page_id, regexp_extract_all({dropped}, '{layout.TOKEN}') AS l FROM pages))),
g AS (SELECT *, lower(regexp_extract(tok, '{layout.TAG}', 1)) AS tag FROM t),
c AS (SELECT *, ltrim(tag, '/') IN ({tags}) AS cut FROM g),
n AS (SELECT *, sum(cut::INT) OVER (PARTITION BY page_id ORDER BY pos) AS no, sum((tag = 'table')::INT) OVER (PARTITION BY page_id ORDER BY pos) AS table_no FROM c),
m AS (SELECT *, sum((tag = 'tr')::INT) OVER (PARTITION BY page_id, table_no ORDER BY pos) AS row_no FROM n),
o AS (SELECT *, sum((tag IN ('td', 'th'))::INT) OVER (PARTITION BY page_id, table_no, row_no ORDER BY pos) AS cell_no FROM m),
b AS (SELECT page_id, no, max(CASE WHEN cut THEN tag END) AS tag, max(table_no)::BIGINT AS table_no, max(row_no)::BIGINT AS row_no, max(cell_no)::BIGINT AS cell_no,
             regexp_replace(regexp_replace({text}, '[ \t\n\r\f]+', ' ', 'g'), '^ +| +$', '', 'g') AS text FROM o GROUP BY page_id, no),
k AS (SELECT *, CASE {kinds} WHEN regexp_matches(tag, '^h[1-6]$') THEN 'heading' ELSE 'paragraph' END AS kind,
             CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN CAST(substr(tag, 2, 1) AS INTEGER) END AS level FROM b WHERE text <> ''),
a AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY no) - 1 AS block, {newest} FROM k
      WINDOW before AS (PARTITION BY page_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT page_id, block, kind, level, concat_ws(' > ', {above}) AS path, {cells}, text FROM a"""


@register("layout_blocks", _layout_sql())
def q_layout_blocks(spark, sf_dir):
    """Every page as ordered blocks with their kind and the headings above them."""
    return layout.blocks(adapter.read_table(spark, sf_dir, "pages"))
