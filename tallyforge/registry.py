"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their SQL oracles.

Every query reads the driver tables of ``sf_dir`` (through the bronze adapter)
and runs over the whole tables; nothing is sampled or capped except where a
limit is the feature (top-k search).
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import oracle as O
from .operators import cdc, governance, quality, reports, search, signals
from .operators.tiered_index import SearchIndex
from .plans import build, marts, semantic, staging
from .session import drop_databases, hadoop_path, materialize, scratch_folder
from .sources import adapter, documents, sinks

AS_OF = O.AS_OF

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# ------------------------------------------------------------ silver inputs

def _once(fn):
    """Build a relation once per Silver instance (one query) and reuse it."""
    def wrapper(self, *args, **kwargs):
        key = (fn.__name__, args, tuple(sorted(kwargs.items())))
        if key not in self._memo:
            self._memo[key] = fn(self, *args, **kwargs)
        return self._memo[key]
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


class Silver:
    """Silver and gold relations for one driver directory, each built once."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._memo: dict = {}

    @_once
    def customers(self):
        return staging.stg_customers(adapter.customers(self.spark, self.sf_dir), self.as_of)

    @_once
    def prices(self):
        return staging.stg_instrument_prices(adapter.instrument_prices(self.spark, self.sf_dir))

    @_once
    def transactions(self):
        return staging.stg_transactions(adapter.transactions(self.spark, self.sf_dir))

    @_once
    def trades(self):
        return staging.stg_trades(adapter.trades(self.spark, self.sf_dir))

    @_once
    def risk(self):
        return staging.stg_risk_metrics(adapter.risk_metrics(self.spark, self.sf_dir))

    @_once
    def transcripts_raw(self):
        """All staged documents; the landing's extension filter is a query of its own."""
        return documents.transcripts_raw(adapter.document_stage(self.spark, self.sf_dir), pattern="%")

    @_once
    def transcripts(self, stored: bool = False):
        """Enriched transcripts. Lazy by default, so plans that never read the
        text signals let Catalyst prune the text job; ``stored=True`` computes
        them once and stores them, for plans with several consumers."""
        df = signals.stg_earnings_transcripts(self.transcripts_raw())
        return materialize(df, "stg_earnings_transcripts") if stored else df

    @_once
    def portfolio(self, with_earnings: bool = True):
        """portfolio_risk. The text signals are computed only for the newest
        transcript of each symbol. ``with_earnings=False`` leaves out the earnings
        columns: they come from a left join on a key that is unique on the
        right, so the rows (and every other column) are the same."""
        if not with_earnings:
            return marts.portfolio_risk(self.customers(), self.trades(), self.prices(), None)
        return marts.portfolio_risk(self.customers(), self.trades(), self.prices(), self.transcripts_raw(),
                                    enrich=signals.stg_earnings_transcripts)

    @_once
    def investor_360(self):
        return marts.investor_360(self.customers(), self.transactions(), self.prices())

    def models(self):
        """All nine models (gold without _built_at); the enriched transcripts and
        portfolio_risk, which have several consumers, are computed once."""
        b = adapter.bronze(self.spark, self.sf_dir)
        return build.lazy_models(b, as_of=self.as_of, materialize_as=materialize)

    @_once
    def investor_risk(self):
        # the roll-up reads gross_exposure per position only
        return marts.investor_risk(self.customers(), self.risk(), self.portfolio(False))


def _q(body: str, *groups) -> str:
    return O.with_ctes(body, *groups)


# ------------------------------------------------------------------ silver

@register("stg_customers", _q("SELECT * FROM stg_customers"))
def q_stg_customers(spark, sf_dir):
    return Silver(spark, sf_dir).customers()


@register("stg_instrument_prices", _q("SELECT * FROM stg_instrument_prices"))
def q_stg_instrument_prices(spark, sf_dir):
    return Silver(spark, sf_dir).prices()


@register("stg_transactions", _q("SELECT * FROM stg_transactions"))
def q_stg_transactions(spark, sf_dir):
    return Silver(spark, sf_dir).transactions()


@register("stg_trades", _q("SELECT * FROM stg_trades"))
def q_stg_trades(spark, sf_dir):
    return Silver(spark, sf_dir).trades()


@register("stg_risk_metrics", _q("SELECT * FROM stg_risk_metrics"))
def q_stg_risk_metrics(spark, sf_dir):
    return Silver(spark, sf_dir).risk()


# ------------------------------------------------------------ cash book

@register("cash_flows", _q("SELECT * FROM cash_flows"))
def q_cash_flows(spark, sf_dir):
    return marts.cash_flows(Silver(spark, sf_dir).transactions())


@register("latest_balance", _q("SELECT * FROM latest_balance"))
def q_latest_balance(spark, sf_dir):
    return marts.latest_balance(Silver(spark, sf_dir).transactions())


@register("cash_positions", _q("SELECT * FROM cash_positions"))
def q_cash_positions(spark, sf_dir):
    return marts.cash_positions(Silver(spark, sf_dir).transactions())


@register("holdings", _q("SELECT * FROM holdings"))
def q_holdings(spark, sf_dir):
    s = Silver(spark, sf_dir)
    return marts.holdings(marts.cash_positions(s.transactions()), s.prices())


@register("investor_360", _q("SELECT * FROM investor_360"))
def q_investor_360(spark, sf_dir):
    s = Silver(spark, sf_dir)
    return marts.investor_360(s.customers(), s.transactions(), s.prices())


@register("trade_positions", _q("SELECT * FROM trade_positions"))
def q_trade_positions(spark, sf_dir):
    return marts.trade_positions(Silver(spark, sf_dir).trades())


# ------------------------------------------------------------ transcripts

@register("transcripts_keys", _q("""SELECT file_name, symbol, fiscal_period, loaded_at
FROM transcripts_raw WHERE file_name ILIKE '%.pdf'"""))
def q_transcripts_keys(spark, sf_dir):
    """The landing: files matched by extension, any case."""
    return documents.transcripts_raw(adapter.document_stage(spark, sf_dir)).select("file_name", "symbol", "fiscal_period", "loaded_at")


@register("sentiment_labels", _q("""SELECT r.file_name, s.* EXCLUDE (path)
FROM t_sentiment s JOIN transcripts_raw r ON r.path = s.path"""))
def q_sentiment_labels(spark, sf_dir):
    raw = Silver(spark, sf_dir).transcripts_raw()
    return signals.with_sentiment(raw, keep_counts=True).select(
        "file_name", "positive_hits", "negative_hits", "sentiment")


@register("outlook_sentence", _q("""SELECT r.file_name, m.summary
FROM t_summary m JOIN transcripts_raw r ON r.path = m.path"""))
def q_outlook_sentence(spark, sf_dir):
    raw = Silver(spark, sf_dir).transcripts_raw()
    return raw.select("file_name", signals.outlook_sentence("parsed_text").alias("summary")) \
              .filter("summary IS NOT NULL")


@register("stg_earnings_transcripts", _q("SELECT * EXCLUDE (path) FROM stg_earnings_transcripts"))
def q_stg_earnings_transcripts(spark, sf_dir):
    return Silver(spark, sf_dir).transcripts().drop("path")


@register("latest_earnings", _q("SELECT * FROM latest_earnings"))
def q_latest_earnings(spark, sf_dir):
    return marts.latest_earnings(Silver(spark, sf_dir).transcripts_raw(), enrich=signals.stg_earnings_transcripts)


# ------------------------------------------------------------ trading book

@register("portfolio_risk", _q("SELECT * FROM portfolio_risk"))
def q_portfolio_risk(spark, sf_dir):
    return Silver(spark, sf_dir).portfolio()


@register("investor_risk", _q("SELECT * FROM investor_risk"))
def q_investor_risk(spark, sf_dir):
    return Silver(spark, sf_dir).investor_risk()


# ------------------------------------------------------------ semantic layer

_INV_METRICS = ["investor_count", "total_aum", "avg_aum", "total_holdings_value", "total_cash", "total_net_flows"]
_INV_METRICS_SQL = """count(investor_id) AS investor_count, sum(assets_under_management) AS total_aum,
       round(avg(CAST(assets_under_management AS DOUBLE)), 6) AS avg_aum,
       sum(holdings_value) AS total_holdings_value, sum(cash_balance) AS total_cash,
       sum(total_subscriptions) - sum(total_redemptions) AS total_net_flows"""


def _avg_as_double(df):
    return df.withColumn("avg_aum", F.round(F.col("avg_aum").cast("double"), 6)) if "avg_aum" in df.columns else df


@register("aum_by_segment", _q("""SELECT investor_segment, count(investor_id) AS investor_count,
       sum(assets_under_management) AS total_aum
FROM investor_360 GROUP BY investor_segment ORDER BY total_aum DESC"""))
def q_aum_by_segment(spark, sf_dir):
    v = semantic.investors_view(Silver(spark, sf_dir).investor_360)
    return v.query(["investors.investor_segment"], ["investors.investor_count", "investors.total_aum"],
                   order=[F.col("total_aum").desc()])


@register("investor_metrics_by_segment_risk", _q(f"""SELECT investor_segment, risk_rating, {_INV_METRICS_SQL}
FROM investor_360 GROUP BY investor_segment, risk_rating"""))
def q_investor_metrics_by_segment_risk(spark, sf_dir):
    v = semantic.investors_view(Silver(spark, sf_dir).investor_360)
    return _avg_as_double(v.query(["client segment", "risk level"], _INV_METRICS))


@register("investor_metrics_total", _q(f"SELECT {_INV_METRICS_SQL} FROM investor_360"))
def q_investor_metrics_total(spark, sf_dir):
    v = semantic.investors_view(Silver(spark, sf_dir).investor_360)
    return _avg_as_double(v.query([], _INV_METRICS))


@register("exposure_by_asset_class", _q("""SELECT asset_class, count(investor_id) AS position_count,
       sum(market_value) AS total_market_value, sum(gross_exposure) AS total_gross_exposure,
       sum(unrealized_pnl) AS total_unrealized_pnl, CAST(sum(trade_count) AS BIGINT) AS total_trades
FROM portfolio_risk GROUP BY asset_class"""))
def q_exposure_by_asset_class(spark, sf_dir):
    v = semantic.positions_view(functools.partial(Silver(spark, sf_dir).portfolio, False))
    return v.query(["asset type"], ["position_count", "total_market_value", "total exposure",
                                    "total_unrealized_pnl", "total_trades"])


@register("pnl_by_sentiment", _q("""SELECT earnings_sentiment, count(investor_id) AS position_count,
       sum(gross_exposure) AS total_gross_exposure, sum(unrealized_pnl) AS total_unrealized_pnl
FROM portfolio_risk GROUP BY earnings_sentiment ORDER BY total_unrealized_pnl DESC"""))
def q_pnl_by_sentiment(spark, sf_dir):
    v = semantic.positions_view(Silver(spark, sf_dir).portfolio)
    return v.query(["positions.earnings_sentiment"],
                   ["positions.position_count", "positions.total_gross_exposure", "positions.total_unrealized_pnl"],
                   order=[F.col("total_unrealized_pnl").desc()])


@register("risk_breaches", _q("""SELECT investor_id, investor_segment, var_95, risk_limit, portfolio_gross_exposure
FROM investor_risk WHERE limit_breach_flag"""))
def q_risk_breaches(spark, sf_dir):
    r = Silver(spark, sf_dir).investor_risk()
    return r.filter(F.col("limit_breach_flag")).select(
        "investor_id", "investor_segment", "var_95", "risk_limit", "portfolio_gross_exposure")


# ------------------------------------------------------- tests and metrics

def _dq_tests_sql(specs) -> str:
    parts = []
    for model, tests in specs.items():
        for t in tests:
            c = t.column
            if t.kind == "not_null":
                q = f"SELECT count(*) FROM {model} WHERE {c} IS NULL"
            elif t.kind == "unique":
                q = (f"SELECT count(*) FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} HAVING count(*) > 1)")
            elif t.kind == "accepted_values":
                vals = ", ".join(f"'{v}'" for v in t.values)
                q = (f"SELECT count(*) FROM (SELECT {c} FROM {model} WHERE {t.where or 'TRUE'} GROUP BY {c}) "
                     f"WHERE {c} NOT IN ({vals})")
            else:
                q = (f"SELECT count(*) FROM {model} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {t.to} p WHERE p.{t.field} = ch.{c})")
            parts.append(f"SELECT '{model}' AS model, '{t.kind}' AS test, '{c}' AS \"column\", ({q}) AS failures")
    return "\nUNION ALL ".join(parts)


@register("dq_tests", _q(_dq_tests_sql(build.MODEL_TESTS)))
def q_dq_tests(spark, sf_dir):
    return quality.run_tests(Silver(spark, sf_dir).models(), build.MODEL_TESTS)


DQ_METRICS = {
    "investor_360": [
        quality.count_where("negative_aum", "assets_under_management < 0", "assets_under_management"),
        quality.duplicate_count("investor_id", "dup_investor_id"),
        quality.null_count("email", "null_email"),
    ],
    "portfolio_risk": [quality.row_count(), quality.null_count("symbol", "null_symbol")],
}


@register("dq_metrics", _q("""
SELECT 'investor_360' AS "table", 'negative_aum' AS metric, 'assets_under_management' AS "column",
       (SELECT count(*) FROM investor_360 WHERE assets_under_management < 0) AS value
UNION ALL SELECT 'investor_360', 'dup_investor_id', 'investor_id',
       (SELECT count(*) - count(DISTINCT investor_id) - max(CASE WHEN investor_id IS NULL THEN 1 ELSE 0 END) FROM investor_360)
UNION ALL SELECT 'investor_360', 'null_email', 'email', (SELECT count(*) FROM investor_360 WHERE email IS NULL)
UNION ALL SELECT 'portfolio_risk', 'row_count', NULL, (SELECT count(*) FROM portfolio_risk)
UNION ALL SELECT 'portfolio_risk', 'null_symbol', 'symbol', (SELECT count(*) FROM portfolio_risk WHERE symbol IS NULL)"""))
def q_dq_metrics(spark, sf_dir):
    s = Silver(spark, sf_dir)
    m = {"investor_360": s.investor_360(), "portfolio_risk": s.portfolio(False)}   # no metric reads an earnings column
    parts = [quality.metrics(m[t], specs, t) for t, specs in DQ_METRICS.items()]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------- governance

def _masked(spark, sf_dir, role):
    inv = Silver(spark, sf_dir).investor_360().select("investor_id", "first_name", "last_name", "email", "country")
    tagged = governance.tag_pii(inv, governance.INVESTOR_TAGS, governance.INVESTOR_PII)
    return governance.apply_masking(tagged, role)


@register("masked_investors_analyst", _q("""SELECT investor_id, '****MASKED****' AS first_name,
       '****MASKED****' AS last_name, regexp_replace(email, '^[^@]+', '****') AS email, country
FROM investor_360"""))
def q_masked_investors_analyst(spark, sf_dir):
    return _masked(spark, sf_dir, "analyst")


@register("masked_investors_admin", _q("SELECT investor_id, first_name, last_name, email, country FROM investor_360"))
def q_masked_investors_admin(spark, sf_dir):
    return _masked(spark, sf_dir, "admin")


def _classify_sql(table: str, cols, threshold: float = 0.8) -> str:
    codes = ", ".join(f"'{c}'" for c in governance.iso_country_codes())
    rules = {"EMAIL": ("IDENTIFIER", "regexp_matches({c}, '" + governance.EMAIL_PATTERN + "')"),
             "COUNTRY": ("QUASI_IDENTIFIER", "upper({c}) IN (" + codes + ")")}
    parts = []
    for c in cols:
        for cat, (priv, rule) in rules.items():
            r = rule.replace("{c}", c)
            parts.append(f"SELECT '{c}' AS \"column\", '{cat}' AS category, '{priv}' AS privacy, "
                         f"CASE WHEN count({c}) > 0 THEN round(CAST(count(*) FILTER (WHERE {r}) AS DOUBLE) / count({c}), 6) "
                         f"END AS hit_rate FROM {table}")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE hit_rate >= {threshold}"


_CUSTOMER_STRING_COLS = ["first_name", "last_name", "email", "segment", "kyc_status", "risk_rating", "country"]


@register("classify_customer_columns", _q(_classify_sql("b_customers", _CUSTOMER_STRING_COLS)))
def q_classify_customer_columns(spark, sf_dir):
    return governance.classify_columns(adapter.customers(spark, sf_dir), threshold=0.8)


# ---------------------------------------------------------------- reports

@register("row_counts", _q("""SELECT 'CUSTOMERS' AS t, count(*) AS n FROM b_customers
UNION ALL SELECT 'INSTRUMENT_PRICES', count(*) FROM b_instrument_prices
UNION ALL SELECT 'TRANSACTIONS', count(*) FROM b_transactions
UNION ALL SELECT 'TRADES', count(*) FROM b_trades
UNION ALL SELECT 'RISK_METRICS', count(*) FROM b_risk_metrics
UNION ALL SELECT 'EARNINGS_TRANSCRIPTS', count(*) FROM transcripts_raw WHERE file_name ILIKE '%.pdf'"""))
def q_row_counts(spark, sf_dir):
    b = adapter.bronze(spark, sf_dir)
    return reports.row_counts({
        "CUSTOMERS": b["customers"], "INSTRUMENT_PRICES": b["instrument_prices"],
        "TRANSACTIONS": b["transactions"], "TRADES": b["trades"], "RISK_METRICS": b["risk_metrics"],
        "EARNINGS_TRANSCRIPTS": documents.transcripts_raw(b["doc_stage"])})


@register("orphan_trades", _q("""SELECT t.* FROM stg_trades t
WHERE t.customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_customers c WHERE c.customer_id = t.customer_id)"""))
def q_orphan_trades(spark, sf_dir):
    s = Silver(spark, sf_dir)
    return reports.orphans(s.trades(), s.customers(), "customer_id")


@register("orphan_symbols", _q("""SELECT DISTINCT symbol FROM (
  SELECT symbol FROM stg_trades UNION ALL SELECT symbol FROM stg_transactions) x
WHERE symbol IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_instrument_prices p WHERE p.symbol = x.symbol)"""))
def q_orphan_symbols(spark, sf_dir):
    s = Silver(spark, sf_dir)
    used = s.trades().select("symbol").unionByName(s.transactions().select("symbol"))
    return reports.orphans(used, s.prices(), "symbol", distinct=True)


@register("transcript_preview", _q("""SELECT file_name, symbol, sentiment, left(parsed_text, 80) AS preview,
       left(summary, 90) AS outlook FROM stg_earnings_transcripts ORDER BY symbol"""))
def q_transcript_preview(spark, sf_dir):
    t = Silver(spark, sf_dir).transcripts()
    t = documents.preview(t, "parsed_text", 80, "preview")
    t = documents.preview(t, "summary", 90, "outlook")
    # the range sort samples its input before shuffling it: store the short
    # preview rows once (not the texts) so the text job runs once
    rows = materialize(t.select("file_name", "symbol", "sentiment", "preview", "outlook"), "transcript_preview")
    return rows.orderBy("symbol", "file_name")           # one symbol, or none, may hold a third of the rows


@register("html_text", _q(f"SELECT page_id, url, {O.html_text('html')} AS text FROM pages"))
def q_html_text(spark, sf_dir):
    pages = adapter.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", documents.html_to_text("html").alias("text"))


# ------------------------------------------------- text signals, common words

# Word lists made of frequent words of the driver corpus, so that
# the registered check exercises every label (the finance lists find nothing
# in invented prose). A mechanical check of the operator, not a sentiment model.
COMMON_POSITIVE = ("of", "to", "in", "de")
COMMON_NEGATIVE = ("and", "is", "was", "la")
COMMON_OUTLOOK = ("the", "of", "le", "der")


@register("sentiment_labels_common_words", _q("""SELECT r.file_name, s.* EXCLUDE (path)
FROM cw_sentiment s JOIN transcripts_raw r ON r.path = s.path""", O.text_ctes(
    positive=COMMON_POSITIVE, negative=COMMON_NEGATIVE, outlook=COMMON_OUTLOOK, prefix="cw")))
def q_sentiment_labels_common_words(spark, sf_dir):
    raw = Silver(spark, sf_dir).transcripts_raw()
    return signals.with_sentiment(raw, positive=COMMON_POSITIVE, negative=COMMON_NEGATIVE, keep_counts=True) \
                  .select("file_name", "positive_hits", "negative_hits", "sentiment")


@register("outlook_sentence_common_words", _q("""SELECT r.file_name, m.summary
FROM cw_summary m JOIN transcripts_raw r ON r.path = m.path""", O.text_ctes(
    positive=COMMON_POSITIVE, negative=COMMON_NEGATIVE, outlook=COMMON_OUTLOOK, prefix="cw")))
def q_outlook_sentence_common_words(spark, sf_dir):
    raw = Silver(spark, sf_dir).transcripts_raw()
    return raw.select("file_name", signals.outlook_sentence("parsed_text", COMMON_OUTLOOK).alias("summary")) \
              .filter("summary IS NOT NULL")


# -------------------------------------------------------- change-feed apply

@register("cdc_batch_apply", _q("""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST,
                                _ingested_at DESC NULLS LAST) AS rn FROM b_customers)
WHERE rn = 1 AND coalesce(_deleted, FALSE) = FALSE"""))
def q_cdc_batch_apply(spark, sf_dir):
    """Two change batches (initial load, then the later updates) folded into state."""
    changes = adapter.customers(spark, sf_dir)
    cut = F.lit("2024-02-01").cast("timestamp_ntz")
    state = cdc.apply_changes(None, changes.filter(F.col("updated_at") < cut), "customer_id",
                              ["updated_at", "_ingested_at"])
    state = cdc.apply_changes(state, changes.filter(F.col("updated_at") >= cut), "customer_id",
                              ["updated_at", "_ingested_at"])
    return cdc.live_view(state)


# ------------------------------------------------------------------ search

def _bm25_sql(k: int, keep: str = "TRUE", k1: float = 1.2, b: float = 0.75) -> str:
    tok = O.TOKEN_RE
    return f"""
, bm_docs AS (SELECT path AS doc_id, regexp_extract_all(lower(parsed_text), '{tok}') AS tok,
                     coalesce({keep}, FALSE) AS keep FROM stg_earnings_transcripts)
, bm_stats AS (SELECT count(*) AS n_docs, avg(len(tok)) AS avgdl FROM bm_docs)
, bm_q AS (SELECT DISTINCT query_id, term FROM (
             SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{tok}')) AS term FROM benchmark))
, bm_tok AS (SELECT doc_id, keep, len(tok) AS dl, unnest(tok) AS term FROM bm_docs)
, bm_hits AS (SELECT doc_id, term, count(*) AS tf, max(dl) AS dl, bool_or(keep) AS keep FROM bm_tok
              WHERE term IN (SELECT term FROM bm_q) GROUP BY doc_id, term)
, bm_df AS (SELECT term, count(*) AS df FROM bm_hits GROUP BY term)
, bm_scored AS (
    SELECT q.query_id, h.doc_id,
           round(sum(ln(1.0 + (s.n_docs - d.df + 0.5) / (d.df + 0.5)) * CAST(h.tf AS DOUBLE) * {k1 + 1}
                     / (CAST(h.tf AS DOUBLE) + {k1} * ({1 - b} + {b} * h.dl / s.avgdl))), 6) AS score
    FROM bm_hits h JOIN bm_df d ON d.term = h.term JOIN bm_q q ON q.term = h.term, bm_stats s
    WHERE h.keep GROUP BY q.query_id, h.doc_id)
SELECT t.query_id, t.rank, e.file_name, t.score, e.symbol, e.sentiment
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS rank FROM bm_scored) t
LEFT JOIN stg_earnings_transcripts e ON e.path = t.doc_id
WHERE t.rank <= {k}"""


def _bm25(spark, sf_dir, filters=None):
    """Rank the transcripts, then label only the ranked files with their
    sentiment (the label is per document, so ranking does not depend on it)."""
    raw = Silver(spark, sf_dir).transcripts_raw()
    queries = adapter.read_table(spark, sf_dir, "benchmark")
    top = search.bm25_topk(raw, queries, k=3, id_col="path", text_col="parsed_text",
                           qid_col="item_id", qtext_col="text", filters=filters, columns=("file_name", "symbol"))
    ranked = raw.join(top.select("path").distinct(), "path", "left_semi")   # <= queries x k files
    labels = signals.stg_earnings_transcripts(ranked).select("path", "sentiment")
    out = top.join(labels, "path", "left")
    return out.select("query_id", F.col("rank").cast("long").alias("rank"), "file_name", "score",
                      "symbol", "sentiment")


@register("bm25_topk", O.with_ctes_and(_bm25_sql(3)))
def q_bm25_topk(spark, sf_dir):
    return _bm25(spark, sf_dir)


BM25_FILTER = "fiscal_period >= '2025Q1'"


@register("bm25_topk_filtered", O.with_ctes_and(_bm25_sql(3, BM25_FILTER)))
def q_bm25_topk_filtered(spark, sf_dir):
    return _bm25(spark, sf_dir, BM25_FILTER)


_COSINE_SQL = """
WITH cs_e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
, cs_q AS (SELECT label AS query_id, pos, avg(CAST(x AS DOUBLE)) AS qx FROM cs_e GROUP BY label, pos)
, cs_qn AS (SELECT query_id, sqrt(sum(qx * qx)) AS qn FROM cs_q GROUP BY query_id)
, cs_vn AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS vn FROM cs_e GROUP BY vec_id)
, cs_dot AS (SELECT q.query_id, e.vec_id, sum(q.qx * CAST(e.x AS DOUBLE)) AS dot
             FROM cs_q q JOIN cs_e e ON e.pos = q.pos GROUP BY q.query_id, e.vec_id)
, cs_scored AS (SELECT d.query_id, d.vec_id, round(d.dot / (qn.qn * vn.vn), 6) AS score
                FROM cs_dot d JOIN cs_qn qn ON qn.query_id = d.query_id JOIN cs_vn vn ON vn.vec_id = d.vec_id
                WHERE qn.qn > 0 AND vn.vn > 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id ASC) AS rank FROM cs_scored)
WHERE rank <= 5"""


@register("cosine_topk", _COSINE_SQL)
def q_cosine_topk(spark, sf_dir):
    """The 5 vectors closest to each label's centroid (queries derived by Spark)."""
    emb = adapter.read_table(spark, sf_dir, "embeddings")
    queries = search.centroids(emb, "label", "embedding").withColumnRenamed("label", "query_id")
    out = search.cosine_topk(emb, queries, k=5, id_col="vec_id", vec_col="embedding")
    return out.withColumn("rank", F.col("rank").cast("long"))


@register("transcript_signals_common_words", _q("""SELECT r.file_name, s.sentiment, m.summary
FROM cw_sentiment s JOIN transcripts_raw r ON r.path = s.path LEFT JOIN cw_summary m ON m.path = s.path""", O.text_ctes(
    positive=COMMON_POSITIVE, negative=COMMON_NEGATIVE, outlook=COMMON_OUTLOOK, prefix="cw")))
def q_transcript_signals_common_words(spark, sf_dir):
    """Sentiment and outlook from one tokenisation (the enrichment path)."""
    raw = Silver(spark, sf_dir).transcripts_raw()
    return signals.with_signals(raw, positive=COMMON_POSITIVE, negative=COMMON_NEGATIVE,
                                outlook_terms=COMMON_OUTLOOK).select("file_name", "sentiment", "summary")


@register("cdc_stream_apply", _q("""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST,
                                _ingested_at DESC NULLS LAST) AS rn FROM b_customers)
WHERE rn = 1 AND coalesce(_deleted, FALSE) = FALSE"""))
def q_cdc_stream_apply(spark, sf_dir):
    """The customer change feed in two deliveries (later updates first, then the initial
    load), applied by two streams with checkpoints of their own; must equal the batch."""
    from .sources import schemas
    from .streaming import changefeed
    root = scratch_folder(spark, "cdc_stream_apply")
    changes = adapter.customers(spark, sf_dir)
    cut = F.lit("2024-02-01").cast("timestamp_ntz")
    keys, order = "customer_id", ["updated_at", "_ingested_at"]
    for part, rows in (("late", F.col("updated_at") >= cut), ("early", F.col("updated_at") < cut)):
        changes.filter(rows).write.parquet(f"{root}/landing/{part}")
        changefeed.stream_apply(spark, f"{root}/landing/{part}", schemas.CUSTOMERS, keys, order,
                                f"{root}/state", f"{root}/checkpoint-{part}", max_files_per_trigger=64)
    return changefeed.read_live(spark, f"{root}/state", keys, order)


@register("latest_earnings_common_words", _q("""SELECT symbol, sentiment, summary FROM (
  SELECT r.symbol, s.sentiment, m.summary,
         row_number() OVER (PARTITION BY r.symbol ORDER BY r.fiscal_period DESC NULLS LAST, r.file_name DESC,
                                                           md5(r.parsed_text) DESC) AS rn
  FROM transcripts_raw r JOIN cw_sentiment s ON s.path = r.path
  LEFT JOIN cw_summary m ON m.path = r.path) WHERE rn = 1""", O.text_ctes(
    positive=COMMON_POSITIVE, negative=COMMON_NEGATIVE, outlook=COMMON_OUTLOOK, prefix="cw")))
def q_latest_earnings_common_words(spark, sf_dir):
    """Newest transcript per symbol, enriched after the choice (one file per symbol)."""
    enrich = functools.partial(signals.stg_earnings_transcripts, positive=COMMON_POSITIVE,
                               negative=COMMON_NEGATIVE, outlook_terms=COMMON_OUTLOOK)
    return marts.latest_earnings(Silver(spark, sf_dir).transcripts_raw(), enrich=enrich)


@register("aum_by_segment_sql", _q("""SELECT investor_segment, count(investor_id) AS investor_count,
       sum(assets_under_management) AS total_aum
FROM investor_360 GROUP BY investor_segment"""))
def q_aum_by_segment_sql(spark, sf_dir):
    """The flagship metric through SQL over the semantic view's logical names."""
    view = semantic.investors_view(Silver(spark, sf_dir).investor_360).create_view("investors_sv_sql")
    return spark.sql(f"SELECT investor_segment, count(investor_id) AS investor_count, sum(aum) AS total_aum "
                     f"FROM {view} GROUP BY investor_segment")


# ------------------------------------------- builds, landings, history, lookups

def _with_severity(level: str) -> dict:
    return {m: [replace(t, severity=level) for t in tests] for m, tests in build.MODEL_TESTS.items()}


_STATUS_SQL = f"""
, dq AS ({_dq_tests_sql(build.MODEL_TESTS)})
, per AS (SELECT model, CAST(count(*) AS INTEGER) AS tests_run, CAST(count(*) FILTER (failures > 0) AS INTEGER) AS tests_failed
          FROM dq GROUP BY model)
, edges(model, up) AS (VALUES {", ".join(f"('{m}', '{u}')" for m, ups in build.DEPENDS_ON.items() for u in ups)})
, s1 AS (SELECT model FROM edges WHERE up IN (SELECT model FROM per WHERE tests_failed > 0))
, s2 AS (SELECT model FROM s1 UNION SELECT model FROM edges WHERE up IN (SELECT model FROM s1))
SELECT model, CASE WHEN model IN (SELECT model FROM s2) THEN 'skipped' WHEN tests_failed > 0 THEN 'failed_tests' ELSE 'success' END AS status,
       CASE WHEN model IN (SELECT model FROM s2) THEN 0 ELSE tests_run END AS tests_run,
       CASE WHEN model IN (SELECT model FROM s2) THEN 0 ELSE tests_failed END AS tests_failed
FROM per"""


def _build(spark, sf_dir, **options):
    name = f"build_{uuid.uuid4().hex}"
    drop_databases(spark, name)
    return name, build.build(spark, adapter.bronze(spark, sf_dir), sink=scratch_folder(spark, "builds"), as_of=O.AS_OF, schema=name, **options)


@register("gated_build_report", O.with_ctes_and(_STATUS_SQL))
def q_gated_build_report(spark, sf_dir):
    """The build over the given tables: their broken references and repeated ids gate the gold models."""
    return build.build_report(spark, _build(spark, sf_dir)[1])


@register("gold_tables", _q("""SELECT 'investor_360' AS model, count(*) AS n, CAST(sum(assets_under_management) AS DECIMAL(38,2)) AS total FROM investor_360
UNION ALL SELECT 'portfolio_risk', count(*), sum(gross_exposure) FROM portfolio_risk
UNION ALL SELECT 'investor_risk', count(*), sum(portfolio_gross_exposure) FROM investor_risk"""))
def q_gold_tables(spark, sf_dir):
    """The gold models as catalog tables of their layer (tests that only warn), read back by name."""
    layer, _ = _build(spark, sf_dir, tests=_with_severity("warn"))
    measure = {"investor_360": "assets_under_management", "portfolio_risk": "gross_exposure", "investor_risk": "portfolio_gross_exposure"}
    parts = [spark.table(sinks.table_name("marts", m, layer)).agg(F.count(F.lit(1)).alias("n"), F.sum(c).cast("decimal(38,2)").alias("total"))
             .select(F.lit(m).alias("model"), "n", "total") for m, c in measure.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@register("documents_landed", _q("SELECT file_name, symbol, fiscal_period, parsed_text FROM transcripts_raw WHERE file_name ILIKE '%.pdf'"))
def q_documents_landed(spark, sf_dir):
    """Truncate-and-load: the second load replaces the first."""
    path = scratch_folder(spark, "documents_landed")
    stage = adapter.document_stage(spark, sf_dir)
    documents.land_documents(stage, path, pattern="%.txt")
    documents.land_documents(stage, path)
    return spark.read.parquet(path).select("file_name", "symbol", "fiscal_period", "parsed_text")


def _metric_history(spark, sf_dir) -> DataFrame:
    """Two runs of all metrics of investor_360, accumulated with the time of measurement."""
    path = scratch_folder(spark, "dq_metric_history")
    found = materialize(quality.metrics(Silver(spark, sf_dir).investor_360(), DQ_METRICS["investor_360"], "investor_360"), "metrics")
    for hour in range(2):
        quality.append_results(found, path, dt.datetime(2026, 1, 1, hour))
    return spark.read.parquet(path)


_HISTORY_SQL = """
SELECT t.measured_at, m.* FROM (VALUES (TIMESTAMP '2026-01-01 00:00:00'), (TIMESTAMP '2026-01-01 01:00:00')) AS t(measured_at), (
  SELECT 'investor_360' AS "table", 'negative_aum' AS metric, 'assets_under_management' AS "column",
         count(*) FILTER (assets_under_management < 0) AS value FROM investor_360
  UNION ALL SELECT 'investor_360', 'dup_investor_id', 'investor_id',
         count(*) - count(DISTINCT investor_id) - max(CASE WHEN investor_id IS NULL THEN 1 ELSE 0 END) FROM investor_360
  UNION ALL SELECT 'investor_360', 'null_email', 'email', count(*) FILTER (email IS NULL) FROM investor_360) m"""


@register("dq_metric_history_all", _q(_HISTORY_SQL))
@register("dq_metric_history", _q(_HISTORY_SQL))
def q_dq_metric_history(spark, sf_dir):
    """Every metric declared for the table over two runs; the second name is an earlier one."""
    return _metric_history(spark, sf_dir)


def _customers_masked(spark, sf_dir, role):
    own = adapter.customers(spark, sf_dir).select("customer_id", "updated_at", "first_name", "last_name", "email", "country")
    return governance.apply_masking(governance.tag_pii(own, governance.INVESTOR_TAGS, governance.INVESTOR_PII), role)


@register("customers_masked_analyst", _q("""SELECT customer_id, updated_at, '****MASKED****' AS first_name, '****MASKED****' AS last_name,
       regexp_replace(email, '^[^@]+', '****') AS email, country FROM b_customers"""))
def q_customers_masked_analyst(spark, sf_dir):
    return _customers_masked(spark, sf_dir, "analyst")


@register("customers_masked_admin", _q("SELECT customer_id, updated_at, first_name, last_name, email, country FROM b_customers"))
def q_customers_masked_admin(spark, sf_dir):
    return _customers_masked(spark, sf_dir, "admin")


@register("column_tags", O.with_ctes_and(f"""
, found AS ({_classify_sql("b_customers", _CUSTOMER_STRING_COLS)})
SELECT "column", 'semantic_category' AS tag, category AS value FROM found
UNION ALL SELECT "column", 'privacy_category', privacy FROM found"""))
def q_column_tags(spark, sf_dir):
    """Tag lookup: the customer columns tagged by what their values are classified as."""
    own = adapter.customers(spark, sf_dir)
    found = governance.classify_columns(own, threshold=0.8).collect()          # a row per column at most
    tagged = governance.tag_pii(own, {r["column"]: r["category"] for r in found})
    return spark.createDataFrame(governance.tags(tagged), "column string, tag string, value string")


@register("top_positions", _q("""SELECT row_number() OVER (ORDER BY gross_exposure DESC, investor_id, symbol) AS rank,
       investor_id, symbol, gross_exposure FROM portfolio_risk ORDER BY rank LIMIT 10"""))
def q_top_positions(spark, sf_dir):
    """ORDER BY .. LIMIT 10 with the place of each row."""
    top = (Silver(spark, sf_dir).portfolio(False).select("investor_id", "symbol", "gross_exposure")
           .orderBy(F.col("gross_exposure").desc(), "investor_id", "symbol").limit(10))
    place = F.row_number().over(Window.orderBy(F.col("gross_exposure").desc(), "investor_id", "symbol"))   # over ten rows
    return top.select(place.cast("long").alias("rank"), "investor_id", "symbol", "gross_exposure")


# ------------------------------------------------------- search as a service

def _search_sql(body: str, k: int) -> str:
    ranked = _bm25_sql(k).replace("SELECT t.query_id, t.rank, e.file_name", ", ranked AS (SELECT t.query_id, t.rank, e.path, e.fiscal_period, e.file_name")
    return f"{ranked})\n{body}"


@register("search_request", O.with_ctes_and(_search_sql("""SELECT rank, path, score, symbol, fiscal_period FROM ranked
WHERE query_id = (SELECT min(item_id) FROM benchmark)""", 5)))
def q_search_request(spark, sf_dir):
    """One request {query, columns, limit}: the text of the first benchmark item."""
    text = adapter.read_table(spark, sf_dir, "benchmark").orderBy("item_id").select("text").first()["text"]   # one row
    raw = Silver(spark, sf_dir).transcripts_raw()
    out = search.search(raw, text, columns=("symbol", "fiscal_period"), limit=5, id_col="path", text_col="parsed_text")
    return out.select(F.col("rank").cast("long").alias("rank"), "path", "score", "symbol", "fiscal_period")


@register("search_results_json", O.with_ctes_and(_search_sql("SELECT query_id, file_name, symbol FROM ranked", 3)))
def q_search_results_json(spark, sf_dir):
    """Every query's results as one JSON document, flattened back into rows."""
    raw = Silver(spark, sf_dir).transcripts_raw()
    top = search.bm25_topk(raw, adapter.read_table(spark, sf_dir, "benchmark"), k=3, id_col="path", text_col="parsed_text",
                           qid_col="item_id", columns=("file_name", "symbol"))
    return search.flatten_results(search.results_json(top, ["file_name", "symbol"]), "file_name string, symbol string")


@register("search_index_filtered", O.with_ctes_and(_bm25_sql(3, "sentiment = 'positive'").replace(
    "e.symbol, e.sentiment", "e.symbol, e.fiscal_period, e.sentiment, e.summary")))
def q_search_index_filtered(spark, sf_dir):
    """The tiered index with its attributes: some documents in an older version first, then
    all in the present one, delivered twice; asked with a filter on an attribute."""
    docs = signals.stg_earnings_transcripts(Silver(spark, sf_dir).transcripts_raw()).withColumn("modified_at", F.col("loaded_at"))
    docs = materialize(docs, "indexed_documents")
    index = SearchIndex(spark, scratch_folder(spark, "search_index"), columns=_INDEXED, fan_in=2)
    older = F.concat(F.lit("earlier text "), "parsed_text")
    index.refresh(docs.filter("symbol IS NOT NULL").withColumns(
        {"parsed_text": older, "modified_at": F.col("modified_at") - F.expr("INTERVAL 1 DAY")}))
    for _ in range(2):
        index.refresh(docs)
    return _ranked(index, spark, sf_dir, "sentiment = 'positive'").select(
        "query_id", "rank", "file_name", "score", "symbol", "fiscal_period", "sentiment", "summary")


_INDEXED = ("file_name", "symbol", "fiscal_period", "sentiment", "summary")


def _ranked(index, spark, sf_dir, filters=None):
    top = index.topk(adapter.read_table(spark, sf_dir, "benchmark"), k=3, qid_col="item_id", filters=filters)
    return top.withColumn("rank", F.col("rank").cast("long"))


@register("bm25_pruned", O.with_ctes_and(_bm25_sql(3).replace("e.symbol, e.sentiment", "e.symbol")))
def q_bm25_pruned(spark, sf_dir):
    """The same ranking from impact blocks: only blocks that can reach the top are read."""
    raw = Silver(spark, sf_dir).transcripts_raw().withColumn("modified_at", F.col("loaded_at"))
    index = SearchIndex(spark, scratch_folder(spark, "search_index"), columns=("file_name", "symbol"))
    index.refresh(raw)
    return _ranked(index, spark, sf_dir).select("query_id", "rank", "file_name", "score", "symbol")


_NEIGHBOURS_SQL = """
WITH e AS (SELECT 'v' || vec_id AS id, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
, n AS (SELECT id, sqrt(sum(CAST(x AS DOUBLE) * x)) AS len FROM e GROUP BY id)
, dots AS (SELECT q.id AS query_id, c.id AS vec_id, sum(CAST(q.x AS DOUBLE) * CAST(c.x AS DOUBLE)) AS dot
           FROM e q JOIN e c ON c.pos = q.pos WHERE q.vec_id % 50 = 0 GROUP BY ALL)
, scored AS (SELECT query_id, vec_id, round(dot / (a.len * b.len), 6) AS score
             FROM dots JOIN n a ON a.id = query_id JOIN n b ON b.id = vec_id WHERE a.len > 0 AND b.len > 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id ASC) AS rank FROM scored) WHERE rank <= 5"""


@register("cosine_neighbours", _NEIGHBOURS_SQL)
def q_cosine_neighbours(spark, sf_dir):
    """The 5 nearest vectors of every vector whose id is divisible by 50; string ids."""
    emb = adapter.read_table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("id"), "vec_id", "embedding")
    queries = emb.filter("vec_id % 50 = 0").select(F.col("id").alias("query_id"), "embedding")
    out = search.cosine_topk(emb, queries, k=5, id_col="id").withColumnRenamed("id", "vec_id")
    return out.withColumn("rank", F.col("rank").cast("long"))


# ----------------------------------------------------------- document sync

def _deliver(spark, rows: DataFrame, folder: str, bucket: str, at: int) -> None:
    """Write the rows as one file per value of ``bucket``, under a fixed name and with the
    file time ``at`` (seconds): a second delivery rewrites the file in place."""
    work = f"{folder}-{uuid.uuid4().hex}"
    rows.repartition(bucket).write.partitionBy(bucket).text(work)
    fs, root = hadoop_path(spark, work)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(folder))
    for found in fs.globStatus(path(f"{work}/{bucket}=*/part-*")):
        name = found.getPath().getParent().getName().split("=")[1]
        target = path(f"{folder}/batch_{name}.pdf")
        fs.delete(target, False)
        fs.rename(found.getPath(), target)
        fs.setTimes(target, at * 1000, -1)


def _synced_documents(spark, sf_dir) -> DataFrame:
    """doc_id, source, text of the documents as landed from files of JSON lines, new, delivered
    again without change and rewritten in place, in three runs; the newest version of each."""
    from .streaming import documents as docstream
    root = scratch_folder(spark, "docs_sync")
    docs = adapter.read_table(spark, sf_dir, "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = 3 * (1 + size // 12_000_000)           # a file holds about 4 MB of text

    def lines(rows: DataFrame, mark: str = "") -> DataFrame:
        return rows.select(F.to_json(F.struct("doc_id", F.concat(F.lit(mark), "source").alias("source"), "text")).alias("value"),
                           F.pmod("doc_id", F.lit(files)).alias("bucket"))

    _deliver(spark, lines(docs.filter("doc_id % 3 <> 2")), f"{root}/stage", "bucket", 1_700_000_000)
    docstream.sync_documents(spark, f"{root}/stage", f"{root}/landed")
    docstream.sync_documents(spark, f"{root}/stage", f"{root}/landed")
    _deliver(spark, lines(docs.filter("doc_id % 3 = 1"), "changed ").unionByName(lines(docs.filter("doc_id % 3 = 2"))), f"{root}/stage", "bucket", 1_700_000_060)
    docstream.sync_documents(spark, f"{root}/stage", f"{root}/landed")
    row = F.from_json("line", "doc_id long, source string, text string")
    return (docstream.current_documents(spark, f"{root}/landed").select(F.explode(F.split("parsed_text", "\n")).alias("line"))
            .filter("line <> ''").select(row.alias("r")).select("r.*"))


@register("docs_sync", """SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 'changed ' ELSE '' END || source AS source, n_chars FROM documents""")
def q_docs_sync(spark, sf_dir):
    """The synced documents with the length of the text that was landed."""
    return _synced_documents(spark, sf_dir).select("doc_id", "source", F.length("text").cast("long").alias("n_chars"))


@register("docs_sync_texts", """SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 'changed ' ELSE '' END || source AS source,
       length(text) AS text_chars, sha256(text) AS text_digest FROM documents""")
def q_docs_sync_texts(spark, sf_dir):
    """The synced documents with length and digest of the text that was landed."""
    return _synced_documents(spark, sf_dir).select("doc_id", "source", F.length("text").cast("long").alias("text_chars"),
                                                   F.sha2("text", 256).alias("text_digest"))


from . import registry_services  # noqa: E402,F401  (registers its queries; needs the names above)
