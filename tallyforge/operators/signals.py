"""Text signals of a transcript: sentiment label and a forward-outlook sentence.

Both are computed per row with built-in higher-order functions over the
token / sentence arrays of the document, so they are narrow (map-only)
transformations: no explode, no shuffle, no skew whatever the corpus size,
and every document is processed whole.

* Sentiment (lexicon scoring): p, n = number of tokens in the positive /
  negative word lists. ``p + n < min_hits`` -> neutral; both present and
  ``|p - n| < mixed_pct% of (p + n)`` -> mixed; otherwise the larger side.
* Outlook (extractive): the sentence with the most outlook-term tokens; ties
  go to the earliest sentence; NULL when no sentence mentions a term.

The model-backed scorer of a warehouse is replaced by these jobs; a user can
pass ``scorer`` (a pandas UDF ``text -> label``) to plug in a model instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import TOKEN_PATTERN, tokens

# Default finance sentiment word lists.
POSITIVE_WORDS = (
    "strong", "stronger", "record", "growth", "grew", "exceeded", "beat", "raising", "raised",
    "improved", "improving", "robust", "momentum", "expanded", "expansion", "increase",
    "increased", "gains", "profitable", "outperformed", "upside", "confident", "optimistic",
    "accelerating", "solid", "healthy", "resilient", "favorable", "tailwinds", "upgrade",
)
NEGATIVE_WORDS = (
    "decline", "declined", "declining", "weak", "weaker", "weakened", "weakness", "challenging",
    "difficult", "pressure", "lowering", "lowered", "cut", "cutting", "loss", "losses",
    "impairment", "disappointed", "disappointing", "concern", "concerns", "deteriorating",
    "uncertain", "uncertainty", "headwinds", "compressed", "suspending", "suspended",
    "downturn", "shortfall", "missed", "volatility", "slowdown",
)
# Words that mark a forward-looking statement.
OUTLOOK_WORDS = (
    "outlook", "guidance", "expect", "expects", "expected", "anticipate", "anticipates",
    "forecast", "forecasts", "ahead", "forward", "future", "next", "coming", "plan", "plans",
    "target", "targets", "will", "intend", "intends", "project", "projects",
)

MIN_HITS = 4
MIXED_PCT = 80

SENTENCE_PATTERN = r"[^.!?]+[.!?]*"


def _count_in(toks: Column, words: Iterable[str]) -> Column:
    words = list(dict.fromkeys(words))
    return F.size(F.filter(toks, lambda t: t.isin(*words)))


def sentiment_label(p: Column, n: Column, min_hits: int = MIN_HITS, mixed_pct: int = MIXED_PCT) -> Column:
    total = p + n
    return (F.when(total < min_hits, F.lit("neutral"))
             .when((p > 0) & (n > 0) & (F.abs(p - n) * 100 < F.lit(mixed_pct) * total), F.lit("mixed"))
             .when(p > n, F.lit("positive"))
             .otherwise(F.lit("negative")))


def with_sentiment(df: DataFrame, text_col: str = "parsed_text", positive=POSITIVE_WORDS,
                   negative=NEGATIVE_WORDS, min_hits: int = MIN_HITS, mixed_pct: int = MIXED_PCT,
                   pattern: str = TOKEN_PATTERN, out: str = "sentiment", keep_counts: bool = False,
                   scorer=None) -> DataFrame:
    """Add a sentiment label column (and optionally the pos/neg hit counts)."""
    if scorer is not None:
        return df.withColumn(out, scorer(F.col(text_col)))
    keep = [F.col(c) for c in df.columns]
    d = df.select(*keep, tokens(text_col, pattern).alias("_tok"))
    d = d.select(*keep, _count_in(F.col("_tok"), positive).alias("positive_hits"),
                 _count_in(F.col("_tok"), negative).alias("negative_hits"))
    label = sentiment_label(F.col("positive_hits"), F.col("negative_hits"), min_hits, mixed_pct).alias(out)
    counts = ["positive_hits", "negative_hits"] if keep_counts else []
    return d.select(*keep, *counts, label)


def sentences(c: Column | str) -> Column:
    """Array of whitespace-normalised, trimmed sentences."""
    col = F.col(c) if isinstance(c, str) else c
    raw = F.regexp_extract_all(col, F.lit(SENTENCE_PATTERN), 0)
    return F.transform(raw, _normalise)


def outlook_sentence(c: Column | str, terms=OUTLOOK_WORDS, pattern: str = TOKEN_PATTERN) -> Column:
    """The sentence with most outlook-term tokens (earliest on ties), or NULL.
    Sentences are scored raw; only the chosen one is whitespace-normalised."""
    col = F.col(c) if isinstance(c, str) else c
    terms = list(dict.fromkeys(terms))
    raw = F.regexp_extract_all(col, F.lit(SENTENCE_PATTERN), 0)
    scored = F.transform(raw, lambda s, i: F.struct(
        _count_in(tokens(s, pattern), terms).alias("score"), (-i).alias("neg_pos"), s.alias("sentence")))
    best = F.array_max(F.filter(scored, lambda x: x["score"] > 0))
    return _normalise(best.getField("sentence"))


def _normalise(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"[ \t\n\r\f]+", " "), r"^ +| +$", "")


def with_signals(df: DataFrame, text_col: str = "parsed_text", positive=POSITIVE_WORDS,
                 negative=NEGATIVE_WORDS, outlook_terms=OUTLOOK_WORDS, min_hits: int = MIN_HITS,
                 mixed_pct: int = MIXED_PCT, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Add ``sentiment`` and ``summary`` from ONE tokenisation of the text.

    Sentences cover every token of the document (tokens never contain sentence
    punctuation), so the document's lexicon hits are the sums of its sentences'
    hits; only the chosen sentence is whitespace-normalised.
    """
    positive, negative = list(dict.fromkeys(positive)), list(dict.fromkeys(negative))
    terms = list(dict.fromkeys(outlook_terms))
    keep = [F.col(c) for c in df.columns]
    # three projection levels: sentences, their tokens, then counts and choices
    d = df.select(*keep, F.regexp_extract_all(F.col(text_col), F.lit(SENTENCE_PATTERN), 0).alias("_sent"))
    d = d.select(*keep, "_sent", F.transform("_sent", lambda s: tokens(s, pattern)).alias("_stok"))
    hits = lambda words: F.aggregate("_stok", F.lit(0), lambda acc, ts: acc + _count_in(ts, words))
    scored = F.transform("_stok", lambda ts, i: F.struct(
        _count_in(ts, terms).alias("score"), (-i).alias("neg_pos"), i.alias("idx")))
    best = F.array_max(F.filter(scored, lambda x: x["score"] > 0)).getField("idx")
    d = d.select(*keep, "_sent", hits(positive).alias("_p"), hits(negative).alias("_n"), best.alias("_best"))
    return d.select(*keep,
                    sentiment_label(F.col("_p"), F.col("_n"), min_hits, mixed_pct).alias("sentiment"),
                    F.when(F.col("_best").isNotNull(),
                           _normalise(F.element_at("_sent", F.col("_best") + 1))).alias("summary"))


def stg_earnings_transcripts(raw: DataFrame, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS,
                             outlook_terms=OUTLOOK_WORDS, min_hits: int = MIN_HITS,
                             mixed_pct: int = MIXED_PCT, scorer=None) -> DataFrame:
    """Enriched transcripts: file_name, symbol, fiscal_period, parsed_text,
    sentiment, summary, loaded_at, and path where the landing has it."""
    cols = ["file_name", "symbol", "fiscal_period", "parsed_text", "sentiment", "summary", "loaded_at",
            *(["path"] if "path" in raw.columns else [])]
    if scorer is not None:
        d = with_sentiment(raw, "parsed_text", scorer=scorer)
        return d.withColumn("summary", outlook_sentence("parsed_text", outlook_terms)).select(*cols)
    return with_signals(raw, "parsed_text", positive, negative, outlook_terms, min_hits, mixed_pct).select(*cols)
