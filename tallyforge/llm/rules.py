"""Quality rules: per-text counts and cross-document line frequency.

Built-in expressions only (no Python in the plan). The base rules count words,
symbols, repeated lines and repeated word windows inside one text with array
expressions, so they need no shuffle. The line rule hashes the normalised
lines, counts in how many distinct texts of a host each occurs, removes lines
above the host's limit and rejects documents that lose too much. ``cleaned``
gives the documents without those lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import FILTER_BITS

SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A line is removed when more distinct texts of its host hold it than both of these.
MIN_LINE_DOCS = 20
MAX_LINE_PERCENT = 1.0
# Lines of so many words do not recur by chance; with ``long_words`` the percentage is not asked of them.
LONG_WORDS = 10
# A document is depleted below MIN_WORDS remaining words or above this loss.
MAX_REMOVED_PERCENT = 50


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS)), " "), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text), F.hash(text), F.length(text))


def _repeat_words(hashes: Column, size: int) -> Column:
    """Words covered by windows whose hash occurs twice or more. Windows are
    sorted by (hash, place); equal neighbours are repeats; the union of their
    spans is summed in order of place."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = _let(pairs, lambda own: F.sort_array(F.filter(
        F.transform(own, lambda p, k: F.when(
            (p["h"] == F.get(own, k - 1)["h"]) | (p["h"] == F.get(own, k + 1)["h"]), p["i"])),
        lambda i: i.isNotNull())))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(size), p + size - a["end"])).alias("n"), (p + size).alias("end")))
    return covered["n"]


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: doc_id, host, text_key, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and the array ``lines`` of (hash, words) of its lines with a
    word, hashed in lower case with single spaces and every digit as 0. Null texts count as empty; ids and hosts may be null or repeated."""
    ascii_space = F.translate(F.col("t"), SPACE_CHARS, "")
    base = (docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
            .withColumns({"w": _words(F.col("t")),
                          "raw": F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")}))
    hashed = base.select(
        "doc_id", "host", _text_key(F.col("t")).alias("text_key"),
        F.size("w").cast("long").alias("n_words"),
        F.length(ascii_space).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.transform(F.transform("raw", lambda x: _words(F.translate(F.lower(x), "123456789", "0" * 9))), lambda w: F.struct(
            F.xxhash64(F.array_join(w, " ")).alias("hash"), F.size(w).alias("words"))).alias("lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("wh"))
    windows = hashed.withColumn("windows", F.when(F.size("wh") >= WINDOW, F.transform(
        F.slice("wh", 1, F.size("wh") - (WINDOW - 1)),
        lambda h, i: F.xxhash64(h, *(F.get(F.col("wh"), i + k) for k in range(1, WINDOW))))).otherwise(F.array().cast("array<bigint>")))
    repeats = F.when(F.size("windows") == F.size(F.array_distinct("windows")), F.lit(0)).otherwise(
        _repeat_words(F.col("windows"), WINDOW))
    return windows.withColumn("n_repeat_words", repeats.cast("long")).drop("wh", "windows")


def frequent_lines(stats: DataFrame, min_docs: int = MIN_LINE_DOCS, max_percent: float = MAX_LINE_PERCENT,
                   long_words: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines of distinct texts, lines above their host's limit).

    The limit is more than ``min_docs`` texts and more than ``max_percent`` of the
    host's. With ``long_words``, lines of at least so many words have the first limit
    only: they do not recur by chance, however large the host.

    Copies of one text count once, so a group of copies does not make its own
    lines frequent. Counts are pre-aggregated in the map tasks: a line that half
    the corpus holds arrives as one row per task.
    """
    lines = (stats.select("host", "text_key", F.posexplode("lines").alias("pos", "line"))
             .groupBy("host", "text_key", "pos").agg(F.first("line.hash").alias("hash"), F.first("line.words").alias("words")))
    hosts = stats.groupBy("host").agg(F.count_distinct("text_key").alias("host_docs"))
    words = [] if long_words is None else [F.max("words").alias("line_words")]     # equal hash, equal words
    counts = lines.groupBy("host", "hash").agg(F.count_distinct("text_key").alias("line_docs"), *words).filter(F.col("line_docs") > min_docs)
    joined = counts.alias("c").join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
    above = F.col("line_docs") * 100 > F.col("host_docs") * max_percent
    if long_words is not None:
        above |= F.col("line_words") >= long_words
    frequent = joined.filter(above).select("c.host", "c.hash", "line_docs")
    return lines, frequent


def _removed(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """host, text_key, gone, gone_words: the places of a text's frequent lines among its
    lines with a word, and their words."""
    return (lines.alias("l").join(
        frequent.alias("f"), F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.hash") == F.col("f.hash")), "left_semi")
        .groupBy("host", "text_key").agg(F.collect_list("pos").alias("gone"), F.sum("words").alias("gone_words")))


def _flagged(texts: DataFrame, removed: DataFrame) -> DataFrame:
    """``texts`` (with host and text_key) and the column ``flagged``: false when the text
    certainly loses no line. Read from a bitmap of at most 2 ** (FILTER_BITS - 6) rows."""
    h, bit = F.xxhash64("host", "text_key"), F.expr("shiftleft(1L, cast(at & 63 as int))")
    at = F.shiftrightunsigned(h, 64 - FILTER_BITS)
    bits = (removed.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")))
    found = texts.withColumn("at", at).withColumn("word", F.shiftright("at", 6)).join(F.broadcast(bits), "word", "left")
    return found.withColumn("flagged", F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))).drop("at", "word", "bits")


def _without(text: Column, gone: Column) -> Column:
    """``text`` without the lines at the places ``gone``, counted over its lines with a
    word; the other lines stay as they are, blank ones too."""
    def kept(own: Column, places: Column) -> Column:
        filled = F.filter(places, lambda i: F.translate(F.get(own, i), SPACE_CHARS, "") != "")
        left = F.array_except(places, _let(filled, lambda at: F.transform(gone, lambda p: F.get(at, p))))
        return F.array_join(F.transform(left, lambda i: F.get(own, i)), "\n")
    return _let(F.split(text, "\n"), lambda own: _let(F.sequence(F.lit(0), F.size(own) - 1), lambda places: kept(own, places)))


def _same_text(left: str, right: str) -> Column:
    return F.col(f"{left}.host").eqNullSafe(F.col(f"{right}.host")) & (F.col(f"{left}.text_key") == F.col(f"{right}.text_key"))


def _keyed(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{host_col}`").alias("host"),
                       text.alias("t"), _text_key(text).alias("text_key"))


def cleaned(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_docs: int = MIN_LINE_DOCS,
            max_percent: float = MAX_LINE_PERCENT, long_words: int | None = None) -> DataFrame:
    """``docs`` with the lines above their host's limit removed from every text; columns
    and rows are the same. The other lines stay as they are and in order; a text that
    loses all its lines becomes empty, a null text stays null. Texts that lose nothing
    stay where they are; only the others move."""
    stats = materialize(text_stats(docs, host_col, text_col, host_col).select("host", "text_key", "lines"), "line-hashes")
    removed = _removed(*frequent_lines(stats, min_docs, max_percent, long_words)).drop("gone_words")
    removed = materialize(removed, "removed-lines")           # a filter and a join read it
    found = _flagged(_keyed(docs, text_col, host_col), removed)
    moved = found.filter("flagged").alias("t").join(removed.alias("r"), _same_text("t", "r"), "left")
    clean = F.when(F.col("gone").isNotNull(), _without(F.col("t.t"), F.col("gone"))).otherwise(F.col("row")[text_col].cast("string"))
    return found.filter("not flagged").select("row.*").withColumn(text_col, F.col(f"`{text_col}`").cast("string")).unionByName(
        moved.select(*(clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns)))


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               min_docs: int = MIN_LINE_DOCS, max_percent: float = MAX_LINE_PERCENT,
               max_removed_percent: float = MAX_REMOVED_PERCENT, long_words: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, removed_words.

    base_failed: fewer than 10 words, or over 20 % of the words in repeated
    windows. removed_words: words of the text that its ``cleaned`` text no longer has.
    kept: not base_failed and not depleted, that is, the cleaned text has at least 10
    words and at least half of the words. Null texts
    count as empty and fail; a null host is a host of its own; null and repeated
    ids are judged by their own text; an empty table gives no rows; only the
    three named columns are read.
    """
    # one pass over the texts; the line counts then work on hashes only
    stats = materialize(text_stats(docs, id_col, text_col, host_col), "text-stats")
    removed = _removed(*frequent_lines(stats, min_docs, max_percent, long_words)).drop("gone")
    judged = stats.drop("lines").alias("s").join(removed.alias("r"), _same_text("s", "r"), "left")
    gone = F.coalesce(F.col("gone_words"), F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_words") - gone < MIN_WORDS) | (100 * gone > max_removed_percent * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), gone.alias("removed_words"))
