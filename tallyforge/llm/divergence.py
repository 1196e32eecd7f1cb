"""Source divergence audit: how far the word use of sources lies from one another.

Terms are runs of letters and non-ASCII characters, only A-Z lower-cased. A language
keeps the terms in at least ``MIN_DOCS`` of its documents. Every (lang, source) group
gives a kept term p = 1 + floor(10**9 * (count + 1) / (N + V)), N the group's occurrences
of kept terms and V the language's number of them; a language gives q likewise over its
sources together. The divergence of p from q is floor((p - q)**2 / q), in exact integers.

* ``terms``: per group the ``TOP`` terms that it uses more than its language does, most
  divergent first, by a dominance skyband: of two terms in one group, the one with a
  count at least as high, a count in the language at most as high and the earlier UTF-8
  ranks first, whatever N and V are. A term dominated by ``TOP`` others can't be among
  the first TOP, so partitions keep only terms dominated by fewer, merged skybands keep
  only those of their union, and what is left is ranked exactly.
* ``pairs``: per group and other source of its language, the divergence summed over all
  kept terms. Terms are dealt into buckets and a language's sources into blocks of about
  ``BLOCK_SOURCES``; a task holds the counts of one bucket for two blocks as a matrix and
  gives one sum per pair of sources. Terms in neither block are one closed expression.

Words are counted inside map tasks before they move; counts, document frequencies and
the language's totals come from one shuffle by (lang, term), in which a word that every
row holds is a few rows per map task. A hot group is spread over all buckets. No task
holds a group's whole vocabulary but its skyband, which is merged in two steps.

Null text, lang and source count as empty. Groups without terms have all pairs and no
terms; a language without kept terms has pairs of value 0. Repeated rows count as often
as they occur. Extra columns are ignored. An empty table gives empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, slices

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
HELD_TERMS = 300_000       # distinct (lang, source, term) that a task holds before it sends them
SKYBAND_ROWS = 100_000     # rows that a task collects before it prunes them
SALTS = 16                 # parts of a group in the first merge of skybands
BLOCK_SOURCES = 128        # sources of a block on average
BUCKET_ROWS = 20_000       # counts of a bucket on average

# A-Z become a-z, bytes of non-ASCII characters stay, every other byte separates
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
           min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(kept terms: lang, source, term, n, lang_n; groups: lang, source, total, lang_total,
    v), every occurring group included. Both are stored."""
    scratch = Scratch(docs.sparkSession, "divergence")
    names = ["lang", "source", "term", "n", "docs"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():
                # the row without a term stands for the group itself
                terms = ["", *(t.decode("utf-8", "surrogatepass") for t in n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.string()),
                     pa.array([0, *n.values()], pa.int64()), pa.array([0, *(d[t] for t in n)], pa.int64())], names)
            held.clear()

        for whole in batches:
            for batch in slices(whole, "text"):
                for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
                    words = terms_of(text)
                    n, d = held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    n.update(words)
                    d.update(set(words))
                    size += len(n)
                if size > HELD_TERMS:
                    yield from sent()
                    size = 0
        yield from sent()

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias({text_col: "text", lang_col: "lang", source_col: "source"}[name])

    rows = docs.select(text_of(text_col), text_of(lang_col), text_of(source_col)).mapInArrow(
        count, "lang string, source string, term string, n long, docs long")
    # one shuffle by (lang, term): the groups' counts and the language's totals meet in it
    word = Window.partitionBy("lang", "term")
    per_group = rows.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    found = scratch.store(
        per_group.select("lang", "source", "term", "n", F.sum("n").over(word).alias("lang_n"), F.sum("docs").over(word).alias("lang_docs"),
                         (F.row_number().over(word.orderBy("source")) == 1).alias("first"))
        .filter((F.col("lang_docs") >= min_docs) | (F.col("term") == "")).drop("lang_docs"), "counts")
    kept = found.filter("term <> ''")
    per_lang = scratch.store(kept.filter("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "langs")
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = totals.join(per_lang, "lang", "left").select(
        "lang", "source", "total", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("lang_total", "v")))
    return kept.drop("first"), scratch.store(groups, "groups")


# ------------------------------------------------------------------- skyband

def skyband(n: np.ndarray, lang_n: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Which points are dominated by fewer than ``k`` others with a higher or equal ``n``,
    a lower or equal ``lang_n`` and an earlier ``place`` (all places differ)."""
    order = np.lexsort((place, lang_n, -n))
    same = np.ones(len(order), bool)
    same[1:] = (np.diff(n[order]) != 0) | (np.diff(lang_n[order]) != 0)
    first = np.flatnonzero(same)
    nth = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    order = order[nth < k]                       # the others of a class are dominated within it
    band = np.zeros(0, np.int64)                 # points of the band so far: all of a higher or equal n
    for begin in range(0, len(order), 512):
        new = order[begin:begin + 512]
        over = ((lang_n[band] <= lang_n[new][:, None]) & (place[band] < place[new][:, None])).sum(axis=1) if len(band) else np.zeros(len(new), np.int64)
        new, over = new[over < k], over[over < k]
        within = np.tril((lang_n[new] <= lang_n[new][:, None]) & (place[new] < place[new][:, None]) & (n[new] >= n[new][:, None]), -1)
        band = np.append(band, new[over + within.sum(axis=1) < k])
    out = np.zeros(len(n), bool)
    out[band] = True
    return out


def _prune(k: int):
    """Keep the skyband of each group among the rows of a task."""
    def pruned(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        place = np.empty(table.num_rows, np.int64)
        place[pc.sort_indices(table.column("term").combine_chunks().cast(pa.binary())).to_numpy()] = np.arange(table.num_rows)
        n, lang_n = (table.column(c).to_numpy() for c in ("n", "lang_n"))
        group = [table.column(c).combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("lang", "source")]
        group = group[0] * (table.num_rows + 1) + group[1]
        order = np.argsort(group, kind="stable")
        keep = np.zeros(table.num_rows, bool)
        for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            keep[rows[skyband(n[rows], lang_n[rows], place[rows], k)]] = True
        return table.filter(pa.array(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, SKYBAND_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size > limit:
                table = pruned(pa.Table.from_batches(held))
                held, size = table.to_batches(), table.num_rows
                limit = 2 * size + SKYBAND_ROWS
        if size:
            yield from pruned(pa.Table.from_batches(held)).to_batches()

    return run


def terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: the terms that each group uses most beyond its
    language's use."""
    prune, schema = _prune(top), kept.schema
    band = kept.mapInArrow(prune, schema)
    band = band.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS))).mapInArrow(prune, schema)
    rows = band.join(groups, ["lang", "source"])
    p, q = _share("n", "total"), _share("lang_n", "lang_total")
    rows = rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    value = F.expr("(p - q) * (p - q) div q").alias("value")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return (rows.select("lang", "source", "item", value).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= top))


def _share(n: str, total: str) -> Column:
    wide = f"cast({n} as decimal(20, 0))"
    return F.expr(f"1L + ({wide} + 1) * {SCALE} div cast({total} + v as decimal(20, 0))")


# --------------------------------------------------------------------- pairs

def _shares(n: np.ndarray, of: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (n + 1) / of) in two steps that fit 64 bits up to 9 * 10**13."""
    whole, rest = np.divmod((n + 1) * 100_000, of)
    return 1 + whole * 10_000 + rest * 10_000 // of


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank``: every other source of the group's language, the
    most divergent first."""
    sizes = Scratch(kept.sparkSession, "divergence-sizes").store(
        groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
        .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "lang", "left")
        .select("lang", (1 + F.expr(f"sources div {BLOCK_SOURCES}")).alias("blocks"),
                (1 + F.expr(f"coalesce(`rows`, 0) div {BUCKET_ROWS}")).alias("buckets")), "sizes")     # a row per language
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)

    def meetings(rows: DataFrame) -> DataFrame:
        """A row for each ordered pair of blocks (i: the groups, j: the others) with its own."""
        own = rows.withColumn("b", block)
        both = F.concat(F.transform(every, lambda j: F.struct(F.col("b").alias("i"), j.alias("j"))),
                        F.transform(F.filter(every, lambda i: i != F.col("b")), lambda i: F.struct(i.alias("i"), F.col("b").alias("j"))))
        return own.withColumn("meeting", F.explode(both)).select("*", "meeting.i", "meeting.j").drop("meeting", "blocks")

    left = meetings(kept.drop("lang_n").join(sizes, "lang").withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets"))))
    same = sizes.select(*(F.col(c).alias(c) for c in sizes.columns))           # columns of its own for the co-group
    right = meetings(groups.drop("lang_total").join(same, "lang")).withColumn(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """Sums over the bucket's terms for each group of block i and source of block j."""
        lang, i, j = (right.column(c)[0].as_py() for c in ("lang", "i", "j"))
        sources, total = right.column("source").to_pylist(), right.column("total").to_numpy()
        v, of = right.column("v")[0].as_py(), right.column("b").to_numpy()
        number = {s: k for k, s in enumerate(sources)}
        words: dict[str, int] = {}
        at = np.array([words.setdefault(t, len(words)) for t in left.column("term").to_pylist()], np.int64)
        n = np.zeros((len(sources), len(words)), np.int64)
        n[np.array([number[s] for s in left.column("source").to_pylist()], np.int64), at] = left.column("n").to_numpy()
        share = _shares(n, np.maximum(total + v, 1)[:, None])
        ours, theirs = np.flatnonzero(of == i), np.flatnonzero(of == j)
        out = [(sources[a], sources[b], s) for a in ours for b, s in zip(theirs, _divergence(share[a], share[theirs]).sum(axis=1).tolist()) if a != b]
        source, item, value = zip(*out) if out else ((), (), ())
        return pa.table([pa.array([lang] * len(out), pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()),
                         pa.array(value, pa.int64()), pa.array([len(words)] * len(out), pa.int64())],
                        names=["lang", "source", "item", "value", "terms"])

    key = ["lang", "i", "j", "bucket"]
    sums = (left.groupBy(*key).cogroup(right.groupBy(*key))
            .applyInArrow(meet, "lang string, source string, item string, value long, terms long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))
    one = groups.select("lang", "source", F.col("total").alias("n"), "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("m"))
    sums = sums.join(one, ["lang", "source"]).join(other, ["lang", "item"])
    # terms that neither has met: counts of 0 on both sides, the same value for each
    p, q = (F.expr(f"1L + {SCALE}L div greatest({c} + v, 1L)") for c in ("n", "m"))
    sums = sums.withColumn("p", p).withColumn("q", q)
    value = F.expr("value + (v - terms) * ((p - q) * (p - q) div q)")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return sums.select("lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(best))


def audit(docs: DataFrame, top: int = TOP, min_docs: int = MIN_DOCS) -> DataFrame:
    """Both parts over ``documents``: ``lang, source, part, item, value, rank``."""
    kept, groups = counts(docs, min_docs=min_docs)
    both = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
            for part, x in (("pair", pairs(kept, groups)), ("term", terms(kept, groups, top)))]
    return both[0].unionByName(both[1])
