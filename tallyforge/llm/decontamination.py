"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units are replaced by typed
placeholders, everything else is lower-cased and stripped of punctuation.
Windows of template tokens are hashed and equi-joined with the windows of the
benchmark items; the values behind the placeholders must map one to one along
an alignment. A question whose numbers and names were exchanged therefore still
matches. ``strict`` says what breaks when they do not: the whole alignment, or
only the windows outside the majority's mapping.
"""

from __future__ import annotations

import itertools
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, Scratch, anti_join, hash_bitmap, in_bitmap, slices, texts_of

WINDOW = 8
MIN_LITERALS = 5        # a window with fewer literal tokens is too general to count
MIN_COVERAGE = 0.3      # share of an item's windows that must match consistently
MEMO = 100_000

UNITS = frozenset("""
mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms tonne tonnes ounce ounces
pound pounds ml cl l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks
month months year years cent cents dollar dollars euro euros usd eur gbp percent degree degrees mph kmh volt volts watt watts
""".split())

LITERAL, NUMBER, UNIT, NAME, SKIP = range(5)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def token(word: str) -> tuple[int, str, bool, bool]:
    """(kind, value, title-cased, ends a sentence) of a word by itself."""
    core = word
    if not word.isalnum():
        core = word.strip(string.punctuation)
        if core and not (core[0].isalnum() and core[-1].isalnum()):
            core = _EDGES.sub("", core)
    ends = len(core) < len(word) and word.rstrip("\"')]}»”’").endswith((".", "!", "?", ":"))
    if not core:
        return SKIP, "", False, ends
    value = core.lower()
    if not core.isalpha() and any(c.isdigit() for c in core):
        return NUMBER, value, False, ends
    if value in UNITS:
        return UNIT, value, False, ends
    return LITERAL, value, value != core and len(core) > 1 and core[0].isupper() and core[1:].islower(), ends


class Canonical:
    """Template windows of texts; words are analysed once and remembered."""

    def __init__(self, memo: int = MEMO):
        self.memo = memo
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.words: list[tuple[int, str, bool, bool]] = []
        self.hashes = np.zeros(1024, np.uint64)
        self.kinds = np.zeros(1024, np.uint8)
        self.title = np.zeros(1024, bool)
        self.ends = np.zeros(1024, bool)

    def _index(self, words: list[str]) -> np.ndarray:
        known, begin = self.known, len(self.words)
        for w in words:
            if w not in known:
                known[w] = len(self.words)
                self.words.append(token(w))
        new, end = self.words[begin:], len(self.words)
        while end > len(self.kinds):
            for name in ("hashes", "kinds", "title", "ends"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self.kinds[begin:end] = [f[0] for f in new]
        self.title[begin:end] = [f[2] for f in new]
        self.ends[begin:end] = [f[3] for f in new]
        self.hashes[begin:end] = [xxhash.xxh3_64_intdigest(f[1]) if f[0] == LITERAL else f[0] for f in new]
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def windows(self, texts: list[str]):
        """(text number, place, window hash, usable) of every window, and a function
        that gives the placeholder values of the window at an index."""
        if len(self.words) > self.memo:
            self._reset()
        parts = [t.split() for t in texts]
        own = self._index(list(itertools.chain.from_iterable(parts)))
        doc = np.repeat(np.arange(len(texts)), [len(ws) for ws in parts])
        kinds, title = self.kinds[own], self.title[own]
        follows = np.zeros(len(own), bool)              # stands inside a sentence
        follows[1:] = ~self.ends[own[:-1]] & (doc[1:] == doc[:-1])
        kinds = np.where((kinds == LITERAL) & title & follows, NAME, kinds)
        hashes = np.where(kinds == LITERAL, self.hashes[own], kinds.astype(np.uint64))
        used = kinds != SKIP
        own, doc, kinds, hashes = own[used], doc[used], kinds[used], hashes[used]
        n = max(0, len(own) - WINDOW + 1)
        out = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            out = (out + hashes[k:k + n]) * _MULTIPLIER
            out ^= out >> np.uint64(29)
        literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
        usable = (doc[:n] == doc[WINDOW - 1:][:n]) & (literal[WINDOW:][:n] - literal[:n] >= MIN_LITERALS)
        first = np.searchsorted(doc, np.arange(len(texts)))
        place = np.arange(n) - first[doc[:n]]

        def slots(i: int) -> list[str]:
            return [f"{kinds[j]}:{self.words[own[j]][1]}" for j in range(i, i + WINDOW) if kinds[j] != LITERAL]

        return doc[:n], place, out, usable, slots


_SCHEMA = "id long, text_key long, place int, hash long, slots array<string>"


def template_windows(df: DataFrame, id_col: str, text_col: str, keep=None) -> DataFrame:
    """Distinct usable template windows of every text: id, text_key, place (of the
    first occurrence), hash, slots. A text that repeats a phrase ten thousand times
    gives one row for it, so a repetitive document and a repetitive item do not
    multiply in the join. ``keep`` is a broadcast bitmap over the top bits of the hash; windows outside
    it are left out. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        for whole in batches:
            for batch in slices(whole, "text"):
                doc, place, hashes, usable, slots = canonical.windows(texts_of(batch, "text"))
                at = np.flatnonzero(usable)
                if keep is not None:
                    at = at[in_bitmap(keep.value, hashes[at])]
                first: dict[tuple, int] = {}                 # a window that a text repeats counts where it first stands
                for i in at.tolist():
                    first.setdefault((doc[i], hashes[i], *slots(i)), i)
                at = np.fromiter(first.values(), np.int64, len(first))
                rows = pa.array(doc[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("text_key").take(rows), pa.array(place[at], pa.int32()),
                     pa.array(hashes[at].view(np.int64)), pa.array([slots(i) for i in at], pa.list_(pa.string()))],
                    ["id", "text_key", "place", "hash", "slots"])

    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_key"),
                     text.alias("text")).mapInArrow(run, _SCHEMA)


def consistent_places(windows) -> list[int]:
    """Item places of an alignment's windows that agree with its majority mapping.

    ``windows``: (place, [(value, item value), ...]) each. Value pairs are taken by
    the number of windows that hold them, equal values first among equals, as long
    as neither value is mapped yet. A window counts when all its pairs are in that
    mapping, or when all its values are the item's own; one without values always.
    """
    votes = Counter(pair for _, pairs in windows for pair in {(a, b) for a, b in pairs})
    ahead, back = {}, {}
    for a, b in sorted(votes, key=lambda p: (-votes[p], p[0] != p[1], p)):
        if a not in ahead and b not in back:
            ahead[a], back[b] = b, a
    return [place for place, pairs in windows
            if all(a == b for a, b in pairs) or all(ahead.get(a) == b for a, b in pairs)]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", min_coverage: float = MIN_COVERAGE, strict: bool = True) -> DataFrame:
    """One row per (document, benchmark item) leak: doc_id, text_key, item_id, matched,
    item_windows, coverage.

    matched counts the item's distinct windows found in the document along
    alignments whose placeholder values map one to one. An alignment with other
    pairs of values is left out as a whole when ``strict``; else it keeps the windows
    that agree with its majority mapping, have no slot or have the item's own values.
    A leak covers at least ``min_coverage`` of the item's usable windows. Windows span 8 template tokens
    of which 5 must be literal; an item without such a window (null, empty or very
    short text) cannot leak. Documents with null, empty or short texts have no
    leak. Equal rows give one result row; a null document id is reported as null
    with the text's key; benchmark items with equal ids count as one item.
    Either table may be empty. Only the named columns are read.

    The documents are scanned once; only windows that pass the bitmap of the
    benchmark's windows leave the map tasks, so the join moves about as many rows
    as there are real matches. A window that much of the corpus holds is split by
    the skew join, since the benchmark holds it only as often as its items do.
    """
    items = template_windows(benchmark, item_col, item_text_col).select(
        F.col("id").alias("item_id"), F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots")).distinct()
    found = template_windows(docs, id_col, text_col, hash_bitmap(items, "hash", FILTER_BITS))
    pairs = found.join(items, "hash").filter(F.size("slots") == F.size("item_slots"))
    aligned = (pairs.groupBy(F.col("id").alias("doc_id"), "text_key", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
               .agg(F.collect_set(F.struct(F.col("item_place").alias("place"), F.arrays_zip("slots", "item_slots").alias("pairs"))).alias("windows"))
               .withColumn("values", F.array_distinct(F.flatten("windows.pairs"))))
    one_to_one = ((F.size("values") == F.size(F.array_distinct(F.col("values.slots"))))
                  & (F.size("values") == F.size(F.array_distinct(F.col("values.item_slots")))))
    sizes = items.groupBy("item_id").agg(F.count_distinct("item_place").alias("item_windows"))
    if strict:
        kept = aligned.filter(one_to_one).withColumn("places", F.col("windows.place"))
    else:                                               # only inconsistent alignments go to Python
        none = F.array().cast(aligned.schema["windows"].dataType)
        some = F.udf(lambda windows: consistent_places(windows), "array<int>")(F.when(~one_to_one, F.col("windows")).otherwise(none))
        kept = (aligned.withColumn("places", F.when(one_to_one, F.col("windows.place")).otherwise(some))
                .filter(F.size("places") > 0))
    matched = (kept.groupBy("doc_id", "text_key", "item_id")
               .agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("matched")))
    return (matched.join(sizes, matched.item_id.eqNullSafe(sizes.item_id)).drop(sizes.item_id)
            .withColumn("coverage", F.round(F.col("matched") / F.col("item_windows"), 6))
            .filter(F.col("matched") >= min_coverage * F.col("item_windows")))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", min_coverage: float = MIN_COVERAGE,
                  strict: bool = True) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. Columns are unchanged;
    rows with a null id are matched by their text."""
    found = Scratch(docs.sparkSession, "leaks").store(
        leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, min_coverage, strict).select(
            F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key")).distinct(), "rows")
    same = (F.col(f"docs.`{id_col}`").cast("long").eqNullSafe(F.col("leak_id"))
            & (F.xxhash64(F.col(f"docs.`{text_col}`").cast("string")) == F.col("leak_key")))
    return anti_join(docs, F.xxhash64(F.col(f"`{text_col}`").cast("string")), found, "leak_key", same)
