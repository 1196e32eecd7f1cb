"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of distinct five-word shingles; documents are linked when
the Jaccard similarity of their sets reaches the threshold, and duplicates are
the connected components of the links.

Candidates come from trees. A node of a tree holds the documents that share the
minwise token of every coordinate chosen on the path to it; a node branches
into the values of two coordinates chosen by the path. Nodes of at most
``NODE_DOCS`` documents are compared exhaustively on their full sets. A pair of
similarity s survives a level with probability 1 - (1 - s)**2, and TREES
independent trees bring the miss of a pair at the threshold below one in 10**8.
Before full sets are fetched, the documents of a node are screened with sketches
of 256 further coordinates: a pair at the threshold agrees in 192 of them on
average, and in fewer than 150 with a probability below one in 10**8; a document
whose every pair does is not compared. Exact copies are one document to the trees.

Scale and skew:

* ids alone move until a node is known to hold more than one document, then 256
  bytes each; full sets are recomputed for the documents that pass the screen only;
* the first tree runs alone and finds the bulk of the components: its large nodes
  are dealt into chunks that share landmark documents;
* in the other trees a node whose documents are already in one component is
  closed, so a large group of near copies is compared once; of a node that is
  still too large, the few documents outside its main component are compared
  with all of its documents, in blocks, or it branches. No link between
  components is given up;
* no group of unbounded size meets in a task, and no link leaves the cluster.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, Scratch, anti_join, hash_bitmap, in_bitmap, slices
from .graph import components

SHINGLE_WORDS = 5
PERCENT = 75                # link when 100 * intersection >= PERCENT * union
TREES = 8                   # independent trees of two coordinates at the root
SPARE = 8                   # further coordinates that deeper levels choose from as well
NODE_DOCS = 1024            # a node of so many documents is compared exhaustively
SKETCH = 256                # coordinates of the screening sketch, 8 bits each
SKETCH_MATCHES = 150        # pairs that agree in fewer are not compared
LEVELS = 6                  # levels below the root after which a large node is compared in blocks
DENSE = 0.7                 # share of one child from which a node counts as not parting
LANDMARKS = 64
MEMO = 100_000

Store = Callable[[DataFrame, str], DataFrame]

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _coordinate_keys(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


class Shingler:
    """Shingle sets of texts as sorted 64-bit hashes; word hashes are remembered."""

    def __init__(self, size: int = SHINGLE_WORDS, memo: int = MEMO):
        self.size, self.memo, self.known = size, memo, {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Words split at ASCII white space after lower-casing A-Z; fewer than ``size``
        words are one shingle, no word is the empty set."""
        if len(self.known) > self.memo:
            self.known = {}
        known, out = self.known, []
        for text in texts:
            words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            out.append(self._hash(h))
        return out

    def _hash(self, words: np.ndarray) -> np.ndarray:
        if not len(words):
            return words
        width = min(self.size, len(words))
        n = len(words) - width + 1
        h = np.full(n, width, np.uint64)
        for k in range(width):
            h = (h ^ words[k:k + n]) * _MULTIPLIER
            h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return np.unique(h ^ (h >> np.uint64(32)))


def sketches(docs: DataFrame, id_col: str, text_col: str, store: Store) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the whole set; null for an empty one), the
    minwise token of every coordinate and the sketch. Map-only, written once."""
    paths = 2 * TREES + SPARE
    a, b = _coordinate_keys(paths + SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for whole in batches:
            for batch in slices(whole, "text"):
                keys, mins, sketch = [], [], []
                sets = shingler.sets(batch.column("text").to_pylist())
                for s in sets:
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    if not len(s):
                        mins.append(None)
                        sketch.append(None)
                        continue
                    # the least of each permutation, in blocks that stay in the cache
                    least = np.min([(s[i:i + 256, None] * a + b).min(axis=0) for i in range(0, len(s), 256)], axis=0)
                    mins.append(least[:paths].view(np.int64))
                    sketch.append((least[paths:] * _MULTIPLIER >> np.uint64(56)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(mins, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "mins", "sketch"])

    return store(_named(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, mins array<long>, sketch binary"), "sketches")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _full_sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame) -> DataFrame:
    """(id, shingles) of the documents in ``ids`` and a few more: a bitmap of 2 MB keeps
    the other texts from being shingled again; the join that follows is exact."""
    bitmap = hash_bitmap(ids.select(F.xxhash64("id").alias("h")), "h", FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for whole in batches:
            hashes = whole.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            whole = whole.filter(pa.array(in_bitmap(bitmap.value, hashes)))
            for batch in slices(whole, "text"):
                sets = shingler.sets(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["id", "shingles"])

    rows = _named(docs, id_col, text_col).filter("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    return rows.mapInArrow(run, "id long, shingles binary")


# ------------------------------------------------------------------- nodes

def _sized(nodes: DataFrame, labels: DataFrame | None, store: Store) -> DataFrame:
    """Rows (node, id, component, size) of nodes with at least two documents that are
    not all in one component."""
    if labels is not None:
        nodes = nodes.join(labels.select(F.col("id").alias("known"), "component"), F.col("id") == F.col("known"), "left").select(
            "node", "id", F.coalesce("component", "id").alias("component"))
    else:
        nodes = nodes.withColumn("component", F.col("id"))
    return _several(nodes, store)


def _several(nodes: DataFrame, store: Store) -> DataFrame:
    """Rows of the nodes that hold several components, with the node's size."""
    sizes = (nodes.groupBy(F.col("node").alias("n")).agg(F.count("*").alias("size"), F.min("component").alias("low"),
                                                       F.max("component").alias("high")).filter("low < high").select("n", "size"))
    return store(nodes.join(sizes, F.col("node") == F.col("n")).drop("n"), "nodes")


def _chunks(size: Column, docs: int) -> Column:
    return F.ceil(size / F.lit(docs)).cast("long")


def _with_landmarks(rows: DataFrame) -> DataFrame:
    """Chunks of a large node that all hold its landmarks, drawn by a hash."""
    n = _chunks(F.col("size"), NODE_DOCS // 2)
    drawn = F.pmod(F.xxhash64(F.lit(7), "node", "id"), F.lit(1 << 30)) * F.col("size") < F.lit(LANDMARKS << 30)
    own = F.array(F.pmod(F.xxhash64("node", "id"), n))
    return rows.select(F.explode(F.when(drawn, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(own)).alias("chunk"), "*").select(
        F.xxhash64("node", "chunk").alias("node"), "id", "component")


def _outside_main(rows: DataFrame) -> DataFrame:
    """Rows of large nodes with the node's largest component (``main``) and how many of its
    documents are outside it (``rest``)."""
    parts = rows.groupBy("node", "component").agg(F.count("*").alias("n"))
    main = parts.groupBy(F.col("node").alias("m")).agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                                     (F.sum("n") - F.max("n")).alias("rest"))
    return rows.join(main, F.col("node") == F.col("m")).drop("m")


def _rest_against_all(rows: DataFrame) -> DataFrame:
    """Blocks of the documents outside the main component, each with every chunk of the
    node's documents."""
    blocks, chunks = _chunks(F.col("rest"), NODE_DOCS), _chunks(F.col("size"), NODE_DOCS // 2)
    zero = F.lit(0).cast("long")
    member = rows.withColumn("chunk", F.pmod(F.xxhash64("node", "id"), chunks)).select(
        "node", "id", "component", "chunk", F.explode(F.sequence(zero, blocks - 1)).alias("block"))
    outside = rows.filter("component <> main").withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node", "id"), blocks)).select(
        "node", "id", "component", F.explode(F.sequence(zero, chunks - 1)).alias("chunk"), "block")
    return member.union(outside).select(F.xxhash64("node", "chunk", "block").alias("node"), "id", "component").distinct()


def _branch(large: DataFrame, mins: DataFrame, level: int, store: Store) -> tuple[DataFrame, DataFrame]:
    """(rows of the children, nodes that do not part)."""
    n = 2 * TREES + SPARE
    first = F.pmod(F.xxhash64(F.lit(level), "node"), F.lit(n)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.xxhash64(F.lit(level), F.lit("second"), "node"), F.lit(n - 1)), F.lit(n)).cast("int")
    rows = large.join(mins.select(F.col("id").alias("mid"), "mins"), F.col("id") == F.col("mid")).select(
        "node", "id", "component", "size",
        F.explode(F.array(*[F.struct(c.alias("c"), F.get(F.col("mins"), c).alias("v")) for c in (first, second)])).alias("x")).select(
        "node", "id", "component", "size", F.xxhash64("node", "x.c", "x.v").alias("child"), F.col("x.c").alias("c"))
    rows = store(rows, "children")
    sizes = rows.groupBy("node", "c", "child").agg(F.count("*").alias("docs"), F.first("size").alias("size"))
    dense = (sizes.groupBy("node", "c").agg((F.max("docs") >= DENSE * F.first("size")).alias("same"))
             .groupBy(F.col("node").alias("d")).agg(F.bool_and("same").alias("dense")).filter("dense").select("d"))
    dense = store(dense, "dense")
    return rows.join(dense, F.col("node") == F.col("d"), "left_anti").select(F.col("child").alias("node"), "id", "component"), dense


def _first_nodes(sized: DataFrame) -> DataFrame:
    """Nodes of bounded size for the first tree: small nodes whole, large ones in chunks
    that share landmarks. It finds the bulk of the components; the other trees lose
    nothing by what it misses."""
    small = sized.filter(F.col("size") <= NODE_DOCS).select("node", "id", "component")
    return small.union(_with_landmarks(sized.filter(F.col("size") > NODE_DOCS)))


def _small_nodes(sized: DataFrame, mins: DataFrame, store: Store) -> DataFrame:
    """Nodes of bounded size, (node, id, component), that cover every pair of documents of
    different components: small nodes whole; of large ones the few documents
    outside the main component with all; else their branches."""
    columns = ["node", "id", "component"]
    ready = []
    for level in range(LEVELS + 1):
        ready.append(sized.filter(F.col("size") <= NODE_DOCS).select(*columns))
        large = sized.filter(F.col("size") > NODE_DOCS)
        if large.isEmpty():
            break
        split = store(_outside_main(large), "nodes")
        last = F.lit(level == LEVELS)
        ready.append(_rest_against_all(split.filter((F.col("rest") <= NODE_DOCS) | last)))
        large = split.filter((F.col("rest") > NODE_DOCS) & ~last)
        if level == LEVELS or large.isEmpty():
            break
        children, dense = _branch(large.drop("main", "rest"), mins, level, store)
        ready.append(_rest_against_all(large.join(dense, F.col("node") == F.col("d"), "left_semi")))
        sized = _several(children, store)
    return functools.reduce(DataFrame.union, ready)


# ----------------------------------------------------------------- compare

def shared_counts(sets: list[np.ndarray], columns: int = 1024) -> np.ndarray:
    """Intersection sizes of all pairs of sorted sets, exact: an incidence matrix over the
    tokens that occur twice or more, multiplied in blocks of columns."""
    sizes = [len(s) for s in sets]
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    tokens, where, counts = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    often = counts[where] > 1
    owner, column = owner[often], number[where[often]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)      # exact: counts stay far below 2**24
    for begin in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        low, high = np.searchsorted(column, [begin, begin + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[owner[low:high], column[low:high] - begin] = 1
        out += m @ m.T
    return out.astype(np.int32)


def node_links(ids: np.ndarray, known: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (id, least id of its group) of a node: groups of documents connected by
    confirmed links between different components."""
    n = np.array([len(s) for s in sets])
    both = shared_counts(sets)
    linked = np.zeros(both.shape, bool)
    for i in range(len(sets)):
        linked[i] = (100 * both[i].astype(np.int64) >= percent * (n[i] + n - both[i])) & (known != known[i])
    del both
    order = np.argsort(ids, kind="stable")          # labels are ranks of ids, 4 bytes each
    label = np.empty(len(ids), np.int32)
    label[order] = np.arange(len(ids), dtype=np.int32)
    while True:
        new = np.array([min(own, label[row].min()) if row.any() else own for own, row in zip(label, linked, strict=True)], np.int32)
        if (new == label).all():
            return [(int(a), int(ids[order[b]])) for a, b in zip(ids, label, strict=True) if a != ids[order[b]]]
        label = new


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(node, [(id, component, bytes)]) of rows sorted by node, one node at a time."""
    node, held = None, []
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):     # few rows at a time become Python objects
            for own, *row in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns), strict=True):
                if own != node:
                    if held:
                        yield node, held
                    node, held = own, []
                held.append(tuple(row))
    if held:
        yield node, held


def screen(known: np.ndarray, sketches: np.ndarray, matches: int = SKETCH_MATCHES) -> np.ndarray:
    """Which documents of a node may be similar to one of another component."""
    agree = np.zeros((len(known), len(known)), np.int16)
    for k in range(sketches.shape[1]):
        agree += sketches[:, k, None] == sketches[None, :, k]
    return ((agree >= matches) & (known[:, None] != known[None, :])).any(axis=1)


def _screened(nodes: DataFrame, mins: DataFrame, store: Store) -> DataFrame:
    """Rows (node, id, component) of documents that have a candidate in their node."""
    rows = nodes.join(mins.select(F.col("id").alias("sid"), "sketch"), F.col("id") == F.col("sid")).select("node", "id", "component", "sketch")
    dealt = rows.repartition("node").sortWithinPartitions("node", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for node, held in _groups(batches):
            known = np.array([h[1] for h in held])
            keep = screen(known, np.stack([np.frombuffer(h[2], np.uint8) for h in held]))
            out += [(node, h[0], h[1]) for h, k in zip(held, keep, strict=True) if k]
            if len(out) >= 10_000:
                yield _columns(out, ["node", "id", "component"])
                out = []
        yield _columns(out, ["node", "id", "component"])

    return store(dealt.mapInArrow(run, "node long, id long, component long"), "candidates")


def _compare(nodes: DataFrame, sets: DataFrame, percent: int, store: Store) -> DataFrame:
    """Confirmed links (a, b) of all nodes."""
    rows = nodes.join(sets.withColumnRenamed("id", "sid"), F.col("id") == F.col("sid")).select("node", "id", "component", "shingles")
    dealt = rows.repartition("node").sortWithinPartitions("node", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, held in _groups(batches):
            out += node_links(np.array([h[0] for h in held]), np.array([h[1] for h in held]),
                              [np.frombuffer(h[2], np.uint64) for h in held], percent)
            if len(out) >= 10_000:
                yield _columns(out, ["a", "b"])
                out = []
        yield _columns(out, ["a", "b"])

    return store(dealt.mapInArrow(run, "a long, b long"), "links")


def _columns(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))], names)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Null, empty and blank texts have the empty set and are linked with nothing;
    shorter texts than five words are one shingle. A null id takes no part in
    linking: its component is null and it is kept. Repeated rows get equal results;
    a row that repeats an id with another text is judged by its own text (texts
    represented by one id count as linked). An empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    result, work = Scratch(spark, "near-duplicates"), Scratch(spark, "near-duplicate-nodes")
    found = sketches(docs, id_col, text_col, result.store)
    copies = work.store(found.filter("set_key is not null and doc_id is not null").groupBy("set_key")
                        .agg(F.min("doc_id").alias("id"), F.count("*").alias("n"),
                             F.min_by(F.struct("mins", "sketch"), "doc_id").alias("own")), "copies")
    mins = copies.select("id", "own.mins", "own.sketch")
    labels = links = None
    for trees in (range(1), range(1, TREES)):
        roots = mins.select("id", F.explode(F.array(*[
            F.xxhash64(F.lit(c), F.get("mins", F.lit(c))) for t in trees for c in (2 * t, 2 * t + 1)])).alias("node"))
        sized = _sized(roots, labels, work.store)
        nodes = _screened(_first_nodes(sized) if labels is None else _small_nodes(sized, mins, work.store), mins, work.store)
        ids = work.store(nodes.select("id").distinct(), "node-ids")
        if ids.isEmpty():
            continue
        new = _compare(nodes, _full_sets(docs, id_col, text_col, ids), percent, work.store)
        links = new if links is None else links.union(new)
        labels = components(links, work.store)
    target = copies.filter("n > 1").select("set_key", "id") if labels is None else copies.join(
        labels.withColumnRenamed("id", "known"), F.col("id") == F.col("known"), "left").filter("n > 1 or component is not null").select(
        "set_key", F.coalesce("component", "id").alias("id"))
    target = result.store(target.select(F.col("set_key").alias("k"), F.col("id").alias("target")), "components")
    work.remove()
    joined = found.join(target, F.col("set_key") == F.col("k"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("target", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, the one with the least id, and one
    of each set of rows that repeat both id and text. Rows with a null id stay.
    Columns are unchanged."""
    judged = Scratch(docs.sparkSession, "judged").store(
        near_duplicates(docs, id_col, text_col, percent).select("doc_id", "kept"), "rows")
    key = F.col(f"docs.`{id_col}`").cast("long")
    dropped = judged.filter("not kept").select(F.col("doc_id").alias("dropped_id"), F.xxhash64("doc_id").alias("dropped_key")).distinct()
    kept = anti_join(docs, F.xxhash64(F.col(f"`{id_col}`").cast("long")), dropped, "dropped_key", key == F.col("dropped_id"))
    repeated = judged.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(
        F.col("doc_id").alias("repeated_id"))
    if repeated.isEmpty():
        return kept
    key = F.col(f"kept.`{id_col}`").cast("long")
    once = kept.alias("kept").join(repeated, key == F.col("repeated_id"), "left_anti")
    again = kept.alias("kept").join(repeated, key == F.col("repeated_id"), "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(again)
