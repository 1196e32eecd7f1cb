"""Substring dedup: words inside long passages that repeat anywhere are removed.

A window is ``WINDOW`` consecutive words of one document. A word goes when a window
that covers it starts anywhere else too, in the same document or another one.

Method: suffix automata over reference shards; the documents' passages stream through
the automaton of their shard, and the matching statistics, capped at the window's
length, give the spans whose words go. The automata are not broadcast: what they hold
grows with the corpus. Instead the reference is sharded so that equal windows always
meet, and each automaton is built in the task where its passages arrive:

1. the anchor of a window is the least hash among its ``GRAM``-word sequences; equal
   windows have equal anchors. Anchors of all documents are counted; only windows
   whose anchor occurs twice can repeat. A bitmap of at most 32 MB keeps the others
   where they are (a full bitmap lets more through, it never loses a window).
2. neighbouring windows with one anchor form a passage, known by its hash; the
   occurrences of passages are counted, as two numbers each.
3. an anchor with more than ``HOT`` distinct passages (a phrase that a third of all rows
   share in their own contexts) does not gather them in one shard: its windows are
   passages of their own, keyed by the hash of all their words, and counted again.
4. a key with one passage that occurs twice or more is answered: all of it repeats. Of
   the other keys the tasks send every distinct passage's words once, and a shard holds
   all passages of its keys. Its suffix automaton, weighted with the occurrences, says
   for each window of a passage whether it occurs twice.
5. the answers (one bit a window) meet the places of the passages (a document's digest, a
   word number), and the documents with any are joined with theirs by digest; the other
   texts do not move.

Nothing is sampled or capped. Words are compared as words in the automata; 64-bit
hashes bring windows together and identify passages, documents are found by two.

Null, empty and blank texts have no words; nothing is removed from documents with fewer
words than a window. Repeated rows repeat each other's windows, whatever their ids, so
all their words in windows go. Extra columns pass through; columns named like an output
are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, hash_bitmap, in_bitmap, slices

WINDOW = 35                # words
GRAM = 12                  # words of an anchor
HOT = 1000                 # distinct passages of an anchor beyond which its windows are dealt by their own hash
PASSAGE_WINDOWS = 62       # windows of a passage at most: one bit each in a long
SHARD_WORDS = 250_000      # words of a shard on average
AUTOMATON_WORDS = 20_000   # keys of a shard share an automaton up to this size
HELD_PASSAGES = 500_000    # passages a task holds before it counts and sends them
MAX_BITS = 28

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = 64
_BYTES = np.random.default_rng(13).integers(0, 1 << 64, (_PLACES, 256), np.uint64).ravel()
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the rolling base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            bases = np.array([_BASE, _INVERSE], np.uint64).repeat(size).reshape(2, size)
            bases[:, 0] = 1
            self.up, self.down = np.cumprod(bases, axis=1)
        return self.up[:n], self.down[:n]


class Words:
    """The words of a slice of texts: where they lie, their documents, rolling hashes."""

    def __init__(self, texts: list[bytes], powers: _Powers):
        self.data = b" ".join(texts) + b" "
        raw = np.frombuffer(self.data, np.uint8)
        at = np.flatnonzero(~_BLANK[raw])
        first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        self.begin = at[first] if len(at) else at
        self.end = at[np.append(first[1:], len(at)) - 1] + 1 if len(at) else at
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.bounds = np.searchsorted(self.begin, starts)          # word number at which each text starts
        self.n = len(self.begin)
        if not self.n:
            return
        place = at - np.repeat(self.begin, np.diff(first, append=len(at)))
        value = _BYTES[((place % _PLACES) << 8) | raw[at]] * ((place // _PLACES).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        words = _mix(np.add.reduceat(value, first))
        up, self.down = powers.upto(self.n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:self.n])])

    def hashes(self, begin: np.ndarray, length) -> np.ndarray:
        """Hash of the ``length`` words from each place on."""
        return _mix((self.sums[begin + length] - self.sums[begin]) * self.down[begin])


def _slide(x: np.ndarray, width: int, fold) -> np.ndarray:
    """fold(x[i:i + width]) for every i, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = fold(x[:-step], x[step:])
        have += step
    return x


class Anchors:
    """Valid windows of a slice and their anchors."""

    def __init__(self, words: Words, window: int, gram: int):
        self.words, self.window, self.hot = words, window, None
        n = words.n - window + 1
        if n <= 0:
            self.at = np.zeros(0, np.int64)
            self.key = self.occurrences = np.zeros(0, np.uint64)
            return
        doc = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
        inside = doc[:n] == doc[window - 1:]
        grams = words.hashes(np.arange(words.n - gram + 1), gram)
        width = window - gram + 1
        least = _slide(grams, width, np.minimum)
        self.at = np.flatnonzero(inside)
        self.key = _mix(least[self.at] ^ _ODD)             # least values crowd at the low end: spread them again
        pad = np.zeros(width - 1, np.uint64)
        chosen = _slide(np.concatenate([pad, np.where(inside, least, np.uint64(0)), pad]), width, np.maximum)
        self.occurrences = _mix(grams[chosen == grams] ^ _ODD)          # one per place of an anchor

    def refine(self, hot: np.ndarray | None) -> np.ndarray:
        """Key windows of hot anchors by all their words; which ones those are."""
        if hot is None or not len(self.at):
            return np.zeros(len(self.at), bool)
        is_hot = in_bitmap(hot, self.key)
        self.key = self.key.copy()
        self.key[is_hot] = _mix(self.words.hashes(self.at[is_hot], self.window) * _ODD)
        self.hot = is_hot
        return is_hot

    def passages(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first word, windows, key, hash) of the runs of windows whose key may repeat."""
        may = in_bitmap(repeated, self.key) if len(self.at) else np.zeros(0, bool)
        at, key = self.at[may], self.key[may]
        if not len(at):
            return at, at, key, key
        fresh = np.ones(len(at), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (np.diff(at) != 1)
        if self.hot is not None:
            fresh |= self.hot[may]                       # each a passage of its own
        run = np.flatnonzero(fresh)
        place = np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))
        first = np.flatnonzero(place % PASSAGE_WINDOWS == 0)
        n = np.diff(first, append=len(at))
        return at[first], n, key[first], self.words.hashes(at[first], n + self.window - 1)


class SuffixAutomaton:
    """Suffix automaton of several word sequences with weighted occurrence counts."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the shorter strings that reach it from ``p`` by ``c``."""
        copy = self._state(self.length[p] + 1, self.next[q].copy(), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int], weight: int) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                p = last
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][c]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
                last = new
            self.count[last] += weight

    def finish(self) -> None:
        """Give every state the occurrences of the longer strings that end with its own."""
        for s in np.argsort(self.length, kind="stable")[:0:-1].tolist():
            self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence: list[int], window: int) -> int:
        """One bit per window of a sequence: whether the window occurs twice. The matching
        statistic is kept at ``window`` words by moving up the suffix links."""
        step, link, length = self.next, self.link, self.length
        state = matched = bits = 0
        for i, c in enumerate(sequence):
            while state and c not in step[state]:
                state = link[state]
                matched = length[state]
            if c in step[state]:
                state, matched = step[state][c], matched + 1
            if matched >= window:
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
                if self.count[state] > 1:
                    bits |= 1 << (i - window + 1)
        return bits


def shard_answers(passages: Iterator[tuple[int, int, int, bytes | None]], window: int) -> Iterator[tuple[int, int, int]]:
    """(key, passage, bits) of the passages with a window that occurs twice, from the
    (key, passage, occurrences, words) of a shard; counts and words may come in rows of
    their own. Keys of one passage that occurs twice are left out."""
    groups: dict[int, dict[int, list]] = {}
    for key, passage, n, words in passages:
        held = groups.setdefault(key, {}).setdefault(passage, [0, None])
        held[0] += n or 0
        held[1] = words or held[1]
    waiting, size = [], 0
    for key, members in groups.items():
        if len(members) == 1 and next(iter(members.values()))[0] > 1:
            continue
        waiting += [(key, passage, n, words) for passage, (n, words) in members.items()]
        size += sum(len(words) for _, words in members.values()) // 6
        if size > AUTOMATON_WORDS:
            yield from _match(waiting, window)
            waiting, size = [], 0
    if waiting:
        yield from _match(waiting, window)


def _match(members: list[tuple[int, int, int, bytes]], window: int) -> Iterator[tuple[int, int, int]]:
    ids: dict[bytes, int] = {}
    automaton = SuffixAutomaton()
    sequences = [[ids.setdefault(w, len(ids)) for w in words.split(b" ")] for _, _, _, words in members]
    for (_, _, n, _), sequence in zip(members, sequences):
        automaton.add(sequence, n)
    automaton.finish()
    for (key, passage, _, _), sequence in zip(members, sequences):
        bits = automaton.repeated(sequence, window)
        if bits:
            yield key, passage, bits


# --------------------------------------------------------------------- Spark

def _digest(text_col: str) -> list:
    return [F.xxhash64(F.col(text_col)).alias("doc_a"), F.xxhash64(F.lit(13), F.col(text_col)).alias("doc_b")]


def _anchors(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[tuple[pa.RecordBatch, Anchors]]:
    powers = _Powers()
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            yield batch, Anchors(Words(texts, powers), window, gram)


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _bits(n: int) -> int:
    return min(max(16, int(n).bit_length() + 4), MAX_BITS)


def _tally(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, passage, occurrences) of the distinct passages among the held ones."""
    key, passage, n = (np.concatenate(c) for c in zip(*held))
    one, where, of = np.unique(passage, return_index=True, return_inverse=True)
    return key[where], one, np.bincount(of, weights=n).astype(np.int64)


ALL = -1                   # the answer "every window of the passage"


def repeated_spans(docs: DataFrame, text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """Where windows of the texts repeat: ``doc_a, doc_b`` (two 64-bit digests of the
    text), ``spans`` (array of (start: word number, bits: one for each of the windows
    that start there and at the following words)). One row per text with any."""
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter(F.length("text") >= 2 * window - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _anchors(batches, window, gram):
            key, n = np.unique(found.occurrences, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(key), pa.array(n, pa.int64())], ["key", "n"])

    repeated = scratch.store(texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
                             .filter("n > 1").select("key"), "anchors")
    bitmap = hash_bitmap(repeated, "key", _bits(repeated.count()))

    def tally(batches: Iterator[pa.RecordBatch], hot_bits=None) -> Iterator[pa.RecordBatch]:
        """Occurrences of passages; with ``hot_bits`` of the windows of those anchors."""
        held, size = [], 0
        for _, found in _anchors(batches, window, gram):
            if hot_bits is None:
                _, _, key, passage = found.passages(bitmap.value)
            else:
                is_hot = found.refine(hot_bits.value)
                key, passage = found.key[is_hot], found.words.hashes(found.at[is_hot], window) if is_hot.any() else found.key[:0]
            held.append((key, passage, np.ones(len(key), np.int64)))
            size += len(key)
            if size > HELD_PASSAGES:
                held = [_tally(held)]
                size = len(held[0][0])
                if size > HELD_PASSAGES // 2:
                    yield rows(*held.pop())
                    size = 0
        if held:
            yield rows(*_tally(held))

    def rows(key: np.ndarray, passage: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_signed(key), _signed(passage), pa.array(n)], ["key", "passage", "n"])

    def counted(run, name: str) -> DataFrame:
        return scratch.store(texts.mapInArrow(run, "key long, passage long, n long")
                             .groupBy("key", "passage").agg(F.sum("n").alias("n")), name)

    passages = counted(tally, "passages")
    per_key = scratch.store(passages.groupBy("key").agg(F.count(F.lit(1)).alias("passages"), F.sum("n").alias("n"), F.min("passage").alias("passage"))
                            .join(repeated, "key", "left_semi"), "keys")          # without what the bitmap let through
    hot_keys = per_key.filter(F.col("passages") > hot)
    n_hot, hot_bits = hot_keys.count(), None
    answered = []
    if n_hot:
        hot_bits = hash_bitmap(hot_keys, "key", _bits(n_hot))

        @F.pandas_udf("boolean")
        def is_hot(h):
            return h.__class__(in_bitmap(hot_bits.value, h.to_numpy(np.int64).view(np.uint64)))

        passages, per_key = passages.filter(~is_hot("key")), per_key.filter(~is_hot("key"))
        answered.append(counted(lambda b: tally(b, hot_bits), "hot-windows").filter("n > 1").select("key", "passage"))
    answered.append(per_key.filter("passages = 1 AND n > 1").select("key", "passage"))
    open_keys = per_key.filter("passages > 1 OR n = 1").select("key")
    live = per_key.select("key") if not n_hot else per_key.select("key").unionByName(answered[0].select("key"))
    live_bits = hash_bitmap(live, "key", _bits(live.count()))
    open_bits = hash_bitmap(open_keys, "key", _bits(open_keys.count()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every place of a passage, and one with the words of each passage to match."""
        names = ["doc_a", "doc_b", "start", "windows", "key", "passage", "words"]
        sent: set[int] = set()
        seen: set[tuple[int, int]] = set()
        for batch, found in _anchors(batches, window, gram):
            found.refine(hot_bits.value if hot_bits else None)
            first, n, key, passage = found.passages(live_bits.value)
            if not len(first):
                continue
            words = found.words
            if len(sent) > HELD_PASSAGES:
                sent.clear()
            _, where = np.unique(passage, return_index=True)
            where = [i for i in where[in_bitmap(open_bits.value, key[where])].tolist() if int(passage[i]) not in sent]
            sent.update(passage[where].tolist())
            text = [b" ".join(words.data[words.begin[first[i]]:words.end[first[i] + n[i] + window - 2]].split()) for i in where]
            none = pa.nulls(len(where), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(where), pa.int32()), pa.nulls(len(where), pa.int32()),
                                              _signed(key[where]), _signed(passage[where]), pa.array(text, pa.binary())], names)
            doc = np.searchsorted(words.bounds, first, side="right") - 1
            a, b = (batch.column(c).to_numpy() for c in ("doc_a", "doc_b"))
            new = np.zeros(len(a), bool)
            for d in np.unique(doc).tolist():          # a text met before in this task has its places known
                k = (int(a[d]), int(b[d]))
                if k not in seen:
                    seen.add(k)
                    new[d] = True
            if len(seen) > 500_000:
                seen.clear()
            at = new[doc]
            doc, first, n, key, passage = doc[at], first[at], n[at], key[at], passage[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[doc], pa.int64()), pa.array(b[doc], pa.int64()), pa.array(first - words.bounds[doc], pa.int32()),
                 pa.array(n, pa.int32()), _signed(key), _signed(passage), pa.nulls(len(doc), pa.binary())], names)

    cuts = scratch.store(texts.select(*_digest("text"), "text").mapInArrow(
        cut, "doc_a long, doc_b long, start int, windows int, key long, passage long, words binary"), "places")

    @F.pandas_udf("boolean")
    def is_open(h):
        return h.__class__(in_bitmap(open_bits.value, h.to_numpy(np.int64).view(np.uint64)))

    to_match = (cuts.filter("words IS NOT NULL").select("key", "passage", F.lit(0).cast("long").alias("n"), "words")
                .unionByName(passages.filter(is_open("key")).withColumn("words", F.lit(None).cast("binary"))))
    size = cuts.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = 1 + size // (6 * SHARD_WORDS)

    def answer(shard: pa.Table) -> pa.Table:
        members = zip(*(shard.column(c).to_pylist() for c in ("key", "passage", "n", "words")))
        key, passage, bits = zip(*found) if (found := list(shard_answers(members, window))) else ((), (), ())
        return pa.table([pa.array(key, pa.int64()), pa.array(passage, pa.int64()), pa.array(bits, pa.int64())],
                        names=["key", "passage", "bits"])

    answers = scratch.store(to_match.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
                            .groupBy("shard").applyInArrow(answer, "key long, passage long, bits long"), "answers")
    for rest in answered:
        answers = answers.unionByName(rest.withColumn("bits", F.lit(ALL).cast("long")))
    places = cuts.filter("words IS NULL").drop("words").join(answers, ["key", "passage"])
    whole = F.expr("shiftleft(1L, windows) - 1L")
    return scratch.store(
        places.withColumn("bits", F.col("bits").bitwiseAND(whole)).groupBy("doc_a", "doc_b")
        .agg(F.collect_set(F.struct("start", "bits")).alias("spans")), "spans")


def without_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_removed`` (words in repeated windows) and
    ``kept_text`` (the other words, joined by one space)."""
    spans = repeated_spans(docs, text_col, window, **options)
    bitmap = hash_bitmap(spans, "doc_a", _bits(spans.count()))
    out = ["n_words", "n_removed", "kept_text"]
    rest = [c for c in docs.columns if c not in out]
    own = docs.withColumn(text_col, F.col(text_col).cast("string")).select(F.struct(*rest).alias("row"), *_digest(text_col))

    @F.pandas_udf("boolean")
    def maybe(h):
        return h.__class__(in_bitmap(bitmap.value, h.to_numpy(np.int64).view(np.uint64)))

    hit = maybe("doc_a")
    no_spans = F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    both = (own.filter(hit).join(spans, ["doc_a", "doc_b"], "left").select("row", "spans")
            .unionByName(own.filter(~hit).select("row", no_spans)))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = pc.struct_field(whole.column("row"), text_col)
            for batch in slices(pa.RecordBatch.from_arrays([*whole.columns, texts], ["row", "spans", "text"]), "text"):
                n_words, n_removed, kept = [], [], []
                for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    n_words.append(len(words))
                    if found:
                        steps = np.zeros(len(words) + 1, np.int32)
                        for span in found:
                            start, bits = span["start"], span["bits"]
                            while bits:
                                i = start + (bits & -bits).bit_length() - 1
                                steps[i] += 1
                                steps[i + window] -= 1
                                bits &= bits - 1
                        stay = (np.cumsum(steps[:-1]) == 0).tolist()
                        words = [w for w, s in zip(words, stay) if s]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                                  pa.array(kept, pa.string())], ["row", *out])

    schema = f"row {both.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept_text string"
    return both.mapInArrow(remove, schema).select("row.*", *out)
