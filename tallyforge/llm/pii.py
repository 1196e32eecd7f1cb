"""Personal data: base patterns plus a character BiLSTM-CRF tagger.

The base patterns find e-mail addresses, IP addresses, payment cards and phone
numbers in their usual forms. A tagger trained on those spans (labelled spans
of the corpus, and the same values written in other forms) adds occurrences the
patterns miss: addresses with spaces or words for their signs or letters outside
ASCII, IP addresses with spaces, brackets or words for their dots, cards with
other separators, phones without the plus sign. Every text is covered by
overlapping windows; the windows are decoded one by one and the spans found in
them are reconciled over the whole text.

An added span must pass the check of its kind once such forms are undone. Whatever
passes holds an ASCII digit, an at sign, or the word "at" before a label and a dot in
any of its forms (``_CUE``). Windows without such a cue contribute nothing, so the spans
are those of decoding every window of every text, and only windows with one are decoded
(a test holds the two against each other). A span that no window holds whole is decoded in a window as wide as it
needs, so spans of any length are found.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling
from .common import SLICE_BYTES, runs, slices, texts_of
from .lstm_crf import Tagger, train

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 32     # spans of less than WINDOW - STRIDE characters lie whole in some window
TRAIN_DOCS = 1500           # documents the training windows come from, at most
TRAIN_WINDOWS = 3600        # windows trained on, at most
RESPELLED = 3               # other forms of each value that training sees
EPOCHS, BATCH, RATE = 10, 64, 0.02
DECODED = 512               # windows that are decoded together: bounds a worker's memory
MIN_SURE = 0.9              # least marginal probability along an added span
TRIGGER = r"[0-9@]|\b[dD][oO][tT]\b|[(\[{] ?[aA][tT] ?[)\]}]"     # what training windows are drawn around

_TRIGGER = re.compile(TRIGGER)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a try from inside a run of digits fails like the one from its start; without the
# look-behind a long run would cost its length squared
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


class Span(NamedTuple):
    """A span in code points, end exclusive."""

    start: int
    kind: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """The e-mail pattern, searched from its at signs: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield Span(start, 0, done := m.end())
        at = text.find("@", max(at + 1, done))


def valid(kind: int, value: str) -> bool:
    """The check of a kind: octets at most 255; Luhn over 12 to 19 digits; 9 to 15 digits."""
    if kind == 0:
        return True
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in value.split("."))
    digits = _NOT_DIGIT.sub("", value)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns: leftmost and non-overlapping within a kind, those
    failing their check dropped without another try; by start, then kind."""
    if not _TRIGGER.search(text):
        return []
    found = list(_emails(text))
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        found += [Span(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return sorted(found)


# ------------------------------------------------------------------- tagger

_CLASSES = 100
_ASCII = np.full(128, 99, np.int64)
_ASCII[32:127] = np.arange(1, 96)
_ASCII[[9, 10, 13]] = 96


def _classes(text: str) -> np.ndarray:
    """Character classes: printable ASCII apart, line breaks, other letters, the rest; 0 pads."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _ASCII[np.minimum(codes, 127)], np.where(codes >= 192, 97, 99))


def _tag_rules() -> tuple[np.ndarray, np.ndarray]:
    """Inside tags (2, 4, ..) only follow a beginning (1, 3, ..) or inside of their kind."""
    n = 1 + 2 * len(KINDS)
    allowed, first = np.ones((n, n), bool), np.ones(n, bool)
    for inside in range(2, n, 2):
        allowed[:, inside] = False
        allowed[[inside - 1, inside], inside] = True
        first[inside] = False
    return allowed, first


def new_tagger(seed: int = 0) -> Tagger:
    allowed, first = _tag_rules()
    return Tagger(_CLASSES, 1 + 2 * len(KINDS), allowed, first, seed=seed)


def _tags(n: int, spans: list[Span]) -> np.ndarray:
    tags, end = np.zeros(n, np.int64), 0
    for s in spans:
        if s.start >= end:
            tags[s.start] = 1 + 2 * s.kind
            tags[s.start + 1:s.end] = 2 + 2 * s.kind
            end = s.end
    return tags


# Forms of signs that the base patterns miss.
_AT = (" @ ", " (at) ", " [at] ", " at ", "(at)", "[at]", " @", "@ ")
_DOT = (" dot ", " (dot) ", " [dot] ", "[.]", " . ", "(dot)", "(.)")

_WORDS = ((" (at) ", " dot "), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" (at) ", "."))


def _respell(text: str, span: Span, rng: np.random.Generator) -> str:
    """A value in a form that the base patterns miss: other signs, other digits or letters."""
    value = text[span.start:span.end]

    def pick(options):
        return options[int(rng.integers(len(options)))]

    if span.kind == 0:
        local, _, domain = value.partition("@")
        form = int(rng.integers(6))
        words = text[max(0, span.start - 200):span.start + 200].split()

        def name(other: str) -> str:                       # names in the corpus's letters
            word = "".join(c for c in pick(words) if c.isalpha() and c.isascii())[:10].lower()
            return word or other

        if rng.integers(4):
            local = name(local) + pick(("", "", "." + name("a"), "_" + name("b"), str(rng.integers(100))))
        if rng.integers(4):
            domain = name("mail") + pick(("", "", "." + name("c"), "-" + name("d"))) + pick((".com", ".org", ".net", ".de", ".fr", ".io"))
        if form == 0:                                      # letters outside ASCII, plain signs
            at = int(rng.integers(len(local)))
            return local[:at] + pick("éüñöàçøß") + local[at:] + "@" + domain
        if form == 1:                                      # spaces around the at sign only
            return local + pick(_AT[:1] + _AT[6:]) + domain
        at, dot = pick(_WORDS) if rng.integers(4) else (pick(_AT), pick(_DOT))
        return local + at + domain.replace(".", dot)
    digits = "".join(str(rng.integers(10)) for _ in range(24))
    if span.kind == 1:
        parts = [str(int(rng.integers(256))) for _ in range(4)] if rng.integers(2) else value.split(".")
        return pick(_DOT + (". ", " .")).join(parts)
    if span.kind == 2:
        own = digits[:16] if rng.integers(2) else _NOT_DIGIT.sub("", value)
        return pick((".", "  ", "/", " - ", "_", ". ", " . ")).join(own[i:i + 4] for i in range(0, len(own), 4))
    form = int(rng.integers(5))
    if form == 0:
        return f"{pick(('', '1-', '1 ', '0'))}({digits[:3]}){pick(('-', ' ', '', '.'))}{digits[3:6]}{pick('-. ')}{digits[6:10]}"
    if form == 1:
        sign = pick(".- ")
        return pick(("", "1" + sign)) + sign.join((digits[:3], digits[3:6], digits[6:10]))
    if form == 2:
        return f"0{digits[:pick((2, 3, 4))]}{pick('/- ')}{digits[5:pick((11, 12, 13))]}"
    own = "".join(digits[k % 24] if c.isdigit() else c for k, c in enumerate(value)).lstrip("+")
    return own.replace(" ", pick(("-", ".", " ")))


def training_windows(text: str, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around triggers with their tags: every span as it is and in ``RESPELLED``
    other forms, some triggers outside of spans, and a window anywhere."""
    out, spans = [], base_spans(text)
    flat = [s for k, s in enumerate(spans) if not any(o.start < s.end and s.start < o.end for o in spans[:k])]

    def cut(t: str, own: list[Span], centre: int) -> None:
        begin = max(0, centre - int(rng.integers(WINDOW // 4, 3 * WINDOW // 4)))
        end = begin + WINDOW
        inside = [Span(s.start - begin, s.kind, s.end - begin) for s in own if s.start >= begin and s.end <= end]
        if any(s.start < end and s.end > begin and not (s.start >= begin and s.end <= end) for s in own):
            return                                     # a span reaches over the window's edge
        part = _classes(t[begin:end])
        chars, tags = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        chars[:len(part)] = part
        tags[:len(part)] = _tags(len(part), inside)
        out.append((chars, tags))

    for s in flat:
        cut(text, flat, s.start)
        for _ in range(RESPELLED):
            new = _respell(text, s, rng)
            shift = len(new) - (s.end - s.start)
            near = max(0, s.start - WINDOW)                # a window's surroundings only: long texts are not copied
            changed = text[near:s.start] + new + text[s.end:s.end + WINDOW]
            moved = [Span(o.start + shift * (o.start > s.start) - near, o.kind, o.end + shift * (o.start >= s.start) - near) for o in flat]
            cut(changed, moved, s.start - near)
    covered = _tags(len(text), flat) > 0
    others = [m.start() for m in _TRIGGER.finditer(text) if not covered[m.start()]]
    for at in others[:: max(1, len(others) // 2)][:2]:
        cut(text, flat, at)
    if len(text) > WINDOW:
        cut(text, flat, int(rng.integers(len(text))))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs_limit: int = TRAIN_DOCS,
        windows_limit: int = TRAIN_WINDOWS) -> Tagger:
    """Train on windows of at most ``docs_limit`` documents that hold a trigger
    character, drawn by a hash of the id; the driver receives ``windows_limit``
    windows of ``WINDOW`` characters at most. Without any window the tagger is untrained
    and is returned with no parameters in use (see ``Finder``)."""
    has = docs.filter(F.col(text_col).cast("string").rlike(TRIGGER) & F.col(id_col).isNotNull())
    ids = sampling.drawn(has.select(F.col(id_col).cast("long").alias("doc_id")), docs_limit, seed=8)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, c.astype("<i2").tobytes(), t.astype("<i2").tobytes())
                    for d, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"), strict=True)
                    for c, t in training_windows(text, np.random.default_rng(d & 0xFFFFFFFF))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.binary())], ["doc_id", "chars", "tags"])

    found = sampling.with_texts(ids, docs, id_col, text_col).mapInArrow(windows, "doc_id long, chars binary, tags binary")
    rows = sampling.drawn(found.distinct(), windows_limit, seed=8).toPandas().sort_values(["doc_id", "chars"], kind="stable")
    tagger = new_tagger()
    if len(rows):
        chars = np.stack([np.frombuffer(c, "<i2") for c in rows["chars"]]).astype(np.int64)
        tags = np.stack([np.frombuffer(t, "<i2") for t in rows["tags"]]).astype(np.int64)
        train(tagger, chars, tags, EPOCHS, BATCH, RATE)
    return tagger


# ---------------------------------------------------------------- detection

# Forms of an at sign or a dot, undone before the check of a kind.
_SIGN = re.compile(r"\s*[(\[{]\s*(at|dot|\.|@)\s*[)\]}]\s*|\s+(at|dot)\s+|\s*([@.])\s*", re.IGNORECASE)


def _plain(value: str) -> str:
    return _SIGN.sub(lambda m: {"at": "@", "dot": "."}.get(s := next(g for g in m.groups() if g).lower(), s), value)


_ADDED_CHECKS = (
    lambda v: bool(re.fullmatch(r"[^\s@()<>\[\],;:]+@[^\W_]([\w-]*[^\W_])?(\.[^\W_]([\w-]*[^\W_])?)+", _plain(v))),
    lambda v: bool(re.fullmatch(r"[0-9]+(\.[0-9]+){3}", p := _plain(v))) and valid(1, p),
    lambda v: bool(re.fullmatch(r"[0-9]([\x20._/-]{0,3}[0-9])+", v)) and valid(2, v),
    lambda v: bool(re.fullmatch(r"[+(]?[0-9][0-9\x20()./-]*[0-9]", v)) and valid(3, v),
)


# Something that every value passing a check holds: IP addresses, cards and phones a digit;
# an e-mail address an at sign or the word "at" (bracketed, or between blanks) with a label
# and a dot, the word "dot" or a bracketed one behind it, as ``_SIGN`` undoes them.
_CUE = re.compile(r"[0-9@]|(?<![^\s(\[{])at(?=(?:\s*+[)\]}]\s*+|\s++)[\w-]++(?:\s*+\.|\s++dot\s|\s*+[(\[{]\s*+(?:dot|\.)))", re.IGNORECASE)


def _may_grow(kind: int, part: str) -> bool:
    """Whether a value that holds ``part`` can pass the check of its kind: keeps windows
    from growing along runs that no longer can."""
    if kind == 0:
        return _plain(part).count("@") <= 1
    if kind == 1:
        groups = _plain(part).split(".")
        return len(groups) <= 4 and all(len(g.lstrip("0")) <= 3 for g in groups)
    return len(_NOT_DIGIT.sub("", part)) <= (19 if kind == 2 else 15)


class Finder:
    """Finds spans in texts with a trained tagger; windows of a slice are decoded together."""

    def __init__(self, tagger: Tagger, min_sure: float = MIN_SURE):
        self.tagger, self.min_sure = tagger, min_sure

    def starts(self, cues: list[int]) -> list[int]:
        """Where the windows that hold one of the cues start."""
        return sorted({w for c in cues for w in range(max(0, (c - WINDOW) // STRIDE * STRIDE + STRIDE), c // STRIDE * STRIDE + 1, STRIDE)})

    def find(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """(base spans, added spans) of every text."""
        base = [base_spans(t) for t in texts]
        cues = [[m.start() for m in _CUE.finditer(t)] for t in texts]
        places = [(k, w) for k, own in enumerate(cues) for w in self.starts(own)]
        votes: list[dict[Span, float]] = [{} for _ in texts]
        cut: list[list[Span]] = [[] for _ in texts]
        for at in range(0, len(places), DECODED):
            own = places[at:at + DECODED]
            windows = np.zeros((len(own), WINDOW), np.int64)
            for i, (k, w) in enumerate(own):
                row = _classes(texts[k][w:w + WINDOW])
                windows[i, :len(row)] = row
            paths, sure = self.tagger.decode(windows)
            for i in np.flatnonzero(paths.any(axis=1)):
                k, w = places[at + i]
                cut[k] += self._collect(texts[k], w, paths[i], sure[i], votes[k])
        for k, parts in enumerate(cut):
            if parts := [s for s in parts if (i := bisect.bisect_left(cues[k], s.start)) < len(cues[k]) and cues[k][i] < s.end]:
                self._widen(texts[k], parts, votes[k])
        return [(b, self._reconcile(t, b, v)) for t, b, v in zip(texts, base, votes, strict=True)]

    @staticmethod
    def _runs(path: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first, end, kind) of the spans of a path."""
        for s in np.flatnonzero(path % 2 == 1).tolist():
            e = s + 1
            while e < len(path) and path[e] == path[s] + 1:
                e += 1
            yield s, e, int(path[s]) // 2

    def _collect(self, text: str, w: int, path: np.ndarray, sure: np.ndarray, votes: dict[Span, float]) -> list[Span]:
        """Votes for the spans of a window; returns the parts, cut by its edges, of spans that
        no other window holds whole either."""
        parts = []
        for s, e, kind in self._runs(path):
            span = Span(w + s, kind, w + e)
            left, right = s == 0 and w > 0, e == WINDOW and w + WINDOW < len(text)
            if left or right:                          # another window holds the shorter ones whole
                if (left and right) or (s <= STRIDE if right else e >= WINDOW - STRIDE):
                    parts.append(span)
            elif (p := float(sure[s:e].min())) >= self.min_sure:
                votes[span] = votes.get(span, 0.0) + p
        return parts

    def _widen(self, text: str, parts: list[Span], votes: dict[Span, float]) -> None:
        """Votes for the long spans around ``parts``: a window over each run of parts that
        overlap grows on the sides where it cuts a span. Time and memory follow the span."""
        done = 0
        for part in sorted(parts):
            if part.start < done or not _may_grow(part.kind, text[part.start:part.end]):
                continue
            begin, end = max(0, part.start - WINDOW), min(len(text), part.end + WINDOW)
            while True:
                path, sure = (x[0] for x in self.tagger.decode(_classes(text[begin:end])[None]))
                own = [(s, e, kind) for s, e, kind in self._runs(path) if begin + s < part.end and part.start < begin + e]
                grow = [(s, e) for s, e, kind in own if _may_grow(kind, text[begin + s:begin + e])]
                left = begin > 0 and any(s == 0 for s, _ in grow)
                right = end < len(text) and any(e == len(path) for _, e in grow)
                if not (left or right):
                    break
                size = end - begin
                begin, end = max(0, begin - size * left), min(len(text), end + size * right)
            for s, e, kind in own:
                done = max(done, begin + e)
                cut = (s == 0 and begin > 0) or (e == len(path) and end < len(text))
                if not cut and e - s >= WINDOW - STRIDE and (p := float(sure[s:e].min())) >= self.min_sure:
                    votes.setdefault(Span(begin + s, kind, begin + e), p)

    @staticmethod
    def _reconcile(text: str, base: list[Span], votes: dict[Span, float]) -> list[Span]:
        """Of the spans of all windows: those that pass the checks of their kind and touch
        no base span, unless they extend one of their kind; where they overlap, the ones
        with the most votes, then longest, then first."""
        taken = list(base)

        def fits(span: Span, k: int) -> bool:
            o = taken[k]
            extends = k < len(base) and o.kind == span.kind and span.start <= o.start and o.end <= span.end and o != span
            return extends or span.end <= o.start or o.end <= span.start

        for span in sorted(votes, key=lambda s: (-votes[s], s.start - s.end, s)):
            free = all(fits(span, k) for k in range(len(taken)))
            if free and span.end <= len(text) and _ADDED_CHECKS[span.kind](text[span.start:span.end]):
                taken.append(span)
        return sorted(taken[len(base):])


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def find_spans(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 (of the
    base spans as kind:start:end), spans (base and added), n_added.

    Whole texts; null counts as empty and gives zeros, the digest of the empty
    string and empty spans. Null and repeated ids are ordinary rows; other columns
    are ignored; an empty table gives no rows. Map-only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                found = finder.find(texts_of(batch, "text"))
                counts = [pa.array([sum(s.kind == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                digests = [hashlib.sha256(span_text(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *counts, pa.array(digests, pa.string()),
                     pa.array([span_text([*base, *added]) for base, added in found], pa.string()),
                     pa.array([len(added) for _, added in found], pa.int64())],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets (spans that
    overlap are replaced together, by the kind of the first)."""
    out, at = [], 0
    for s in sorted(spans):
        if s.start >= at:
            out += [text[at:s.start], f"<{KINDS[s.kind].upper()}>"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; null texts stay null. Rows
    and all other columns are unchanged. Map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(shared.value)
        for texts in batches:
            own = [t if isinstance(t, str) else None for t in texts]
            found = itertools.chain.from_iterable(finder.find(part) for part in runs([t or "" for t in own], SLICE_BYTES))
            yield pd.Series([None if t is None else redact_text(t, [*b, *a]) for t, (b, a) in zip(own, found, strict=True)], dtype=object)

    return docs.withColumn(text_col, clean(F.col(f"`{text_col}`").cast("string")))
