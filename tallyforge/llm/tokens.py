"""Token counts with a whole-token shortcut.

Byte-pair encoding works on pre-tokens. A vocabulary string that is a whole
pre-token and encodes alone as exactly one token costs one token wherever it
occurs; ``proven_whole`` establishes that set offline by encoding every
vocabulary string. Counting is then one table lookup per pre-token, and only
pre-tokens outside the table are merged, once per distinct string in a worker's
memo.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of

# Pre-tokens of the word-level vocabulary (fixed values of its file).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = re.compile(r"<\|startoftext\|>|<\|endoftext\|>")
WORD_END = "</w>"
# Distinct merged pre-tokens a worker remembers; the memo starts over beyond it.
MEMO = 200_000

_ASCII = re.compile(PRE_TOKEN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"), re.ASCII)
_ANY = regex.compile(PRE_TOKEN)


def normalise(text: str) -> str:
    """NFC and per-character lower case, as the vocabulary's normaliser does (white
    space only separates pre-tokens, so its folding needs no step of its own)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no final-sigma rule


def pre_tokens(text: str) -> list[str]:
    text = normalise(text)
    return _ASCII.findall(text) if text.isascii() else _ANY.findall(text)


@functools.lru_cache(maxsize=2)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def proven_whole(path: str) -> frozenset[str]:
    """Vocabulary strings proven to be one pre-token and to encode alone as one
    token. Bounded by the vocabulary; computed once per worker process."""
    tok = load(path)
    to_char = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    to_char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in to_char.values())}
    words = []
    for entry in tok.get_vocab(with_added_tokens=False):
        if entry.endswith(WORD_END):
            try:
                word = bytes(to_char[c] for c in entry[:-len(WORD_END)]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if pre_tokens(word) == [word]:
                words.append(word)
    found = tok.encode_batch(words, add_special_tokens=False)
    return frozenset(w for w, e in zip(words, found, strict=True) if len(e.ids) == 1)


class Counter:
    """Token counts of texts; holds the proven table and a bounded memo."""

    def __init__(self, path: str, memo: int = MEMO):
        self.tok, self.whole, self.memo = load(path), proven_whole(path), memo
        self.cost: dict[str, int] = dict.fromkeys(self.whole, 1)

    def counts(self, texts: list[str]) -> list[int]:
        special = [len(SPECIAL.findall(t)) if "<|" in t else 0 for t in texts]
        words = [pre_tokens(t) if not n else [w for part in SPECIAL.split(t) for w in pre_tokens(part)]
                 for t, n in zip(texts, special, strict=True)]
        cost = self.cost
        rest = list({w for ws in words for w in ws if w not in cost})
        if len(cost) + len(rest) > self.memo + len(self.whole):
            self.cost = cost = dict.fromkeys(self.whole, 1)
            rest = list({w for ws in words for w in ws if w not in cost})
        cost.update(zip(rest, (len(e.ids) for e in self.tok.encode_batch(rest, add_special_tokens=False)), strict=True))
        return [n + sum(map(cost.__getitem__, ws)) for n, ws in zip(special, words, strict=True)]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts count 0 bytes and 0 tokens; null and repeated ids are
    ordinary rows; other columns are ignored. Map-only, memory bounded by the
    memo and one slice of texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for whole in batches:
            for batch in slices(whole, "text"):
                sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
                tokens = counter.counts(texts_of(batch, "text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), sizes, pa.array(tokens, pa.int64()),
                     pa.array([n > limit for n in tokens])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
