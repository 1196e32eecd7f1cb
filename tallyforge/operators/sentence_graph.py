"""Outlook sentence by a sentence graph: the most central sentence that looks ahead.

Sentences of a document are linked by the distinct words they share (the weight of a
link is their number) and ranked by ``ROUNDS`` rounds of power iteration with damping
0.85. All arithmetic is on integers with floors: ranks start at ``UNIT``; in a round a
sentence j hands out x = UNIT * rank div (its links' weights), and i gets 15 % of UNIT
plus 85 % of the sum of weight * x over its links. So every engine finds the same ranks,
and ties go to the earliest sentence.

The sum over links is taken by words (a word's x summed over its sentences, less the
sentence's own), exactly the same number in time linear in the document's words: a long
document needs no cut and no matrix of sentence pairs. Documents are independent: one
map step, no shuffle; sentences and words come from the built-in expressions of
``signals``, the rounds are numpy over one document's arrays.

Without a sentence that holds one of ``terms`` the summary is NULL; ``terms=None`` takes
any sentence with a word. NULL and empty texts have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import TOKEN_PATTERN, tokens
from .signals import OUTLOOK_WORDS, SENTENCE_PATTERN, _normalise

ROUNDS = 10
UNIT = 1_000_000


def ranks(sentences: list[list[str]], rounds: int = ROUNDS) -> np.ndarray:
    """Ranks of the sentences (lists of words) of one document."""
    ids: dict[str, int] = {}
    words = [[ids.setdefault(w, len(ids)) for w in set(s)] for s in sentences]
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.array([i for w in words for i in w], np.int64)
    held = np.bincount(flat, minlength=len(ids))
    size = np.bincount(of, minlength=len(words))
    total = np.zeros(len(words), np.int64)
    np.add.at(total, of, held[flat] - 1)
    rank = np.full(len(words), UNIT, np.int64)
    for _ in range(rounds):
        x = np.where(total > 0, UNIT * rank // np.maximum(total, 1), 0)
        by_word = np.zeros(len(ids), np.int64)
        np.add.at(by_word, flat, x[of])
        got = -size * x
        np.add.at(got, of, by_word[flat])
        rank = 15 * UNIT // 100 + 85 * got // (100 * UNIT)
    return rank


def central_sentences(df: DataFrame, text_col: str = "parsed_text", terms=OUTLOOK_WORDS, rounds: int = ROUNDS,
                      pattern: str = TOKEN_PATTERN, out: str = "summary", rank_out: str = "summary_rank") -> DataFrame:
    """Add the most central sentence that holds one of ``terms``, and its rank."""
    wanted = None if terms is None else frozenset(terms)
    keep = [c for c in df.columns if c not in (out, rank_out)]
    found = df.select(F.struct(*keep).alias("row"), F.regexp_extract_all(F.col(text_col), F.lit(SENTENCE_PATTERN), 0).alias("sent"))
    found = found.select("row", "sent", F.transform("sent", lambda s: tokens(s, pattern)).alias("toks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, rank = [], []
            for toks in batch.column("toks").to_pylist():
                sentences = [s or [] for s in toks or []]
                among = [i for i, s in enumerate(sentences) if s and (wanted is None or not wanted.isdisjoint(s))]
                if not among:
                    best.append(None)
                    rank.append(None)
                    continue
                r = ranks(sentences, rounds)
                i = max(among, key=lambda i: (r[i], -i))
                best.append(i + 1)
                rank.append(int(r[i]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("sent"), pa.array(best, pa.int32()), pa.array(rank, pa.int64())],
                                             ["row", "sent", "best", rank_out])

    ranked = found.mapInArrow(run, f"row {found.schema['row'].dataType.simpleString()}, sent array<string>, best int, {rank_out} long")
    sentence = F.when(F.col("best").isNotNull(), _normalise(F.element_at("sent", F.col("best"))))
    return ranked.select("row.*", sentence.alias(out), rank_out)
