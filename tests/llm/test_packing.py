import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tallyforge.llm import packing, queries

RANKS = P.path("byte_bpe_50k.tiktoken")


def _ids(texts):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [e.ids + [2] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def _check(rows, want, length=1024):
    """Pieces cover each document, digests match, sequences are gapless."""
    own, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    assert own.keys() == want.keys()
    for doc, ids in want.items():
        at = 0
        for k, r in enumerate(sorted(own[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            part = ids[at:at + r.length]
            assert r.ids_crc32 == zlib.crc32(np.asarray(part, "<u4").tobytes())
            assert r.length == length or k == 0
            at += r.length
        assert at == len(ids)
        if len(ids) <= length:
            assert len(own[doc]) == 1
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return seqs


def test_query_matches_tokenizers_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], _ids([d.text for d in docs]), strict=True))
    seqs = _check(queries.queries()["op1_best_fit_packing"](spark, sf).collect(), want)
    least = -(-sum(map(len, want.values())) // 1024)
    assert len(seqs) <= least * 1.01 + 2


def test_odd_texts(spark, odd_docs):
    rows = [r for r in odd_docs.select("doc_id", "text").distinct().collect() if r.doc_id is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(zip([r.doc_id for r in rows], _ids([r.text for r in rows]), strict=True))
    _check(packing.best_fit(packing.token_pieces(docs, RANKS, P.PATTERN)).collect(), want)
    # null and repeated ids: every row keeps its own pieces; clashing extra columns are ignored
    every = packing.best_fit(packing.token_pieces(odd_docs, RANKS, P.PATTERN)).collect()
    n = sum(max(1, -(-len(i) // 1024)) for i in _ids([r.text for r in odd_docs.collect()]))
    assert len(every) == n


def test_empty(spark, no_docs):
    assert packing.best_fit(packing.token_pieces(no_docs, RANKS, P.PATTERN)).collect() == []


def test_too_long_piece_is_refused(spark):
    with pytest.raises(Exception, match="longer than a sequence"):
        packing.best_fit(spark.createDataFrame([(1, 0, 2000)], "doc_id long, piece int, length long")).collect()


def _best_fit_by_scan(lengths, size, open_bins):
    """The rule spelled out over a list: fullest fitting bin, else close the fullest."""
    bins, closed = [], 0
    for n in lengths:
        fits = [b for b in bins if b >= n]
        if n >= size:
            closed += 1
            continue
        if fits:
            b = min(fits)
            bins.remove(b)
        else:
            if len(bins) == open_bins:
                bins.remove(min(bins))
                closed += 1
            b = size
        if b - n:
            bins.append(b - n)
        else:
            closed += 1
    return closed + len(bins)


@pytest.mark.parametrize("open_bins", [1, 2, 7, 1000])
def test_packer_equals_the_rule(open_bins):
    r = random.Random(open_bins)
    lengths = [r.randint(1, 64) for _ in range(4000)]
    packer = packing.Packer(64, open_bins)
    used = defaultdict(int)
    for n in lengths:
        own, offset = packer.place(n)
        assert offset == used[own] % 64 or used[own] == 0
        used[own] += n
        assert used[own] <= 64
        assert packer.n_open <= open_bins
    assert packer.made == len(used) == _best_fit_by_scan(lengths, 64, open_bins)


def test_assembled_sequences_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = packing.best_fit(packing.token_pieces(docs, RANKS, P.PATTERN, with_ids=True)).cache()
    by_seq = {r.sequence_id: r for r in packing.assemble(packed).collect()}
    got = defaultdict(dict)
    for r in packed.collect():
        got[r.doc_id][r.piece] = by_seq[r.sequence_id].ids[r.offset:r.offset + r.length]
    texts = docs.select("doc_id", "text").collect()
    for d, ids in zip(texts, _ids([t.text for t in texts]), strict=True):
        assert [i for _, p in sorted(got[d.doc_id].items()) for i in p] == ids
    packed.unpersist()
