import random

import public_tokenizers as P
from llm_cases import ODD_TEXTS
from tokenizers import Tokenizer

from tallyforge.llm import queries, tokens

VOCAB = P.path("word_bpe_49k.json")


def _want(texts):
    return [len(e.ids) for e in Tokenizer.from_file(VOCAB).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_query_matches_the_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], _want([d.text for d in docs]), strict=True))
    got = queries.queries()["op7_token_counts"](spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert {r.doc_id: r.n_bytes for r in got} == {d.doc_id: len((d.text or "").encode()) for d in docs}
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_odd_texts(spark, odd_docs, no_docs):
    got = tokens.count_tokens(odd_docs, VOCAB).collect()
    texts = [r.text for r in odd_docs.collect()]
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted(
        zip([len((t or "").encode()) for t in texts], _want(texts), strict=True))
    assert tokens.count_tokens(no_docs, VOCAB).collect() == []


def test_random_strings_match_the_library():
    r = random.Random(7)
    parts = [*ODD_TEXTS[4:5], "the", "THE", "'s", "'RE", "''t", "<|", "|>", "<|endoftext|>", "endoftext", " ", "\n", "\x1c", "\x85",
             "​", "Σ", "ς", "İ", "é", "é", "ß", "1", "½", "²", "日", "!", "…", "_", "ﷺ", "Ⅷ", "　", "à́", "🙂"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    assert tokens.Counter(VOCAB).counts(texts) == _want(texts)


def test_shortcut_is_proven_and_memo_is_bounded():
    whole = tokens.proven_whole(VOCAB)
    assert len(whole) > 20_000 and {"the", "dog", "'s"} <= whole
    c = tokens.Counter(VOCAB, memo=50)
    texts = [f"qzx{i}w blorp" for i in range(200)]
    for i in range(0, 200, 20):
        assert c.counts(texts[i:i + 20]) == _want(texts[i:i + 20])
        assert len(c.cost) <= len(whole) + 71
