"""Registered queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, codes, decontamination, divergence, neardup, packing, pii, quality, rules, substrings, tokens, toxicity, warc
from .common import Scratch, table

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(fn: QueryFn | None = None, sql: str | None = None):
    def deco(f: QueryFn) -> QueryFn:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _ORACLES[f.__name__] = sql
        return f
    return deco(fn) if fn else deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


@register
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, packed into sequences of 1024 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)
    return packing.best_fit(pieces)


_LINE_RULES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, host, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + j) AS n FROM rep, range(5) AS g(j) GROUP BY r),
ln AS (SELECT r, host, t, x, row_number() OVER (PARTITION BY r, x) AS nth,
              array_to_string(list_filter(regexp_split_to_array(translate(lower(x), '123456789', '000000000'), '[\x20\x09-\x0D]+'),
                                          lambda y: y <> ''), ' ') AS norm,
              len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS words
       FROM (SELECT r, host, t, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) AS n FROM ln WHERE nth > 1 GROUP BY r),
hosts AS (SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host),
freq AS (SELECT l.host, l.norm FROM ln l JOIN hosts h ON l.host IS NOT DISTINCT FROM h.host
         GROUP BY l.host, l.norm, h.docs HAVING count(DISTINCT l.t) > 20 AND (count(DISTINCT l.t) * 100 > h.docs OR max(l.words) >= 10)),
gone AS (SELECT l.r, sum(l.words) AS n FROM ln l JOIN freq f ON l.host IS NOT DISTINCT FROM f.host AND l.norm = f.norm GROUP BY l.r),
s AS (SELECT w.r, w.doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
             len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed_words
      FROM w LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
           AND NOT (n_words - removed_words < 10 OR 100 * removed_words > 50 * n_words) AS kept,
       CAST(removed_words AS BIGINT) AS removed_words
FROM s
"""


_NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
                                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 75 * (x.n + y.n - p.c)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS other FROM d UNION SELECT r.id, e.b FROM reach r JOIN ends e ON e.a = r.other),
c AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@register(sql=_NEAR_DUPLICATES_SQL)
def op2_chosen_path_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


_REVISITS_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM g
"""


@register(sql=_REVISITS_SQL)
def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, indexed, looked up by its URL and read back."""
    pages, folder = table(spark, sf_dir, "pages"), warc.new_archive_folder(spark)
    index = warc.write_index(warc.write_archives(pages, folder), folder)
    return warc.fetch(warc.lookup(pages, index, folder), folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register(sql=_LINE_RULES_SQL)
def op4_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every text and the verdict of the line-frequency rule, by the limits of the cleaned documents."""
    return rules.line_rules(table(spark, sf_dir, "documents"), long_words=rules.LONG_WORDS)


_CLEANED_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, text, coalesce(text, '') AS t FROM documents),
ln AS (SELECT r, host, t, i, ls[i] AS x FROM (SELECT r, host, t, ls, unnest(range(1, len(ls) + 1)) AS i
                                              FROM (SELECT *, string_split(t, chr(10)) AS ls FROM d))),
n AS (SELECT *, CASE WHEN regexp_matches(x, '[^\x20\x09-\x0D]') THEN list_filter(regexp_split_to_array(
                  translate(lower(x), '123456789', '000000000'), '[\x20\x09-\x0D]+'), lambda y: y <> '') END AS ws FROM ln),
hosts AS (SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host),
freq AS (SELECT n.host, n.ws FROM n JOIN hosts h ON n.host IS NOT DISTINCT FROM h.host WHERE ws IS NOT NULL
         GROUP BY n.host, n.ws, h.docs HAVING count(DISTINCT n.t) > 20 AND (count(DISTINCT n.t) * 100 > h.docs OR len(n.ws) >= 10)),
k AS (SELECT n.r, string_agg(n.x, chr(10) ORDER BY n.i) AS clean FROM n LEFT JOIN freq f ON n.host IS NOT DISTINCT FROM f.host AND n.ws = f.ws
      WHERE f.ws IS NULL GROUP BY n.r)
SELECT d.doc_id, d.host AS source, CASE WHEN d.text IS NOT NULL THEN coalesce(k.clean, '') END AS text FROM d LEFT JOIN k USING (r)
"""


@register(sql=_CLEANED_SQL)
def op4_cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its boilerplate lines; long lines have a limit of texts only."""
    return rules.cleaned(table(spark, sf_dir, "documents"), long_words=rules.LONG_WORDS).select("doc_id", "source", "text")


_ROTATION_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, body) - 1 AS seq FROM t),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
v AS (SELECT o.*, perspective,
             CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
             CASE WHEN speaker NOT IN ('system', perspective) THEN regexp_replace(speaker, '[\s<>|]+', '_', 'g') END AS name
      FROM o JOIN p ON o.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM v),
s AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS segment FROM h),
r AS (SELECT *, coalesce(sum(len(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY seq
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM s)
SELECT conv_id, perspective, CAST(seq AS BIGINT) AS seq, turn, role, name, segment, CAST(start AS BIGINT) AS start,
       CAST(CASE WHEN role = 'assistant' THEN start + len(head) END AS BIGINT) AS train_start,
       CAST(CASE WHEN role = 'assistant' THEN len(segment) - len(head) - 1 ELSE 0 END AS BIGINT) AS train_chars
FROM r
"""


@register(sql=_ROTATION_SQL)
def op6_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered from each participant's perspective, turn by turn."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


@register
def op5_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from confirmed examples and unlabelled text."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op8_lstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base patterns and the trained tagger's spans."""
    docs = table(spark, sf_dir, "documents")
    return pii.find_spans(docs, pii.fit(docs))


@register
def op9_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document under the trained subword embeddings."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the word-level vocabulary."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, re-parameterised copies included."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), strict=False).drop("text_key")


_REPEATS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                                                 lambda x: x <> '') AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
rep AS (SELECT r, i FROM win JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k)),
gone AS (SELECT DISTINCT r, i + j AS i FROM rep, range(35) AS g(j)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
         FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@register(sql=_REPEATS_SQL)
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of its repeated passages."""
    left = substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _codes_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    steps = [f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT row_number() OVER () AS r, vec_id, label, q, len(q) // {parts} AS w FROM k),
v AS (SELECT r, vec_id, label, pos, q[pos * w + 1 : pos * w + w] AS part FROM p, range({parts}) AS g(pos)),
c0 AS (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS e, part FROM v
       WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (SELECT v.r, v.pos, min(list_sum(list_transform(list_zip(v.part, c.part), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) * {entries} + c.e) AS best
       FROM v JOIN c{i} c ON c.pos = v.pos GROUP BY v.r, v.pos)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT a.pos, a.best % {entries} AS e, generate_subscripts(v.part, 1) AS d, unnest(v.part) AS x FROM a{i} a JOIN v USING (r, pos)),
n{i} AS (SELECT pos, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY d) AS part FROM (
       SELECT pos, e, d, sum(x)::DOUBLE AS s, count(*) AS n FROM m{i} GROUP BY pos, e, d) GROUP BY pos, e),
c{i + 1} AS (SELECT c.pos, c.e, coalesce(n.part, c.part) AS part FROM c{i} c LEFT JOIN n{i} n USING (pos, e))""")
    return ",\n".join(steps) + f""",
s AS (SELECT r, string_agg(lower(printf('%02X', best % {entries})), '' ORDER BY pos) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
      FROM a{rounds} GROUP BY r)
SELECT p.vec_id, s.code, s.error, CAST(sum(s.error) OVER (PARTITION BY p.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, e)) FROM c{rounds}) AS codebooks_sha256
FROM p JOIN s USING (r)"""


@register(sql=_codes_sql())
def op11_trie_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and error, the error of its label and the digest of the codebooks."""
    coded, books = codes.codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    coded = Scratch(spark, "coded").store(coded.select("vec_id", "label", "code", "error"), "rows")
    by_label = coded.groupBy(F.col("label").alias("l")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.codebooks_digest(books)).alias("codebooks_sha256"))


_DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS total FROM kept GROUP BY lang),
g AS (SELECT grp.lang, grp.source, coalesce((SELECT sum(n)::BIGINT FROM c WHERE c.lang = grp.lang AND c.source = grp.source), 0) AS total,
             coalesce(l.v, 0) AS v, l.total AS lang_total FROM grp LEFT JOIN l USING (lang)),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p,
             1 + (1000000000 * (k.lang_n + 1)) // (g.lang_total + g.v) AS q
      FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
pr AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s x ON x.lang = a.lang AND x.source = a.source
       LEFT JOIN s y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
tr AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM s WHERE n > 0 AND p > q),
f AS (SELECT lang, source, 'pair' AS part, item, value FROM pr UNION ALL SELECT lang, source, 'term', item, value FROM tr)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
WHERE part = 'pair' OR rank <= 200
"""


@register(sql=_DIVERGENCE_SQL)
def op12_divergence_skyband(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's distance to the others of its language and the terms it uses most beyond it."""
    return divergence.audit(table(spark, sf_dir, "documents"))
