"""Queries of the text operators and their SQL twins."""

from __future__ import annotations

from sparkloom.plans.registry import Query, table

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = Query(fn, sql)
        return fn
    return wrap


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


OP10_SQL = """
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
owners AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT lines.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM lines LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def op10_line_dedup(spark, sf_dir):
    from sparkloom.llm.line_mph import dedup_lines
    return dedup_lines(_docs(spark, sf_dir), with_text=False)


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark, sf_dir):
    from sparkloom.llm.suffix_bpr import cut_repeats
    return cut_repeats(_docs(spark, sf_dir), with_text=False)


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 8], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(len(ws) - 7)) AS i FROM d)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT win.doc_id, unnest(range(i, i + 8)) AS p FROM win
    JOIN (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1) USING (doc_id, k)) GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(ls) AS l FROM d)
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (word_chars < 2 * n_words)::BIGINT
    + 8 * (word_chars > 20 * n_words)::BIGINT + 16 * (10 * n_symbols > n_words)::BIGINT + 32 * (10 * n_dup_lines > 3 * n_lines)::BIGINT
    + 64 * (2 * n_upper > n_letters)::BIGINT + 128 * (2 * n_letters < word_chars)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept,
       n_lines, n_letters, n_upper, failures, 'strict/2' AS policy FROM b
"""


@query("op2_rule_ledger", OP2_SQL)
def op2_rule_ledger(spark, sf_dir):
    from sparkloom.llm.rule_ledger import judged
    return judged(_docs(spark, sf_dir))


@query("op4_simhash_ball")
def op4_simhash_ball(spark, sf_dir):
    from sparkloom.llm.simhash_ball import near_duplicates
    return near_duplicates(_docs(spark, sf_dir))


OP9_SQL = """
WITH RECURSIVE step(n, k, c) AS (
  SELECT n, 0, n::BIGINT FROM range(256) t(n)
  UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS tab FROM step WHERE k = 8),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
             lambda b: ('0x' || b)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc),
scored AS (
  SELECT doc_id, s, 1.0::DOUBLE / -ln((('0x' || substr(md5(doc_id || ':' || s), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) AS v
  FROM documents, range(41) t(s)),
best AS (SELECT doc_id, (arg_max(s, v) FILTER (s < 40))::INTEGER AS shard, arg_max(s, v)::INTEGER AS grown_shard FROM scored GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM d JOIN best USING (doc_id)
"""


@query("op9_rendezvous", OP9_SQL)
def op9_rendezvous(spark, sf_dir):
    from sparkloom.llm.rendezvous import shard_records
    return shard_records(_docs(spark, sf_dir), [1.0] * 40)


@query("op7_huffman_ids")
def op7_huffman_ids(spark, sf_dir):
    import public_tokenizers

    from sparkloom.llm.huffman_ids import encode_corpus, read_ids
    from sparkloom.session import scratch_path
    path = scratch_path(spark, "id-files")
    encode_corpus(_docs(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path, with_ids=False)


@query("op8_subword_classifier")
def op8_subword_classifier(spark, sf_dir):
    from sparkloom.llm.subword_classifier import quality
    return quality(_docs(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op6_sp_wfst")
def op6_sp_wfst(spark, sf_dir):
    import public_tokenizers

    from sparkloom.llm.sp_wfst import encode
    return encode(_docs(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_spaced_seeds")
def op3_spaced_seeds(spark, sf_dir):
    from sparkloom.llm.spaced_seeds import find_leaks
    return find_leaks(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query("op5_skip_chain_pii")
def op5_skip_chain_pii(spark, sf_dir):
    from sparkloom.llm.skip_chain_pii import find_personal
    return find_personal(_docs(spark, sf_dir))


@query("op11_site_style_tree")
def op11_site_style_tree(spark, sf_dir):
    from sparkloom.llm.site_style_tree import main_text
    return main_text(table(spark, sf_dir, "pages"))


OP12_SQL = r"""
WITH RECURSIVE step(n, k, c) AS (
  SELECT n, 0, n::BIGINT FROM range(256) t(n)
  UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS tab FROM step WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'),
             lambda b: ('0x' || b)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, crc),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n, length(word) AS len FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (
  SELECT word, n, len, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(len)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.len = b.len AND a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT word, CASE WHEN other_n >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NOT NULL),
ends AS (SELECT chain.word, root FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


@query("op12_spelling_variants", OP12_SQL)
def op12_spelling_variants(spark, sf_dir):
    from sparkloom.llm.spelling_partenum import variants
    return variants(_docs(spark, sf_dir))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
v AS (SELECT lang, count(*)::HUGEINT AS kept, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
          FROM s JOIN k USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n::HUGEINT + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * kept) AS p,
             1 + (1000000000 * (lang_n::HUGEINT + 2)) // (total + 2 * kept) AS q FROM dense JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows)
WHERE part = 'pair' OR rank <= 10
"""


@query("op13_divergence_audit", OP13_SQL)
def op13_divergence_audit(spark, sf_dir):
    from sparkloom.llm.divergence_audit import audit
    return audit(_docs(spark, sf_dir))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
