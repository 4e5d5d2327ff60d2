"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlab.llm.common import crc_mod, table, tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    from cohortlab.llm.sentencepiece_codec import encode_decode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_decode(docs, tokenizer("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


@register("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document, its edited text and their likeness."""
    from cohortlab.llm.fingerprints import edited_pairs

    return edited_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP6_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '~') AS src, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'), ' ') AS t
  FROM documents),
w AS (SELECT doc_id, source, src,
        (CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END)::BIGINT AS tokens,
        (('0x' || substr(md5('mixb|' || doc_id), 1, 15))::BIGINT) % 1024 AS bucket,
        ('0x' || substr(md5('mixd|' || doc_id || '|' || src), 1, 15))::BIGINT AS place FROM d),
s AS (SELECT src, sum(tokens)::BIGINT AS tokens FROM w GROUP BY src),
tot AS (SELECT sum(tokens)::BIGINT AS total, 0.95 * ln(count(*)) AS target, list(tokens) AS ts FROM s),
lg AS (SELECT total, target, list_transform(ts, lambda x: ln(x / total::DOUBLE)) AS l FROM tot),
bis AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (
    SELECT i, lo, hi, (lo + hi) / 2 AS mid,
      ln(list_sum(list_transform(l, lambda x: exp((lo + hi) / 2 * x))))
      - (lo + hi) / 2 * list_sum(list_transform(l, lambda x: exp((lo + hi) / 2 * x) * x))
        / list_sum(list_transform(l, lambda x: exp((lo + hi) / 2 * x))) >= target AS ok
    FROM bis, lg WHERE i < 40)),
al AS (SELECT CASE WHEN ln(list_sum(list_transform(l, lambda x: exp(x)))) - list_sum(list_transform(l, lambda x: exp(x) * x))
        / list_sum(list_transform(l, lambda x: exp(x))) >= target THEN 1.0 ELSE lo END AS a FROM bis, lg WHERE i = 40),
n AS (SELECT a, sum(pow(tokens / total::DOUBLE, a)) AS norm FROM s, al, tot GROUP BY a),
p AS (SELECT src, tokens, round(total::DOUBLE * pow(tokens / total::DOUBLE, a) / norm / tokens, 9) AS rep FROM s, n, tot),
q AS (SELECT src, rep, tokens AS total, floor(rep)::BIGINT AS whole, (rep - floor(rep)) * tokens AS rest FROM p),
g AS (SELECT src, bucket, place, sum(tokens)::BIGINT AS tokens, ('0x' || substr(md5('mixt|' || src || '|' || bucket), 1, 15))::BIGINT AS turn
      FROM w GROUP BY src, bucket, place),
r AS (SELECT src, place, sum(tokens) OVER (PARTITION BY src ORDER BY turn, bucket, place) - tokens AS before FROM g),
c AS (SELECT w.doc_id, w.source, w.tokens, w.place, q.rep, before, q.total, whole + CASE WHEN before < rest THEN 1 ELSE 0 END AS copies
      FROM w JOIN q USING (src) JOIN r ON r.src = w.src AND r.place = w.place),
o AS (SELECT *, unnest(range(copies)) AS mix_epoch FROM c WHERE copies > 0)
SELECT doc_id, source, tokens AS n_tokens, mix_epoch,
  floor(least(CASE WHEN rep * total > 0 THEN (mix_epoch * total + before) / (rep * total) ELSE place / pow(2, 60) END, 1 - 1e-9)
    * greatest(1, ceil((SELECT total FROM tot) / 1e6)))::BIGINT AS mix_block,
  ('0x' || substr(md5('mixo|' || mix_epoch || '|' || place), 1, 15))::BIGINT AS mix_order
FROM o
"""


@register("op6_mixing", OP6_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of the mixture of all documents: entropy at least 95 % of the largest, four epochs at most."""
    from cohortlab.llm.mixing import mix, word_tokens

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return (mix(docs).select("doc_id", "source", word_tokens("text").alias("n_tokens"), "mix_epoch", "mix_block", "mix_order"))


OP4_SQL = """
WITH h AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT *, ('0x' || substr(x, 1, 10))::BIGINT AS a0, ('0x' || substr(x, 11, 10))::BIGINT AS a1,
  ('0x' || substr(x, 21, 10))::BIGINT AS a2, ('0x' || substr(x, 31, 10))::BIGINT AS a3 FROM h),
d AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((CASE i // 8 WHEN 0 THEN a0 WHEN 1 THEN a1 WHEN 2 THEN a2 ELSE a3 END) >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)),
    'string_agg', '') AS payload_digest FROM g),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


@register("op4_warc", OP4_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as a sharded archive in the shared folder, then read it back."""
    from cohortlab.llm.common import shared_folder
    from cohortlab.llm.warc import read_warc, write_warc

    out = shared_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), out)
    return read_warc(spark, out, with_payload=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learned outside the held-out quarter."""
    from cohortlab.llm import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    return (quality.score(docs, model).withColumn("held_out", crc_mod("doc_id", 4) == 2)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted")))


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned outside the held-out fifth."""
    from cohortlab.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return (toxicity.score(docs, model).withColumn("held_out", crc_mod("doc_id", 5) == 0)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


@register("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digests of base spans, all spans."""
    from cohortlab.llm.pii import find_personal

    docs = find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"))
    said = lambda s: F.concat_ws(",", F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    base = F.filter("spans", lambda x: x["kind"] != "context")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return docs.select("doc_id", count("email"), count("ip"), count("card"), count("phone"),
                       F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"),
                       count("context"))


OP5_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
g AS (SELECT vec_id, v FROM e WHERE v IS NOT NULL AND len(v) > 0 AND list_count(v) = len(v)
      AND len(list_filter(v, lambda x: isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS c FROM e UNION SELECT l.b, r.c FROM r JOIN l ON r.a = l.a),
m AS (SELECT a, min(c) AS component_id FROM r GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id)::BIGINT AS n_links, m.component_id,
  e.vec_id = m.component_id AS kept
FROM e JOIN m ON m.a = e.vec_id
"""


@register("op5_vector_dedup", OP5_SQL)
def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    from cohortlab.llm.vector_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP7_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS ws FROM documents),
u AS (SELECT min(doc_id) AS node, any_value(ws) AS ws, coalesce(text, '') AS text FROM w GROUP BY coalesce(text, '')),
s AS (SELECT DISTINCT node, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS g
      FROM (SELECT node, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM u WHERE len(ws) > 0)),
n AS (SELECT node, count(*) AS n FROM s GROUP BY node),
c AS (SELECT a.node AS a, b.node AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.node < b.node GROUP BY a.node, b.node),
p AS (SELECT a, b FROM c JOIN n x ON x.node = a JOIN n y ON y.node = b WHERE k >= 0.8 * (x.n + y.n - k)),
l AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT node AS a, node AS c FROM u UNION SELECT l.b, r.c FROM r JOIN l ON r.a = l.a),
m AS (SELECT a, min(c) AS class_id FROM r GROUP BY a)
SELECT w.doc_id, m.class_id, w.doc_id = m.class_id AS kept
FROM w JOIN u ON u.text = coalesce(w.text, '') JOIN m ON m.a = u.node
"""


@register("op7_minhash_dedup", OP7_SQL)
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: five-word shingles, similarity 0.8."""
    from cohortlab.llm.text_dedup import near_texts

    return near_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op1_chat_format")
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations written as raw transcripts, parsed back and rendered; a quarter of them does not train."""
    from cohortlab.llm import chat

    raw = chat.as_transcript(table(spark, sf_dir, "conversations"))
    model = chat.fit(raw.where(crc_mod("conv", 4) != 2))
    return (chat.parse(raw, model).withColumnRenamed("id", "conv_id").withColumn("held_out", crc_mod("conv_id", 4) == 2))


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding, one row a component."""
    from cohortlab.llm import whitening

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, "embedding", 32)
    error = whitening.identity_error(vectors, model)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if len(model.values) else F.lit(None).cast("array<double>")
    rows = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


OP13_SQL = """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
       lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
         lambda r, step: xor(r >> 1, (r & 1) * 3988292384))), 4294967295) % 3 = 0 AS tampered
  FROM documents),
a AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
    END AS forged,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos FROM f),
low AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS nodes FROM a GROUP BY lang
  UNION ALL
  SELECT lang, lvl + 1, list_transform(range(0, (len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[i * 8 + 1:i * 8 + 8], ''))) FROM low WHERE len(nodes) > 1),
roots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS lpos, lvl AS depth FROM low WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS lvl, list(subroot ORDER BY lpos) AS nodes FROM roots
  UNION ALL
  SELECT lvl + 1, list_transform(range(0, (len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[i * 8 + 1:i * 8 + 8], ''))) FROM top WHERE len(nodes) > 1),
w AS (
  SELECT a.doc_id, a.lang, 0 AS step, coalesce(forged, leaf) AS node, '' AS proof, pos FROM a
  UNION ALL
  SELECT doc_id, lang, step + 1, sha256(concat(lhs, node, rhs)), concat(proof, lhs, rhs), spot // 8 FROM (
    SELECT doc_id, lang, step, node, proof, spot, array_to_string(nodes[spot // 8 * 8 + 1:spot], '') AS lhs,
      array_to_string(nodes[spot + 2:spot // 8 * 8 + 8], '') AS rhs
    FROM (SELECT w.doc_id, w.lang, w.step, w.node, w.proof, CASE WHEN w.step = r.depth THEN r.lpos ELSE w.pos END AS spot,
            coalesce(low.nodes, top.nodes) AS nodes
          FROM w JOIN roots r ON r.lang IS NOT DISTINCT FROM w.lang
          LEFT JOIN low ON low.lang IS NOT DISTINCT FROM w.lang AND low.lvl = w.step AND w.step < r.depth
          LEFT JOIN top ON top.lvl = w.step - r.depth) x
    WHERE len(nodes) > 1) y)
SELECT a.doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM a JOIN roots ON roots.lang IS NOT DISTINCT FROM a.lang, (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1),
  (SELECT doc_id, max_by(node, step) AS node, max_by(proof, step) AS proof FROM w GROUP BY doc_id) z
WHERE z.doc_id = a.doc_id
"""


@register("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the manifest, and the root that it gives with a third of the texts changed."""
    from cohortlab.llm.merkle_manifest import fold, leaf_digest, lower_ascii, manifest, proof_digest

    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", leaf_digest(*head, F.col("text")).alias("leaf"),
        F.when(F.col("doc_id").isNotNull() & (crc_mod("doc_id", 3) == 0), leaf_digest(*head, lower_ascii(F.col("text")))).alias("forged"))
    rows = manifest(docs, carry=("forged",)).withColumn("folded_root", fold(F.coalesce("forged", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_sql() -> str:
    """Counts, votes, expectation-maximisation on lists, and verdicts."""
    from cohortlab.llm.quality_rules import RULES, start

    def ruled(r) -> str:
        value, under = f"({r.over}) * 1000", f"({r.under})"
        bad = [f"{value} < {r.bad_below} * {under}"] * (r.bad_below is not None) + [f"{value} > {r.bad_above} * {under}"] * (r.bad_above is not None)
        good = [f"{value} >= {r.good_from} * {under}"] * (r.bad_below is not None) + [f"{value} <= {r.good_to} * {under}"] * (r.bad_above is not None)
        return f"CASE WHEN {under} = 0 THEN 0 WHEN {' OR '.join(bad)} THEN -1 WHEN {' AND '.join(good)} THEN 1 ELSE 0 END"

    first, kinds = start(RULES), list(dict.fromkeys(r.kind for r in RULES))
    own = [[False] * len(RULES), *[[r.kind == k for r in RULES] for k in kinds]]
    classes, rules = f"range(1, {len(own) + 1})", f"range(1, {len(RULES) + 1})"
    only = lambda c: f"length(regexp_replace(t, '{c}', '', 'g'))"
    blank = "\\x20\\x09-\\x0D"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^{blank}]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{blank}]')) AS ls FROM d),
u AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (SELECT rid, max(k) AS top FROM (SELECT rid, count(*) AS k FROM u GROUP BY rid, word) x GROUP BY rid),
g AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS five FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 4) x),
h AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS k FROM g) x WHERE k > 1),
rep AS (SELECT rid, count(DISTINCT j) AS k FROM (SELECT rid, unnest(range(i, i + 5)) AS j FROM h) x GROUP BY rid),
c AS (SELECT doc_id, rid, len(ws)::BIGINT AS n_words, {only(f'[{blank}]')} AS word_chars, {only('[^#*$%&|<>]')} AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.k, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
    coalesce(top, 0) AS n_top_word, {only('[^A-Z]')} AS n_upper, {only('[^A-Za-z]')} AS n_letters, {only('[' + chr(92) + 'x00-' + chr(92) + 'x7F]')} AS n_wide,
    {only('[^0-9]')} AS n_digits, {only('[^!]')} AS n_exclaims, {only('[^.!?]')} AS n_stops,
    len(list_filter(ws, lambda x: regexp_matches(x, '[#*$%&|<>]'))) AS n_marked_words,
    len(list_filter(ws, lambda x: regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$'))) AS n_loud_words
  FROM w LEFT JOIN f USING (rid) LEFT JOIN rep USING (rid)),
v AS (SELECT *, [{', '.join(map(ruled, RULES))}] AS v FROM c),
pats AS (SELECT list({{'v': v, 'c': k}} ORDER BY v) AS ps, sum(k) AS n FROM (SELECT v, count(*)::DOUBLE AS k FROM v GROUP BY v) x),
em AS (
  SELECT 0 AS i, {first.shares.tolist()}::DOUBLE[] AS sh, {first.says_good.tolist()}::DOUBLE[][] AS sa
  UNION ALL
  SELECT i + 1, list_transform({classes}, lambda k: (list_sum(list_transform(q, lambda p: p.w[k])) + 1) / (n + {len(own)})),
    list_transform({classes}, lambda k: list_transform({rules}, lambda j: CASE WHEN k = 1 THEN greatest(raw[1][j], 0.5)
      WHEN {own}[k][j] THEN least(raw[k][j], greatest(raw[1][j], 0.5)) ELSE raw[k][j] END))
  FROM (SELECT i, n, q, list_transform({classes}, lambda k: list_transform({rules}, lambda j:
      (list_sum(list_transform(q, lambda p: CASE WHEN p.v[j] = 1 THEN p.w[k] ELSE 0 END)) + 10 * {first.says_good.tolist()}[k][j])
      / (list_sum(list_transform(q, lambda p: CASE WHEN p.v[j] <> 0 THEN p.w[k] ELSE 0 END)) + 10))) AS raw
    FROM (SELECT i, n, list_transform(e, lambda p: {{'v': p.v, 'w': list_transform(p.e, lambda x: p.c * x / list_sum(p.e))}}) AS q
      FROM (SELECT i, n, list_transform(z, lambda p: {{'v': p.v, 'c': p.c, 'e': list_transform(p.z, lambda x: exp(x - list_max(p.z)))}}) AS e
        FROM (SELECT i, n, list_transform(ps, lambda p: {{'v': p.v, 'c': p.c, 'z': list_transform({classes}, lambda k: ln(sh[k])
            + list_sum(list_transform({rules}, lambda j: CASE p.v[j] WHEN 1 THEN ln(sa[k][j]) WHEN -1 THEN ln(1 - sa[k][j]) ELSE 0 END)))}}) AS z
          FROM em, pats WHERE i < 200) a) b) c) d),
z AS (SELECT v.*, list_transform({classes}, lambda k: ln(sh[k])
    + list_sum(list_transform({rules}, lambda j: CASE v.v[j] WHEN 1 THEN ln(sa[k][j]) WHEN -1 THEN ln(1 - sa[k][j]) ELSE 0 END))) AS z
  FROM v, em WHERE i = 200)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 1 / list_sum(list_transform(z, lambda x: exp(x - z[1]))) >= 0.5 AS kept
FROM z
"""


@register("op12_quality_rules", op12_sql())
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, the base conditions and the verdict of the rules."""
    from cohortlab.llm import quality_rules
    from cohortlab.llm.common import stored

    counted = stored(quality_rules.measure(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",)), "counts")
    judged = quality_rules.judge(counted, quality_rules.fit(counted))
    return judged.select("doc_id", *[f"counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                         "base_failed", "kept")


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
