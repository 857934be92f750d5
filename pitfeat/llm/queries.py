"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitfeat.checkpoints import scratch_folder
from pitfeat.llm import (
    bpe_codec,
    decontaminate,
    filter_audit,
    html_text,
    language_id,
    lm_score,
    minhash,
    ngram_join,
    quality_net,
    quality_rules,
    token_counts,
    warc,
    whitening,
)
from pitfeat.llm.common import id_bucket

VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    book = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(book, "v2").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "fail_bits")


def quality_rule_ablations(spark, sf_dir):
    return quality_rules.ablations(quality_rules.ledger(table(spark, sf_dir, "documents")), "v2")


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op3_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_lm_score(spark, sf_dir):
    training = id_bucket("doc_id", 10) != 0
    found = lm_score.score(table(spark, sf_dir, "documents"), training)
    return found.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op5_warc(spark, sf_dir):
    folder = scratch_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(pages, folder)
    return warc.page_report(warc.read_archives(spark, folder), pages.schema["page_id"].dataType)


def op6_ngram_join(spark, sf_dir):
    found = ngram_join.similar_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket("doc_id", 4) == 2
    model = language_id.train(docs.where(~held_out))
    return language_id.identify(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op8_quality_net(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_bucket("doc_id", 5) == 0
    model = quality_net.train(docs, labels.where(~held_out))
    return quality_net.score(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op9_bpe_codec(spark, sf_dir):
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op10_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op11_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    found = whitening.apply(vectors, whitening.fit(vectors))
    # beyond 64 bits the contract's column has no value
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents
), places AS (
  SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM docs WHERE len(w) > 2
), counted AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS n FROM places
), covered AS (
  SELECT r, count(DISTINCT p + o) AS n_repeat
  FROM counted CROSS JOIN (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY r
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper,
    length(t) - length(replace(t, '!', '')) AS n_exclaim
  FROM docs LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), judged AS (
  SELECT *, CAST(
    (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (10 * n_dup_lines > 3 * n_lines)::INT
    + 16 * (10 * n_upper > 5 * word_chars)::INT + 32 * (10 * n_exclaim > 5 * n_words)::INT
    + 64 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT AS BIGINT) AS fail_bits
  FROM measured
)"""

OP1_SQL = QUALITY_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM judged"""

ABLATION_SQL = QUALITY_SQL + """
, r AS (SELECT * FROM (VALUES ('too_few_words', 1), ('repeated_words', 2), ('symbol_ratio', 4),
  ('repeated_lines', 8), ('shouting', 16), ('exclamations', 32), ('word_length', 64)) v(rule, bit))
SELECT rule, CAST(count(*) FILTER ((fail_bits & bit) <> 0) AS BIGINT) AS failed,
  CAST(count(*) FILTER (fail_bits = bit) AS BIGINT) AS failed_alone,
  CAST(count(*) FILTER ((fail_bits & (127 - bit)) = 0) AS BIGINT) AS kept_without
FROM judged CROSS JOIN r GROUP BY rule"""

OP5_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), coded AS (
  SELECT page_id, payload_bytes, list_reduce(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (CAST('0x' || substr(h, CAST(1 + 10 * (k // 8) AS INT), 10) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS INT)) & 31
    AS INT), 1)), lambda a, b: a || b) AS payload_digest FROM p
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to FROM ranked"""

OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows
), hits AS (
  SELECT r, p, d.n, item FROM (
    SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM (
      SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d CROSS JOIN lengths WHERE len(w) >= n)) d
  JOIN windows ON windows.g = d.g AND windows.n = d.n
), covered AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""

OP12_SQL = rf"""
WITH docs AS (
  SELECT d.doc_id, coalesce(d.source, '') AS part, coalesce(d.text, '') AS t, {WORDS_SQL} AS w,
    min(d.doc_id) OVER (PARTITION BY coalesce(d.text, '')) AS first_id FROM documents d
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f:
    CASE f WHEN 'A' THEN len(w) < 200
      WHEN 'B' THEN 100 * len(list_distinct(w)) < 50 * len(w)
      WHEN 'C' THEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t)
      WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
      ELSE coalesce(docs.doc_id > first_id, false) END) AS fails
  FROM docs LEFT JOIN marks ON docs.doc_id = marks.doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS f, string_split(filter_order[1:step - 1], '') AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), taken AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (NOT list_has_any(fails, list_append(earlier, f))) AS kept,
    sum(n) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)) AS removed,
    sum(n) FILTER (list_contains(fails, f) AND list_has_any(fails, earlier)) AS redundant,
    sum(n) FILTER (fails = [f]) AS unique_fails,
    sum(good) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)) AS good_lost,
    sum(toxic) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, earlier)) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM taken"""

QUERIES = {
    "pipeline": (pipeline, None),
    "op1_quality_rules": (op1_quality_rules, OP1_SQL),
    "quality_rule_ablations": (quality_rule_ablations, ABLATION_SQL),
    "op2_token_counts": (op2_token_counts, None),
    "op3_html_text": (op3_html_text, None),
    "op4_lm_score": (op4_lm_score, None),
    "op5_warc": (op5_warc, OP5_SQL),
    "op6_ngram_join": (op6_ngram_join, None),
    "op7_language_id": (op7_language_id, None),
    "op8_quality_net": (op8_quality_net, None),
    "op9_bpe_codec": (op9_bpe_codec, None),
    "op10_decontaminate": (op10_decontaminate, OP10_SQL),
    "op11_whitening": (op11_whitening, None),
    "op12_filter_audit": (op12_filter_audit, OP12_SQL),
    "op13_minhash": (op13_minhash, None),
}


def queries():
    return {name: run for name, (run, _) in QUERIES.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
