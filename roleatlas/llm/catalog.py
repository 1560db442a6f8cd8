"""The queries of these operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog.registry import Registry
from . import alignment, conversations, exact_dedup, html_extract, knn_join, line_dedup, lm_bytes, mixing
from . import near_dedup, ngram_join, packing, suffix_dedup, toxicity

registry = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The tokenizer file of the packing contract."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@registry.add("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (toxicity.fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s FROM docs GROUP BY source),
weighted AS (
  SELECT source, s, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::BIGINT AS w
  FROM sources),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY s / w, source) AS k,
         coalesce(sum(3 * s) OVER (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(w) OVER (ORDER BY s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         sum(s) OVER () AS total
  FROM weighted),
levels AS (
  SELECT k, (total - used)::DOUBLE / open::DOUBLE AS level, s, w FROM ordered),
level AS (
  SELECT coalesce((SELECT level FROM levels WHERE (3 * s)::DOUBLE > level * w ORDER BY k LIMIT 1), 0) AS level),
rates AS (
  SELECT source, s, least((3 * s)::DOUBLE, level * w) AS target,
         CASE WHEN s > 0 THEN least((3 * s)::DOUBLE, level * w) / s ELSE 0 END AS rate
  FROM weighted, level)
SELECT doc_id, size, s AS source_size, target,
       size * (floor(rate)::BIGINT
               + (('0x' || substr(md5('mix:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE
                  < rate - floor(rate))::BIGINT) AS taken
FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source
"""


@registry.add("op2_mix_sources", MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.mixing_plan(docs)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken)


@registry.add("op3_pack_sequences")
def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, word_bpe())


EXACT_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY content) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY content) AS kept,
       sha256(content) AS text_sha256
FROM docs
"""


@registry.add("op8_exact_dedup", EXACT_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = exact_dedup.exact_groups(docs)
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return groups.select("doc_id", "keep_id", "group_size", "kept", digest)


@registry.add("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    n_chars = F.char_length("text").cast("long").alias("n_chars")
    return html_extract.extract_text(pages).select("page_id", "url", "text", n_chars)


@registry.add("op10_near_dedup")
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = near_dedup.near_groups(docs)
    return groups.withColumn("kept", F.col("doc_id") == F.col("class_id"))


@registry.add("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.fold("doc_id", 7) == 2
    scores = lm_bytes.byte_lm_scores(docs, ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), *scores.columns[1:])


VECTOR_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM whole q JOIN whole d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
WHERE rank <= 5
"""


@registry.add("op4_vector_top_k", VECTOR_SQL)
def op4_vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return knn_join.voronoi_top_k(vectors, F.col("vec_id") % 50 == 0)


LINE_SQL = f"""
WITH lines AS (
  SELECT doc_id, coalesce('s' || source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents),
spread AS (
  SELECT trim(line, chr(32) || chr(9) || chr(13)) AS line FROM lines
  WHERE trim(line, chr(32) || chr(9) || chr(13)) <> ''
  GROUP BY 1 HAVING count(DISTINCT site) >= {line_dedup.SITES}),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY place) FILTER (s.line IS NULL) AS text,
         count(*) AS n_lines, count(s.line) AS n_removed
  FROM lines l LEFT JOIN spread s ON trim(l.line, chr(32) || chr(9) || chr(13)) = s.line
  GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0)::INTEGER AS n_lines, coalesce(k.n_removed, 0)::INTEGER AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@registry.add("op9_line_dedup", LINE_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.drop_spread_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


@registry.add("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.remove_repeats(docs)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@registry.add("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("byte_bpe_50k.json", "piece_bpe_32k.model")
    found = alignment.align_tokenizers(docs, *[public_tokenizers.path(n) for n in names])
    return found.withColumnRenamed("digest", "groups_sha256")


@registry.add("op12_ngram_join")
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.ngram_components(docs)


@registry.add("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired; one that lost all its rows has zeros."""
    rows = table(spark, sf_dir, "conversations")
    found = conversations.repair_conversations(conversations.damaged(rows))
    digests = conversations.line_digests(found.repaired)
    counts = [c for c in found.audits.columns if c not in ("conv_id", "audit")]
    names = rows.select("conv_id").distinct().alias("n")
    joined = names.join(found.audits.alias("a"), F.expr("n.conv_id <=> a.conv_id"), "left").join(
        digests.alias("d"), F.expr("n.conv_id <=> d.conv_id"), "left"
    )
    empty = F.sha2(F.lit(""), 256)
    return joined.select(
        "n.conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )
