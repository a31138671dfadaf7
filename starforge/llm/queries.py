"""Registry of this package: the thin ``opN_<name>`` queries over the standard tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm.common import read_table

MAX_TOKENS = 4096
SHARDS = 24


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; the operators take it as a parameter."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op4_embedding_dedup import near_duplicate_vectors
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op5_sharding import shard_documents
    return shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op7_best_fit_packing import pack_documents
    packed = pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), MAX_TOKENS)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "sequence_id", "offset")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starforge.llm.op8_token_output import packed_rows
    return packed_rows(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op10_html_extraction import extract_main_text
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op6_language_id import identify_languages
    return identify_languages(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op3_toxicity import score_toxicity
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op1_minhash_dedup import near_duplicate_classes
    return near_duplicate_classes(read_table(spark, sf_dir, "documents"))


def op2_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op2_quality_resampling import resample_labelled
    return resample_labelled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op9_decontamination import contaminated
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starforge.llm.op11_differencing_packing import pack_evenly
    return pack_evenly(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op12_spelling_variants import group_variants
    return group_variants(read_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm.op13_fill_in_middle import fill_in_middle, restored_text
    rows = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored_text(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def queries() -> dict:
    return {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_quality_resampling": op2_quality_resampling,
        "op3_toxicity": op3_toxicity,
        "op4_embedding_dedup": op4_embedding_dedup,
        "op5_sharding": op5_sharding,
        "op6_language_id": op6_language_id,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_token_output": op8_token_output,
        "op9_decontamination": op9_decontamination,
        "op10_html_extraction": op10_html_extraction,
        "op11_differencing_packing": op11_differencing_packing,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


# Token lists are cut by list slices; the four numbers come from the hex digits of the id's hash.
OP13_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
),
cut AS (
  SELECT doc_id, x, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM drawn
),
bounds AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
),
parts AS (
  SELECT doc_id, n, form, x, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:n], '') AS s
  FROM bounds
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM parts"""


def oracle_sql() -> dict[str, str]:
    return {"op13_fill_in_middle": OP13_SQL}
