"""The operators over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitrep.llm import archive, ctxmix, decontam, divergence, linedup, mixing, neardup, pii, quality, resample, secrets, tokens, urls
from sitrep.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the lines that break a rule."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lost = quality.quality(docs).select("doc_id", "n_lines", "n_bad_lines", "lost_words")
    text = F.coalesce("text", F.lit(""))
    cleaned = quality.clean_lines(docs).select("doc_id", F.sha2(text.cast("binary"), 256).alias("cleaned_sha256"))
    return lost.join(cleaned, "doc_id")


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The given labels name documents, none names a URL: fixed rules' verdicts are what there is.
    return urls.judged(table(spark, sf_dir, "pages"))


def op4_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.near_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("key")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op9_linedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.line_dedup(table(spark, sf_dir, "documents"))


def op9_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, under the name the whole rule had while ``op9_linedup`` had a smaller one."""
    return op9_linedup(spark, sf_dir)


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenized(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctxmix.scored(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op1_lines,
        op2_neardup,
        op3_urls,
        op4_archive,
        op5_mixing,
        op6_secrets,
        op7_decontam,
        op7_near,
        op8_pii,
        op9_linedup,
        op9_runs,
        op10_tokens,
        op11_scores,
        op12_divergence,
        op13_resample,
    )
}
