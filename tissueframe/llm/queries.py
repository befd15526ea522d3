"""Queries of this package over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch
from . import alignment, chat, collocations, language_id, license_scan, mixing, packing, quality, simhash, substring_dedup, token_files, topk, toxicity
from .textops import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a third of the documents is held out of learning."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of passages that occur earlier."""
    return substring_dedup.dedup(_table(spark, sf_dir, "documents"), min_words=20, digest=True)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of the documents is held out of learning."""
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    _, placed = packing.pack(_table(spark, sf_dir, "documents"), packing.tokenizer_path())
    return placed.drop("key")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances from the nearest language reference and verdict for every document."""
    return quality.quality(_table(spark, sf_dir, "documents"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best other vectors for every hundredth vector."""
    return topk.search(_table(spark, sf_dir, "embeddings"))


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the side of each of its participants."""
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best matching licence template of every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.components(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned groups, links and link counts of every document under two tokenizers."""
    found, _ = alignment.alignment(_table(spark, sf_dir, "documents"), packing.tokenizer_path("byte_bpe_50k.json"),
                                   packing.tokenizer_path("piece_bpe_32k.model"))
    return found


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language."""
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every document's ids, read back from the token files."""
    path = scratch(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), path, packing.tokenizer_path("word_bpe_49k.json"), end_id=2)
    return token_files.read(spark, path, digest=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language_id": op3_language_id,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_chat_rotation": op7_chat_rotation,
    "op8_license_scan": op8_license_scan,
    "op9_mixing": op9_mixing,
    "op10_simhash_components": op10_simhash_components,
    "op11_token_alignment": op11_token_alignment,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_token_files": op13_token_files,
}

ORACLES: dict[str, str] = {
    "op7_chat_rotation": chat.ORACLE,
    "op8_license_scan": license_scan.oracle(),
    "op12_phrase_mining": collocations.ORACLE,
    "op6_exact_top_k": """
        with v as (select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] v from embeddings
                   where vec_id is not null and len(embedding) > 0
                     and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)),
        u as (select vec_id, min(v) v from v group by vec_id),
        s as (select q.vec_id query_id, c.vec_id, cast(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) as bigint) score
              from u q join u c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0),
        r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank from s)
        select query_id, rank, vec_id, score from r where rank <= 10""",
}
