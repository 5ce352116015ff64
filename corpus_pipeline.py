"""From raw documents to token counts: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm import catalog, decontaminate, jaccard, pieces, quality, secrets
from spanloom.llm.common import prepare, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near duplicates share this part of their five-word shingles or more.
SIMILARITY = 0.8
SHINGLE_WORDS = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores below the accepting score go."""
    prepare(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, with the smallest ID; links are exact.

    Operator 1 finds the groups, their links are checked on whole shingle sets, and what fingerprints
    cannot reach is found from the sets (``jaccard``).
    A row is known by its ID and its shingle set, so texts of repeated or null IDs are told apart; of rows that
    share both, the first text in order stays.  The texts move once, at any size of the input: the
    list of kept rows grows with the corpus and is sent out only where its stored size is small.
    """
    prepare(spark)
    docs = docs.select(*COLUMNS)
    found = jaccard.near_duplicates(docs, words=SHINGLE_WORDS, similarity=SIMILARITY)
    kept = stored(
        found.filter("stays").select(F.col("id").alias("_id"), F.col("point").alias("_kept")).distinct(), "kept"
    )
    joined = jaccard.with_point(docs, SHINGLE_WORDS).join(
        kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_point") == F.col("_kept")), "left_semi"
    )
    order = Window.partitionBy("doc_id", "_point").orderBy(*COLUMNS)
    return joined.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked in the text; no document goes."""
    prepare(spark)
    owner, repository = catalog.owner_columns()
    masked = secrets.mask_live(docs, owner, repository)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded texts."""
    prepare(spark)
    return pieces.encode_decode(docs, catalog.vocabulary_path())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("encoding", encoding_stage),
]

# the fitted model, the shingle sets and the encoder have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
