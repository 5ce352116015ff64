"""The registered queries of the text operators and the SQL that gives the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import (
    bloom_sketch, centroids, chains, chat, decontaminate, licenses, personal, pieces, quality, secrets,
    simhash, token_counts, whitening,
)
from spanloom.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def vocabulary_path() -> str:
    """The merge-type vocabulary; ``PIECE_MODEL`` names another file."""
    named = os.environ.get("PIECE_MODEL")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def owner_columns():
    """Documents name a source, its owner; a source's texts of one language are a repository."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


@query
def op1_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, lanes=1, radius=4)
    return found.withColumnRenamed("id", "doc_id")


@query
def op2_substring(spark, sf_dir):
    return chains.shared_passages(table(spark, sf_dir, "documents"))


@query
def op3_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    return quality.score(docs, model).withColumn("held_out", quality.bucket("doc_id") == 2)


@query
def op4_license(spark, sf_dir):
    return licenses.license_matches(table(spark, sf_dir, "documents"))


@query
def op5_pieces(spark, sf_dir):
    return pieces.encode_decode(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op6_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op7_bloom_sketch(spark, sf_dir):
    return bloom_sketch.edited_fingerprints(table(spark, sf_dir, "documents"))


# a conversation made of the template's own markers
_CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@query
def op8_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-1, 0, "user", _CONTROL_TEXT), (-1, 1, "assistant", _CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    read = chat.read_back(chat.format_conversations(turns.unionByName(extra)))
    turns_text = F.array_join(
        F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        F.sha2(turns_text, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


@query
def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op10_secrets(spark, sf_dir):
    owner, repository = owner_columns()
    found = secrets.scan(table(spark, sf_dir, "documents"), owner, repository)

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.sort_array(F.concat("base", "live"))).alias("spans"),
    )


@query
def op11_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    model = whitening.fit(rows)
    if model is None:
        return spark.createDataFrame([], _WHITENED)
    error = whitening.identity_error(rows, model)
    found = whitening.by_component(whitening.transform(rows, model), model, error)
    return found.withColumn("deviation", F.col("deviation").try_cast("long")).withColumnRenamed(
        "id", "vec_id"
    )


_WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


@query
def op12_personal(spark, sf_dir):
    found = personal.find(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(personal.of_kind(F.col("spans"), kind)).cast("long")

    base = personal.of_kind(F.col("spans"), *range(4))
    return found.select(
        F.col("id").alias("doc_id"), count(personal.EMAIL).alias("n_email"),
        count(personal.IP).alias("n_ip"), count(personal.CARD).alias("n_card"),
        count(personal.PHONE).alias("n_phone"), F.sha2(personal.listed(base), 256).alias("base_sha256"),
        personal.listed(F.col("spans")).alias("spans"),
    )


@query
def op13_centroids(spark, sf_dir):
    vectors = centroids.scaled(table(spark, sf_dir, "embeddings"))
    found = centroids.with_inertia(*centroids.cluster(vectors))
    return found.withColumnRenamed("id", "vec_id")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from spanloom.llm import oracle

    return oracle.oracle_sql()
