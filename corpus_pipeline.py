"""A corpus from documents to packed sequences: language, exact and near dedup, mixture, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.deploy import ship
from scriptorium.llm import language_id, minhash, mixing, packing
from scriptorium.llm.base import documents_like, small_batches, staged, table, with_rows
from scriptorium.llm.exact_dedup import DigestIndex, exact_dedup, text_sha256
from scriptorium.llm.queries import KEEP, LANGUAGES, SOURCES, TOPIC_SHARES

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ROW = "_row"
SURE = 0.5  # of the language, at least


COLUMNS = "doc_id", "text", "lang", "source", "n_chars"


def plainly_named(stage: Stage) -> Stage:
    """Columns besides those of documents go through a stage under names of their
    own, so that none clashes with the stage's, and come back under theirs."""

    @wraps(stage)
    def staged_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        small_batches(spark)
        names = [c if c in COLUMNS else f"_extra{k}" for k, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*names), sf_dir)
        return out.toDF(*docs.columns) if out.columns == names else out

    return staged_


def _kept(rows: DataFrame, keep: DataFrame, columns: list[str]) -> DataFrame:
    """The rows named in keep, with the columns of documents."""
    return documents_like(rows.join(keep.select(ROW), ROW, "left_semi"), columns)


@plainly_named
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no sure language, go."""
    model = language_id.trained_on(docs)
    found = language_id.identify(docs, model, names=("_lang_pred", "_lang_score"))
    return documents_like(found.filter((F.col("_lang_pred") != language_id.UNDETERMINED) & (F.col("_lang_score") >= SURE)), docs.columns)


@plainly_named
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row; texts are joined once, by digest and doc_id, so that a
    hot text's copies are spread over tasks."""
    keep = exact_dedup(docs, DigestIndex(spark)).filter("kept").select(F.col("text_sha256").alias("_digest"), F.col("keep_id").alias("_keep"))
    rows = docs.withColumn("_digest", text_sha256())
    same = rows.join(keep, (rows["_digest"] == keep["_digest"]) & rows["doc_id"].eqNullSafe(keep["_keep"]), "left_semi")
    first = Window.partitionBy("_digest", "doc_id").orderBy(F.desc(F.length("text")), F.xxhash64(*docs.columns))
    return documents_like(same.withColumn("_first", F.row_number().over(first)).filter("_first = 1"), docs.columns)


@plainly_named
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles and a similarity of 0.8; the smallest doc_id of a group stays."""
    rows = with_rows(docs, "documents", row=ROW)
    return _kept(rows, minhash.near_dedup(rows.select(ROW, "doc_id", "text"), size=5, percent=80).filter("first"), docs.columns)


@plainly_named
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    measured = staged(mixing.measured(docs), "measured")  # read twice: for the cells' sums and for the draw
    return documents_like(mixing.mixed(measured, (SOURCES, LANGUAGES, TOPIC_SHARES), KEEP).filter("_sampled"), docs.columns)


@plainly_named
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("mixing", mixture),
    ("packing", packed),
]

#: Packing and near dedup by full sets are not for SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
