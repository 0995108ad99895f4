"""The corpus pipeline: stages in order, each over all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.budget_tree import mix
from tarn.llm.common import Scratch, new_path, remove, scope
from tarn.llm.cotrain import keep_good
from tarn.llm.path_join import near_duplicates
from tarn.llm.queries import LANGUAGE_WEIGHTS, tokenizer_files
from tarn.llm.secret_scan import redact
from tarn.llm.slack_pack import pack

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 19


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage whose texts reach Python in Arrow batches that end with the row that takes them to ``BATCH_BYTES``.

    The rows of a task stay the same, only fewer are held at once; by default 10,000 whole texts are, however long.
    A limit that the session has set holds. The setting outlives the call, since a plan reads it when it runs.
    """

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_LIMIT, None) is None:
            spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers reject go; the others stay as they are."""
    return keep_good(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    Of rows that repeat both id and text one stays. Rows with null id cannot be named by a group; all stay.
    """
    kept = near_duplicates(docs, k=5, percent=80).filter("kept").groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = Scratch(spark).put(kept, "kept")
    named = docs.join(kept, "doc_id").select(*COLUMNS, "rows")
    out = named.filter("rows = 1")
    if kept.filter("rows > 1").limit(1).count():
        out = out.unionByName(named.filter("rows > 1").dropDuplicates(["doc_id", "text"]))
    return out.unionByName(docs.filter("doc_id is null"), allowMissingColumns=True).select(*COLUMNS)


@small_batches
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; all documents stay."""
    return redact(docs.select(*COLUMNS))


@small_batches
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, by language weights; no document is used twice.

    A document without tokens takes nothing from a budget and is not selected (the first stage lets none through);
    rows with null id cannot be told apart by a budget's seeded order and stay beside it.
    """
    chosen = mix(docs, share=0.9, weights=LANGUAGE_WEIGHTS, epochs=1).select("doc_id").distinct()
    return docs.join(chosen, "doc_id", "left_semi").unionByName(docs.filter("doc_id is null")).select(*COLUMNS)


@small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return pack(docs, **tokenizer_files())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("mixture", mixture),
    ("packing", packing),
]
ORACLE_SQL = None  # a trained classifier decides the first stage; tests hold the rest against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. A stage's scratch tables go when it has been written, its own table when
    the next one has; only the last table stays."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with scope(spark, name):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.schema(out.schema).parquet(path), path
    return docs
