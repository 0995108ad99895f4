"""Sinks: model tables, partitioned overwrites, JDBC publication, batch versions, compaction, views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarn.sources.readers import exists


def write_model(df: DataFrame, root: str, layer: str, name: str, partition_by: list[str] | None = None, files: int | None = None) -> str:
    """Overwrites the model's table at root/layer/name; with partitions only those that ``df`` holds."""
    path = f"{root.rstrip('/')}/{layer}/{name}"
    if partition_by:
        out = df.repartition(*[F.col(c) for c in partition_by]) if files is None else df.repartition(files, *[F.col(c) for c in partition_by])
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def publish_jdbc(df: DataFrame, url: str, table: str, parts: int = 8, **options: str) -> None:
    """Replaces the rows and keeps the table, so that views on it survive; creates it on the first load."""
    df.coalesce(parts).write.format("jdbc").options(url=url, dbtable=table, truncate="true", **options).mode("overwrite").save()


def publish_batch(tables: dict[str, DataFrame], root: str, batch_id: str) -> DataFrame:
    """Each table under batch_id=... and as ``latest``, and a manifest (table, n_rows, batch_id).

    Rows are counted while they are written; ``latest`` is read back from the batch, not computed again.
    """
    spark, counts = next(iter(tables.values())).sparkSession, []
    for name, df in tables.items():
        seen = Observation(f"{name}_{batch_id}")
        path = f"{root.rstrip('/')}/{name}/batch_id={batch_id}"
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        spark.read.schema(df.schema).parquet(path).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}/latest")
        counts.append((name, seen.get["n"], batch_id))
    manifest = spark.createDataFrame(counts, "table string, n_rows long, batch_id string")
    manifest.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/manifest/batch_id={batch_id}")
    return manifest


def register_views(spark: SparkSession, root: str, names: list[str], prefix: str = "") -> list[str]:
    """A temporary view for each table below ``root`` that exists; returns their names."""
    made = []
    for n in names:
        path = f"{root.rstrip('/')}/{n}"
        if exists(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(f"{prefix}{n}")
            made.append(f"{prefix}{n}")
    return made


def compact(df: DataFrame, path: str, key: str, order: list[str], rows_per_file: int = 5_000_000) -> None:
    """Rows of many small files as a few sorted ones per key; a heavy key gets more files."""
    df.repartition(F.col(key)).sortWithinPartitions(key, *order).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(key).parquet(path)


def lake_metrics(spark: SparkSession, root: str, layer_depth: int = 1) -> DataFrame:
    """(layer, n_files, total_bytes, newest) of the files below ``root``, contents unread."""
    if not exists(spark, root):
        return spark.createDataFrame([], "layer string, n_files long, total_bytes long, newest timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime", "length")
    rest = F.regexp_replace("path", "^.*?" + root.rstrip("/").split("/")[-1] + "/", "")
    layer = F.array_join(F.slice(F.split(rest, "/"), 1, layer_depth), "/")
    return files.groupBy(layer.alias("layer")).agg(F.count("*").alias("n_files"), F.sum("length").alias("total_bytes"), F.max("modificationTime").alias("newest"))


def clean_range(df: DataFrame, cond: Column, name: str = "clean") -> tuple[DataFrame, Observation, Observation]:
    """Rows that satisfy ``cond``, with observations of the rows before and after, counted as they pass."""
    before, after = Observation(f"{name}_before"), Observation(f"{name}_after")
    out = df.observe(before, F.count(F.lit(1)).alias("n")).filter(cond).observe(after, F.count(F.lit(1)).alias("n"))
    return out, before, after
