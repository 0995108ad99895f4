"""Change data capture: parsing events, dead letters, idempotent bronze files, current state.

The order of a key's events is (lsn, offset), so replays and late arrivals change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tarn.operators.resolve import small

DEAD_BYTES = 100_000


def cdc_stream(spark: SparkSession, source: str = "kafka", schema: str | None = None, path: str | None = None, **options: str) -> DataFrame:
    """A stream of (topic, partition, offset, value): from a broker, or from files in tests."""
    r = spark.readStream.format(source).options(**options)
    df = (r.schema(schema).load(path)) if schema else r.load()
    return df.select(F.col("topic"), F.col("partition"), F.col("offset"), F.col("value").cast("string").alias("value"), F.col("value").cast("binary").alias("raw"))


def parse_events(messages: DataFrame) -> DataFrame:
    """Adds the fields of a change event, with or without envelope, and ``status``: ok, tombstone or bad."""
    doc = F.try_parse_json("value")
    ev = messages.withColumn("_d", doc).withColumn("_e", F.coalesce(F.try_variant_get("_d", "$.payload", "variant"), F.col("_d")))
    get = lambda p, t="string": F.try_variant_get("_e", p, t)
    status = F.when(F.col("value").isNull(), "tombstone").when(F.col("_d").isNull() | get("$.op").isNull(), "bad").otherwise("ok")
    return ev.select(
        *messages.columns, F.element_at(F.split("topic", r"\."), -1).alias("table"), get("$.op").alias("op"), F.to_json(F.try_variant_get("_e", "$.before", "variant")).alias("before"),
        F.to_json(F.try_variant_get("_e", "$.after", "variant")).alias("after"), get("$.ts_ms", "bigint").alias("ts_ms"), get("$.source.lsn", "bigint").alias("lsn"),
        get("$.source.txId", "bigint").alias("tx_id"), get("$.source.snapshot").alias("snapshot"), status.alias("status"),
    )


EVENT = ["op", "before", "after", "ts_ms", "lsn", "tx_id", "snapshot", "partition", "offset"]


def write_batches(batch: DataFrame, root: str) -> None:
    """Good events to bronze and bad messages to dead_letter, in folders named by their offsets.

    The same offsets give the same folder, so a batch that is written again replaces itself; tombstones
    only move the offset on.
    """
    parsed = parse_events(batch).persist()
    try:
        for kind, cond, cols in (("bronze", "status = 'ok'", ["table", "topic", *EVENT]), ("dead_letter", "status = 'bad'", None)):
            part = parsed.filter(cond)
            if cols is None:
                raw = F.coalesce("raw", F.encode(F.coalesce("value", F.lit("")), "utf-8"))
                part = part.select("table", "topic", "partition", "offset", F.base64(F.substring(raw, 1, DEAD_BYTES)).alias("payload"), F.octet_length(raw).alias("n_bytes"))
            else:
                part = part.select(*cols)
            spans = part.groupBy("table", "partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
            named = part.join(small(spans), ["table", "partition"])
            out = named.withColumns({"kafka_partition": F.col("partition"), "range": F.format_string("%012d-%012d", "lo", "hi"), "table_name": F.col("table")}).drop("lo", "hi")
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "kafka_partition", "range").parquet(f"{root.rstrip('/')}/{kind}")
    finally:
        parsed.unpersist()


def run_bronze(stream: DataFrame, root: str, checkpoint: str):
    """One pass over what has arrived; offsets are committed after the files, so nothing is lost."""
    return stream.writeStream.foreachBatch(lambda b, _: write_batches(b, root)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keyed(events: DataFrame, pk: str) -> DataFrame:
    """Adds ``key`` from the new or else the old row image."""
    at = lambda c: F.try_variant_get(F.try_parse_json(c), f"$.{pk}", "string")
    return events.withColumn("key", F.coalesce(at("after"), at("before")))


def current_state(events: DataFrame, pk: str) -> DataFrame:
    """(key, after, ts_ms, lsn, offset): each key's newest row image; deleted keys are gone, null keys too.

    One pre-aggregated maximum by (lsn, offset): no sort, and repeated events change nothing.
    """
    e = keyed(events, pk).filter("key is not null")
    order = F.struct(F.coalesce("lsn", F.lit(-1)).alias("lsn"), F.coalesce("offset", F.lit(-1)).alias("offset"))
    newest = e.groupBy("key").agg(F.max_by(F.struct("op", "after", "ts_ms", "lsn", "offset"), order).alias("n"))
    return newest.filter("n.op <> 'd'").select("key", "n.after", "n.ts_ms", "n.lsn", "n.offset")


class CurrentState(StatefulProcessor):
    """Newest (lsn, offset) of a key; emits op and row image when it moves on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", "lsn long, offset long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        best, known = None, tuple(self.state.get()) if self.state.exists() else (-2, -2)
        for pdf in rows:
            for r in pdf.itertuples(index=False):
                at = (-1 if pd.isna(r.lsn) else int(r.lsn), -1 if pd.isna(r.offset) else int(r.offset))
                if at > known:
                    known, best = at, r
        if best is not None:
            self.state.update(known)
            yield pd.DataFrame({"key": [key[0]], "op": [best.op], "after": [best.after], "lsn": [known[0]], "offset": [known[1]]})

    def close(self) -> None:
        pass


def state_changes(stream: DataFrame, pk: str) -> DataFrame:
    """Streaming form of ``current_state``: an update row whenever a key's newest event moves on."""
    e = keyed(stream, pk).filter("key is not null").select("key", "op", "after", "lsn", "offset")
    return e.groupBy("key").transformWithStateInPandas(CurrentState(), "key string, op string, after string, lsn long, offset long", "Update", "None")


def merge_state(target: DataFrame, events: DataFrame, pk: str) -> DataFrame:
    """The state table (with ``op``) after a micro-batch; for foreachBatch sinks without per-key state."""
    cols = ["key", "op", "after", "ts_ms", "lsn", "offset"]
    both = target.select(*cols).unionByName(keyed(events, pk).filter("key is not null").select(*cols))
    order = F.struct(F.coalesce("lsn", F.lit(-1)).alias("lsn"), F.coalesce("offset", F.lit(-1)).alias("offset"))
    return both.groupBy("key").agg(F.max_by(F.struct(*cols[1:]), order).alias("n")).select("key", "n.*")
