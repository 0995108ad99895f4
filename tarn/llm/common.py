"""What several corpus operators share: scratch tables, groups from sorted batches, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCOPES: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local one only where none is set in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return "/".join([scratch_dir(spark), *_SCOPES, f"{tag}-{uuid.uuid4().hex}"])


@contextmanager
def scope(spark: SparkSession, tag: str) -> Iterator[None]:
    """Scratch tables made inside are deleted at the end; write what should stay before, outside of it."""
    _SCOPES.append(f"{tag}-{uuid.uuid4().hex}")
    path = "/".join([scratch_dir(spark), *_SCOPES])
    try:
        yield
    finally:
        _SCOPES.pop()
        remove(spark, path)


class Scratch:
    """Tables written to the shared folder: they cut the lineage and outlive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, tag: str = "t", schema: StructType | None = None) -> DataFrame:
        """``df`` written and read back, by its own schema or by another one that reads the same columns."""
        path = new_path(self.spark, tag)
        df.write.parquet(path)
        out = self.spark.read.schema(schema or df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def free(self, *dfs: DataFrame) -> None:
        for df in dfs:
            path, _ = self.paths.pop(id(df), (None, None))
            if path:
                remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The groups of equal ``key`` of batches that arrive sorted by it; one group is held at a time."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[key].to_numpy()
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(k)]
        for s, e in zip(starts, ends, strict=True):
            part = pdf.iloc[s:e]
            if held and held[-1][key].iloc[0] != k[s]:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mixer of unsigned 64-bit integers (splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links a[i]-b[i]."""
    lab = np.arange(n)
    while len(a):
        lo = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, lo)
        np.minimum.at(new, b, lo)
        new = np.minimum(new, new[new])
        if (new == lab).all():
            break
        lab = new
    return lab


def hot_join(left: DataFrame, right: DataFrame, on: str, weight: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` (unique ``on``), where ``weight`` tells how many rows of ``left`` a key has.

    Keys with over 1,000 rows and over a two-thousandth of all, so fewer than 2,000 keys, are joined by
    broadcast and never meet in one task; rows without a key do not meet either. ``weight`` is dropped.
    """
    cut = max(1000.0, float(right.agg(F.sum(weight)).first()[0] or 0) / 2000)
    hot, cold = (right.filter(c).drop(weight) for c in (F.col(weight) > cut, F.col(weight) <= cut))
    keyed = left.filter(F.col(on).isNotNull())
    parts = keyed.join(F.broadcast(hot), on).unionByName(keyed.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on, how))
    if how == "left":
        kinds = {f.name: f.dataType for f in right.schema.fields}
        none = [F.lit(None).cast(kinds[c]).alias(c) for c in hot.columns if c != on]
        parts = parts.unionByName(left.filter(F.col(on).isNull()).select("*", *none))
    return parts


def connected_components(edges: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """(id, component): the smallest id reachable from each id that occurs in a link.

    Large-star and small-star rounds over (low, high) links, each a pre-aggregated minimum and an equi
    join in which hot centres are broadcast; each round is written to the shared folder.
    """
    cur = scratch.put(
        edges.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "cc"
    )
    seen = None
    while True:
        sig = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if sig["n"] == 0 or (sig["n"], sig["h"]) == seen:
            break
        seen = (sig["n"], sig["h"])
        sym = cur.select(F.col("u").alias("x"), F.col("v").alias("y")).union(cur.select("v", "u"))
        low = scratch.put(sym.groupBy("x").agg(F.least("x", F.min("y")).alias("lo"), F.count("*").alias("c")), "low")
        large = scratch.put(hot_join(sym, low, "x", "c").filter("y > x").select(F.col("lo").alias("u"), F.col("y").alias("v")), "large")
        low2 = scratch.put(large.groupBy("v").agg(F.min("u").alias("lo"), F.count("*").alias("c")), "low")
        small = hot_join(large, low2, "v", "c").filter("u > lo").select(F.col("lo").alias("u"), F.col("u").alias("v"))
        nxt = scratch.put(low2.select(F.col("lo").alias("u"), "v").union(small).distinct(), "cc")
        scratch.free(cur, low, large, low2)
        cur = nxt
    stars = cur.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return stars.union(cur.select("u", F.col("u").alias("c")).distinct())
