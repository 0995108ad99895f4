"""Newest snapshots, keyed upserts and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (spell nulls last yourself)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_batch(df: DataFrame, keys: list[str], batch: Column) -> DataFrame:
    """All rows of each key's newest batch: those with its largest ``batch``, or all if it has none.

    One pre-aggregated maximum and an equi join, so a key with few values never gathers in one task.
    """
    rows = df.withColumn("_b", batch)
    newest = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max("_b").alias("_newest"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_b").eqNullSafe(F.col("_newest"))]
    return rows.join(newest, on, "left_semi").drop("_b")


def latest_by(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Like ``latest`` with the largest ``by``, as one pre-aggregated maximum without a sort per key."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)


def upsert_diff(target: DataFrame, source: DataFrame, keys: list[str], ignore: list[str] | None = None) -> DataFrame:
    """Rows of ``source`` with ``action``: insert, update (a column outside ``ignore`` differs) or unchanged."""
    cols = [c for c in source.columns if c not in keys]
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_there"))
    on = [F.col(k) == F.col(f"_t_{k}") for k in keys]
    same = F.lit(True)
    for c in cols:
        if c not in (ignore or []):
            same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    action = F.when(F.col("_there").isNull(), "insert").when(same, "unchanged").otherwise("update")
    return source.join(t, on, "left").select(*source.columns, action.alias("action"))


def apply_upsert(target: DataFrame, diff: DataFrame, keys: list[str]) -> DataFrame:
    """The target after the inserts and updates of ``diff``."""
    changed = diff.filter("action <> 'unchanged'").drop("action")
    return target.join(changed.select(*keys), keys, "left_anti").unionByName(changed)


def orphans(target: DataFrame, source: DataFrame, keys: list[str], parent: str | None = None, full: bool = False) -> DataFrame:
    """Rows of ``target`` that are to go: absent from ``source`` and of a parent that it holds; with
    ``full``, of any parent, unless ``source`` is empty."""
    gone = target.join(source.select(*keys).distinct(), keys, "left_anti")
    if full:
        some = source.limit(1).select(F.lit(1).alias("_some"))
        return gone.crossJoin(F.broadcast(some)).drop("_some")
    return gone.join(source.select(parent).distinct(), parent, "left_semi").select(*target.columns)


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, issue, column, a_value, b_value): keys of ``a`` missing in ``b``, and differing values."""
    bb = b.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in values], F.lit(True).alias("_in_b"))
    j = a.select(*keys, *values).join(bb, keys, "left")
    issues = [F.when(F.col("_in_b").isNull(), F.struct(F.lit("missing").alias("issue"), F.lit("").alias("column"), F.lit(None).cast("string").alias("a_value"), F.lit(None).cast("string").alias("b_value")))]
    for v in values:
        differs = F.col("_in_b").isNotNull() & ~F.col(v).eqNullSafe(F.col(f"_b_{v}"))
        issues.append(F.when(differs, F.struct(F.lit("mismatch").alias("issue"), F.lit(v).alias("column"), F.col(v).cast("string").alias("a_value"), F.col(f"_b_{v}").cast("string").alias("b_value"))))
    return j.select(*keys, F.inline(F.array_compact(F.array(*issues))))
