"""Rows to columns, columns to rows, one event to its two sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_sides(df: DataFrame, first: dict[str, Column], second: dict[str, Column], keep: list[str], tag: str = "side", tags: tuple[str, str] = ("h", "a")) -> DataFrame:
    """Two rows per event, one from each perspective, out of one scan."""
    a = F.struct(F.lit(tags[0]).alias(tag), *[c.alias(n) for n, c in first.items()])
    b = F.struct(F.lit(tags[1]).alias(tag), *[c.alias(n) for n, c in second.items()])
    return df.select(*keep, F.inline(F.array(a, b)))


def pivot_kind(df: DataFrame, keys: list[str], kind: str, kinds: list[str], values: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """``<name>_<value>`` columns: the largest value of each kind."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(kind) == k, F.col(v))).alias(f"{(names or {}).get(k, k)}_{v}" if len(values) > 1 else (names or {}).get(k, k)) for k in kinds for v in values])


def clean_name(name: str) -> str:
    return "".join(c if c.isalnum() else "_" for c in name.strip().lower()).strip("_")


def pivot_stats(df: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """Key/value rows to columns with cleaned names."""
    return df.groupBy(*keys).agg(*[F.first(F.when(F.col(name) == n, F.col(value)), ignorenulls=True).alias(clean_name(n)) for n in names])


def unpivot_groups(df: DataFrame, keep: list[str], groups: dict[str, dict[str, str]], tag: str = "source", drop_empty: bool = True) -> DataFrame:
    """One row per group of columns: groups = {tag value: {output name: column}}; absent columns are null."""
    names = list(next(iter(groups.values())))
    items = [F.struct(F.lit(g).alias(tag), *[(F.col(m[n]) if m.get(n) in df.columns else F.lit(None)).alias(n) for n in names]) for g, m in groups.items()]
    out = df.select(*keep, F.inline(F.array(*items)))
    return out.filter(F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()) if drop_empty else out


def pivot_outcomes(df: DataFrame, keys: list[str], outcome: Column, price: str, names: tuple[str, ...] = ("home", "draw", "away")) -> DataFrame:
    """The rows of a market (one per outcome) as one row."""
    return df.withColumn("_o", outcome).groupBy(*keys).agg(*[F.max(F.when(F.col("_o") == n, F.col(price))).alias(n) for n in names])


def ordered_list(c: Column | str) -> Column:
    """Sorted distinct values of a group."""
    return F.array_sort(F.collect_set(c))


def explode_csv_pairs(df: DataFrame, lists: list[str], keep: list[str], sep: str = ",") -> DataFrame:
    """Comma lists of equal length to rows; rows whose lists differ in length go."""
    parts = df.select(*keep, *[F.transform(F.split(F.col(c), sep), lambda x: F.trim(x)).alias(c) for c in lists])
    same = F.lit(True)
    for c in lists[1:]:
        same = same & (F.size(c) == F.size(lists[0]))
    return parts.filter(same).select(*keep, F.inline(F.arrays_zip(*lists)))


def union_sources(*dfs: DataFrame, by_name: bool = True) -> DataFrame:
    """All rows; columns that a source lacks are null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True) if by_name else out.union(d)
    return out


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Different rows of tables with the same columns, in any order of columns."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def histogram(df: DataFrame, keys: list[str], value: str, width: float) -> DataFrame:
    return df.groupBy(*keys, (F.floor(F.col(value) / width) * width).cast("long").alias("bucket")).agg(F.count("*").alias("n"))


def select_except(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)
