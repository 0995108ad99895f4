"""Data-quality rules as violation tables: empty means the rule holds."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """name, a function from the table to its violations, and ``error`` or ``warn``."""

    name: str
    violations: Callable[[DataFrame], DataFrame]
    severity: str = "error"


def not_null(*cols: str) -> Rule:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return Rule(f"not_null({','.join(cols)})", lambda df: df.filter(cond))


def unique(*cols: str) -> Rule:
    """No two rows agree in all columns; null keys are not compared."""
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    return Rule(f"unique({','.join(cols)})", lambda df: df.filter(known).groupBy(*cols).count().filter("count > 1"))


def accepted_values(col: str, values: list) -> Rule:
    return Rule(f"accepted_values({col})", lambda df: df.filter(F.col(col).isNotNull() & ~F.col(col).isin(values)))


def relationship(col: str, parent: DataFrame, parent_col: str) -> Rule:
    keys = parent.select(F.col(parent_col).alias("_key")).distinct()
    return Rule(f"relationship({col})", lambda df: df.filter(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("_key"), "left_anti"))


def expression(name: str, cond: Column, severity: str = "error") -> Rule:
    """Rows where the condition is false; unknown (null) passes."""
    return Rule(name, lambda df: df.filter(~cond), severity)


def report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, severity, n_violations)."""
    out = None
    for r in rules:
        one = r.violations(df).agg(F.count("*").alias("n_violations")).select(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), "n_violations")
        out = one if out is None else out.unionByName(one)
    return out


def enforce(df: DataFrame, rules: list[Rule]) -> list[str]:
    """Raises for violated error rules; returns the names of violated warnings."""
    bad = report(df, rules).filter("n_violations > 0").collect()
    errors = [f"{r['rule']}: {r['n_violations']}" for r in bad if r["severity"] == "error"]
    if errors:
        raise ValueError("; ".join(errors))
    return [r["rule"] for r in bad]


def assert_grain(df: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """``df`` itself if its keys are unique and it has the expected rows."""
    r = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (r["most"] or 0) > 1:
        raise ValueError(f"keys {keys} are not unique")
    if rows is not None and (r["rows"] or 0) != rows:
        raise ValueError(f"{r['rows']} rows instead of {rows}")
    return df


def split_overlap(df: DataFrame, split: str, day: str, order: list[str]) -> DataFrame:
    """Pairs of consecutive splits whose date ranges touch or cross."""
    r = df.groupBy(split).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    out = None
    for a, b in zip(order[:-1], order[1:], strict=True):
        x, y = r.filter(F.col(split) == a), r.filter(F.col(split) == b)
        one = x.select(F.lit(f"{a}/{b}").alias("splits"), F.col("hi").alias("first_ends")).crossJoin(y.select(F.col("lo").alias("next_starts"))).filter("first_ends >= next_starts")
        out = one if out is None else out.union(one)
    return out


def side_balance(df: DataFrame, key: str, side: str, sides: tuple[str, str] = ("h", "a")) -> DataFrame:
    """Keys that do not have exactly one row of either side."""
    c = [F.count(F.when(F.col(side) == s, 1)).alias(f"n_{s}") for s in sides]
    return df.groupBy(key).agg(*c, F.count("*").alias("n")).filter((F.col(f"n_{sides[0]}") != 1) | (F.col(f"n_{sides[1]}") != 1) | (F.col("n") != 2))


def snapshot_violations(df: DataFrame, key: str, day: str, label: str) -> DataFrame:
    """(violation, n) of a training snapshot: wrong split, late label, duplicate, empty split, missing class."""
    d = F.col(day)
    want = F.when(d <= F.col("training_train_end"), "train").when(d <= F.col("training_valid_end"), "valid").when(d <= F.col("training_data_as_of"), "test")
    checks = {
        "wrong_split": ~want.eqNullSafe(F.col("split")),
        "late_label": F.coalesce(F.col("training_label_known_ts") >= F.col("training_label_cutoff_ts"), F.lit(True)),
        "no_label": F.col(label).isNull(),
        "window_order": ~((F.col("training_train_end") < F.col("training_valid_start")) & (F.col("training_valid_end") < F.col("training_test_start"))),
    }
    one = df.agg(F.array(*[F.struct(F.lit(n).alias("violation"), F.count(F.when(c, 1)).alias("n")) for n, c in checks.items()], F.struct(F.lit("windows").alias("violation"), (F.count_distinct("training_window_id") - 1).alias("n")), F.struct(F.lit("empty_split").alias("violation"), (3 - F.count_distinct("split")).alias("n"))).alias("c")).select(F.inline("c"))
    dup = df.groupBy(key).count().filter("count > 1").agg(F.count("*").alias("n")).select(F.lit("duplicate_key").alias("violation"), "n")
    classes = df.agg((F.count_distinct(label) - F.count_distinct(F.when(F.col("split") == "train", F.col(label)))).alias("n")).select(F.lit("class_missing_in_train").alias("violation"), "n")
    return one.unionByName(dup).unionByName(classes).filter("n <> 0")


def schema_drift(headers: DataFrame, group: str, name: str) -> DataFrame:
    """(group, column, change) against the group before, from rows (group, column name)."""
    seen = headers.select(group, name).distinct()
    groups = seen.select(group).distinct()
    nxt = groups.withColumn("_next", F.lead(group).over(Window.orderBy(group))).filter("_next is not null")  # one row a group
    before = seen.join(nxt, group).select(F.col("_next").alias(group), name)
    added = seen.join(groups.join(nxt.select(F.col("_next").alias(group)).distinct(), group, "left_semi"), group, "left_semi").join(before, [group, name], "left_anti").withColumn("change", F.lit("added"))
    removed = before.join(seen, [group, name], "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def layer_counts(layers: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, one count column per layer, is_even) to see where rows get lost."""
    out = None
    for name, df in layers.items():
        one = df.groupBy(key).agg(F.count("*").alias(name))
        out = one if out is None else out.join(one, key, "outer")
    out = out.fillna(0, list(layers))
    names = list(layers)
    same = F.lit(True)
    for n in names[1:]:
        same = same & (F.col(n) == F.col(names[0]))
    return out.withColumn("is_even", same)


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(n_rows, xor, total): the same for any order and partitioning of the rows."""
    h = F.xxhash64(*[F.col(c) for c in (cols or sorted(df.columns))])
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(h).alias("xor"), F.sum(F.pmod(h, F.lit(1_000_000_007))).alias("total"))
