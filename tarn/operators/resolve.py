"""Entity resolution: alias dictionaries, unique links, survivorship."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def small(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """``df`` to be broadcast if it is found to have at most ``most_rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def norm(c: Column | str) -> Column:
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def alias_dictionary(seed: DataFrame, not_entities: list[str] | None = None) -> DataFrame:
    """(alias, key) from (alias, team_key): aliases in lower case, every canonical name its own alias,
    keys that are no entities left out."""
    s = seed.filter(F.col("team_key").isNotNull() & (F.trim("alias") != ""))
    if not_entities:
        s = s.filter(~F.col("team_key").isin(not_entities))
    return s.select(norm("alias").alias("alias"), "team_key").union(s.select(norm("team_key"), "team_key")).distinct()


def ambiguous_aliases(alias: DataFrame) -> DataFrame:
    """Aliases with more than one key; must be empty."""
    return alias.groupBy("alias").agg(F.count_distinct("team_key").alias("n_keys")).filter("n_keys > 1")


def resolve_alias(df: DataFrame, name: str, alias: DataFrame, out: str, strict: bool = False) -> DataFrame:
    """Adds ``out``: the key of ``name``; without one the trimmed name itself, or null if ``strict``."""
    a = small(alias.select(F.col("alias").alias("_alias"), F.col("team_key").alias("_key")).dropDuplicates(["_alias"]))
    hit = df.join(a, norm(name) == F.col("_alias"), "left")
    value = F.col("_key") if strict else F.coalesce("_key", F.trim(name))
    return hit.withColumn(out, value).drop("_alias", "_key")


def resolve_by_source(df: DataFrame, name: str, source: str | Column, alias: DataFrame, out: str) -> DataFrame:
    """The alias of the same source first, then of any source (smallest key), then the trimmed name."""
    own = small(alias.groupBy(norm("alias").alias("_a1"), F.col("source").alias("_s1")).agg(F.min("team_key").alias("_k1")))
    any_ = small(alias.groupBy(norm("alias").alias("_a2")).agg(F.min("team_key").alias("_k2")))
    s = F.col(source) if isinstance(source, str) else source
    j = df.join(own, (norm(name) == F.col("_a1")) & (s == F.col("_s1")), "left").join(any_, norm(name) == F.col("_a2"), "left")
    return j.withColumn(out, F.coalesce("_k1", "_k2", F.trim(name))).drop("_a1", "_s1", "_k1", "_a2", "_k2")


def mapped_flag(df: DataFrame, name: str, alias: DataFrame, out: str = "is_mapped") -> DataFrame:
    a = small(alias.select(F.col("alias").alias("_alias")).distinct().withColumn("_hit", F.lit(True)))
    return df.join(a, norm(name) == F.col("_alias"), "left").withColumn(out, F.col("_hit").isNotNull()).drop("_alias", "_hit")


def unmapped_report(names: DataFrame, name: str, source: str, alias: DataFrame) -> DataFrame:
    """(source, raw_name, n_rows) of names without an alias."""
    a = alias.select(F.col("alias").alias("_alias")).distinct()
    some = names.filter(F.trim(name) != "").groupBy(F.col(source).alias("source"), F.col(name).alias("raw_name")).agg(F.count("*").alias("n_rows"))
    return some.join(a, norm("raw_name") == F.col("_alias"), "left_anti")


def link_unique(df: DataFrame, ref: DataFrame, df_id: str, ref_id: str, rules: list[tuple[list[str], list[str]]]) -> DataFrame:
    """(df_id, ref_id) where any rule (columns of df equal columns of ref) finds exactly one candidate.

    A disjunction of equalities would be a nested loop; one equi join per rule is not.
    """
    found = None
    for left, right in rules:
        r = ref.select(F.col(ref_id).alias("_ref"), *[F.col(c).alias(f"_r{i}") for i, c in enumerate(right)]).distinct()
        on = [F.col(c) == F.col(f"_r{i}") for i, c in enumerate(left)]
        hits = df.select(df_id, *left).join(r, on).select(df_id, "_ref")
        found = hits if found is None else found.union(hits)
    one = found.distinct().groupBy(df_id).agg(F.min("_ref").alias(ref_id), F.count("*").alias("_n"))
    return one.filter("_n = 1").drop("_n")


def survive(df: DataFrame, keys: list[str], prio: str, attrs: list[str]) -> DataFrame:
    """Per key and attribute the value of the source with the smallest ``prio`` that has one; equal
    priorities take the smallest value."""
    return df.groupBy(*keys).agg(*[F.min(F.when(F.col(a).isNotNull(), F.struct(F.col(prio).alias("p"), F.col(a).alias("v"))))["v"].alias(a) for a in attrs])


def source_ids(df: DataFrame, keys: list[str], source: str, ident: str, sources: list[str]) -> DataFrame:
    """``<source>_id`` columns: each source's largest id."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(source) == s, F.col(ident))).alias(f"{s}_id") for s in sources])


def best_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    from tarn.operators.snapshot import latest

    return latest(df, keys, order)


def name_variants(df: DataFrame, name: str, rewrites: list[Column], keep: list[str]) -> DataFrame:
    """(keep, rank, variant): candidate keys of a name in the order of preference."""
    items = [F.struct(F.lit(i).alias("rank"), c.alias("variant")) for i, c in enumerate([F.col(name), *rewrites])]
    return df.select(*keep, F.inline(F.array(*items))).filter(F.col("variant").isNotNull() & (F.col("variant") != ""))


def first_variant_hit(variants: DataFrame, keep: list[str], dictionary: DataFrame, key: str, value: str) -> DataFrame:
    """The value of each row's first variant that the dictionary knows."""
    d = small(dictionary.select(F.col(key).alias("variant"), F.col(value).alias("_v")).dropDuplicates(["variant"]))
    return variants.join(d, "variant").groupBy(*keep).agg(F.min_by("_v", "rank").alias(value))
