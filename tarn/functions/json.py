"""Values out of semi-structured documents held as VARIANT columns; a bad cell is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def jget(doc: Column | str, path: str, kind: str = "string") -> Column:
    """Scalar at ``path``, cast if it can be."""
    if kind == "string":
        return F.try_variant_get(doc, path, "string")
    return F.coalesce(F.try_variant_get(doc, path, kind), F.try_variant_get(doc, path, "string").try_cast(kind))


def _no_zone(text: Column) -> Column:
    return F.regexp_replace(text, r"(Z|[+-]00:?00)$", "").try_cast("timestamp_ntz")


def jts(doc: Column | str, path: str) -> Column:
    """ISO-8601 text as a zone-less UTC timestamp."""
    return _no_zone(F.try_variant_get(doc, path, "string"))


def cdc_ts(doc: Column | str, path: str) -> Column:
    """Timestamp of a change log: ISO text, or microseconds since 1970."""
    text = F.try_variant_get(doc, path, "string")
    return F.coalesce(F.when(~text.rlike(r"^-?\d+$"), _no_zone(text)), F.timestamp_micros(text.try_cast("bigint")).cast("timestamp_ntz"))


def path_part(key: str, path: Column | str = "path") -> Column:
    """Value of ``key=value`` in a file path; null if there is none."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){key}=([^/]*)", 1), F.lit(""))


def path_date(key: str = "ingest_date", path: Column | str = "path") -> Column:
    return F.left(path_part(key, path), F.lit(10)).try_cast("date")


def explode_array(df: DataFrame, doc: str, path: str, alias: str = "item", keep: list[str] | None = None) -> DataFrame:
    """One row per element of the array at ``path``; none where it is missing. ``keep``: columns to carry."""
    keep = [c for c in df.columns if c != doc] if keep is None else keep
    return df.select(*keep, F.explode(F.try_variant_get(doc, path, "array<variant>")).alias(alias))


def explode_path(df: DataFrame, doc: str, paths: list[str], aliases: list[str], keep: list[str] | None = None) -> DataFrame:
    """Chained explosion: each path starts at the element of the one before; all levels stay as columns."""
    keep = [c for c in df.columns if c != doc] if keep is None else list(keep)
    out, at = df, doc
    for path, alias in zip(paths, aliases, strict=True):
        out = explode_array(out, at, path, alias, keep + ([at] if at != doc else []))
        if at != doc:
            keep = [*keep, at]
        at = alias
    return out


def explode_parallel(df: DataFrame, doc: str, fields: dict[str, tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """Parallel arrays to rows; shorter arrays are padded with nulls."""
    keep = [c for c in df.columns if c != doc] if keep is None else keep
    names = list(fields)
    cast = lambda kind: lambda v: jget(v, "$", kind)
    none = F.array().cast("array<variant>")
    arrays = [F.transform(F.coalesce(F.try_variant_get(doc, path, "array<variant>"), none), cast(kind)).alias(n) for n, (path, kind) in fields.items()]
    return df.select(*keep, *arrays).select(*keep, F.inline(F.arrays_zip(*names)))


def explode_map(df: DataFrame, doc: str, path: str = "$", key: str = "key", value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Entries of an object whose keys are data."""
    keep = [c for c in df.columns if c != doc] if keep is None else keep
    return df.select(*keep, F.explode(F.try_variant_get(doc, path, "map<string,variant>")).alias(key, value))


def explode_named(df: DataFrame, doc: str, path: str, names: list[str], alias: str = "item", keep: list[str] | None = None) -> DataFrame:
    """Array elements with the name of their position (``table_name``); positions beyond the names are null."""
    keep = [c for c in df.columns if c != doc] if keep is None else keep
    pos = df.select(*keep, F.posexplode(F.try_variant_get(doc, path, "array<variant>")).alias("pos", alias))
    return pos.select(*keep, "pos", F.get(F.array(*[F.lit(n) for n in names]), F.col("pos")).alias("table_name"), alias)


def explode_sides(df: DataFrame, doc: str, sides: dict[str, str], alias: str = "item", keep: list[str] | None = None) -> DataFrame:
    """Elements of several array fields, tagged by side, out of one scan."""
    keep = [c for c in df.columns if c != doc] if keep is None else keep
    tag = lambda side: lambda v: F.struct(F.lit(side).alias("side"), v.alias(alias))
    none = F.array().cast("array<variant>")
    tagged = F.concat(*[F.transform(F.coalesce(F.try_variant_get(doc, p, "array<variant>"), none), tag(s)) for s, p in sides.items()])
    return df.select(*keep, F.inline(tagged))


def array_or_self(df: DataFrame, doc: str, path: str, alias: str = "item", keep: list[str] | None = None) -> DataFrame:
    """Elements of the wrapped array, or the document itself where it has none."""
    keep = [c for c in df.columns if c != doc] if keep is None else keep
    return df.select(*keep, F.explode(F.coalesce(F.try_variant_get(doc, path, "array<variant>"), F.array(F.col(doc)))).alias(alias))


def rdf_value(item: Column | str, name: str) -> Column:
    return F.try_variant_get(item, f"$.{name}.value", "string")


def rdf_qid(item: Column | str, name: str) -> Column:
    """Entity id at the end of an entity address."""
    return F.nullif(F.regexp_extract(rdf_value(item, name), r"(Q[0-9]+)$", 1), F.lit(""))


def rdf_point(item: Column | str, name: str, axis: str) -> Column:
    """Longitude (``lon``) or latitude (``lat``) of ``Point(lon lat)``."""
    return F.regexp_extract(rdf_value(item, name), r"Point\(([-0-9.]+) ([-0-9.]+)\)", 1 if axis == "lon" else 2).try_cast("double")


def rdf_date(item: Column | str, name: str) -> Column:
    return F.left(rdf_value(item, name), F.lit(10)).try_cast("date")


def flatten_bindings(df: DataFrame, doc: str, names: list[str], path: str = "$.results.bindings", keep: list[str] | None = None) -> DataFrame:
    """Query results (name -> type, value) to flat rows, with a ``<name>_qid`` where the value is an entity."""
    rows = explode_array(df, doc, path, "item", keep)
    cols = [x for n in names for x in (rdf_value("item", n).alias(n), rdf_qid("item", n).alias(f"{n}_qid"))]
    return rows.select(*[c for c in rows.columns if c != "item"], *cols)
