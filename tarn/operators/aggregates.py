"""Aggregations that keep nulls meaningful: paired ratios, coverage, trends, profiles, league tables."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.exprs import overround
from tarn.operators.resolve import small
from tarn.session import cut_lineage


def sum_if(cond: Column, value: Column | str) -> Column:
    return F.sum(F.when(cond, F.col(value) if isinstance(value, str) else value))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def ratio_of_sums(num: str, den: str, pair: bool = True) -> Column:
    """sum(num) / sum(den); with ``pair`` over rows where both are there. Null without such rows."""
    both = F.col(num).isNotNull() & F.col(den).isNotNull()
    n, d = (F.when(both, F.col(num)), F.when(both, F.col(den))) if pair else (F.col(num), F.col(den))
    return F.sum(n) / F.nullif(F.sum(d).cast("double"), F.lit(0.0))


def observed(value: str) -> tuple[Column, Column]:
    """(total, observations): the total is null without any observation."""
    return F.sum(value), F.count(value)


def rollup_sides(df: DataFrame, keys: list[str], side: str, metrics: list[str], sides: dict[str, str]) -> DataFrame:
    """total_, and one slice per side, of row counts and sums, in one aggregation."""
    aggs = [F.count("*").alias("total_rows"), *[F.sum(m).alias(f"total_{m}") for m in metrics]]
    for value, name in sides.items():
        cond = F.col(side) == value
        aggs += [count_if(cond).alias(f"{name}_rows"), *[sum_if(cond, m).alias(f"{name}_{m}") for m in metrics]]
    return df.groupBy(*keys).agg(*aggs)


def league_table(sides: DataFrame, keys: list[str], entity: str, gf: str = "goals_for", ga: str = "goals_against") -> DataFrame:
    """Played, won, drawn, lost, goals and points from two rows per match; unplayed matches do not count."""
    done = sides.filter(F.col(gf).isNotNull() & F.col(ga).isNotNull())
    f, a = F.col(gf), F.col(ga)
    return done.groupBy(*keys, entity).agg(
        F.count("*").alias("played"), count_if(f > a).alias("won"), count_if(f == a).alias("drawn"), count_if(f < a).alias("lost"),
        F.sum(f).alias("goals_for"), F.sum(a).alias("goals_against"), F.sum(f - a).alias("goal_difference"),
        F.sum(F.when(f > a, 3).when(f == a, 1).otherwise(0)).alias("points"),
    )


def sentiment_metrics(df: DataFrame, keys: list[str], label: str = "sentiment_label", weight: str | None = None) -> DataFrame:
    """Documents per label, rates and balance; null keys are a group."""
    n = F.count("*")
    aggs = [n.alias("documents")]
    for k in ("negative", "neutral", "positive"):
        aggs.append(count_if(F.col(label) == k).alias(k))
    if weight:
        aggs.append(F.sum(weight).alias("engagement"))
    out = df.groupBy(*keys).agg(*aggs)
    return out.withColumns({"negative_rate": F.col("negative") / F.col("documents"), "positive_rate": F.col("positive") / F.col("documents"), "balance": (F.col("positive") - F.col("negative")) / F.col("documents")})


def trend(df: DataFrame, keys: list[str], day: str, days: int, today: Column | None = None, over: list[str] | None = None, least: int = 1, lift: float = 1.25) -> DataFrame:
    """Counts of the recent and the previous window, their shares within ``over``, lift, delta and score."""
    if today is None:
        df = df.crossJoin(F.broadcast(df.agg(F.max(day).alias("_today"))))
        today = F.col("_today")
    age = F.datediff(today, F.col(day))
    sums = df.groupBy(*keys).agg(count_if((age >= 0) & (age < days)).alias("recent"), count_if((age >= days) & (age < 2 * days)).alias("previous"))
    sums = sums.filter("recent + previous > 0")
    tot = sums.groupBy(*over).agg(F.sum("recent").alias("_r"), F.sum("previous").alias("_p")) if over else sums.agg(F.sum("recent").alias("_r"), F.sum("previous").alias("_p"))
    j = sums.join(tot, over) if over else sums.crossJoin(F.broadcast(tot))
    share_r, share_p = F.col("recent") / F.nullif("_r", F.lit(0)), F.coalesce(F.col("previous") / F.nullif("_p", F.lit(0)), F.lit(0.0))
    j = j.withColumns({"recent_share": share_r, "previous_share": share_p})
    j = j.withColumns({"share_lift": F.col("recent_share") / F.greatest(F.col("previous_share"), F.lit(0.01)), "share_delta": F.col("recent_share") - F.col("previous_share")})
    growing = (F.col("recent") >= least) & (F.col("share_lift") >= lift)
    return j.withColumns({"score": F.col("share_lift") * F.log1p("recent"), "is_growing": growing}).drop("_r", "_p")


def macro_trend(by_source: DataFrame, keys: list[str]) -> DataFrame:
    """Mean over sources of the shares that ``trend`` gives per source."""
    return by_source.groupBy(*keys).agg(F.avg("recent_share").alias("recent_share"), F.avg("previous_share").alias("previous_share"))


def burst_alerts(trends: DataFrame, metrics: DataFrame, keys: list[str], negative_rate: float = 0.4) -> DataFrame:
    """Growing groups of which many documents are negative."""
    return trends.filter("is_growing").join(metrics.filter(F.col("negative_rate") >= negative_rate).select(*keys, "negative_rate"), keys)


def corr_tripwire(df: DataFrame, features: list[str], label: str, most: float = 0.55, least: int = 500) -> DataFrame:
    """(feature, r, n) of features whose correlation with the label is suspiciously high; one pass."""
    cells = []
    for f in features:
        both = F.col(f).isNotNull() & F.col(label).isNotNull()
        x, y = F.when(both, F.col(f).cast("double")), F.when(both, F.col(label).cast("double"))
        r = F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))  # null for a constant
        cells.append(F.struct(F.lit(f).alias("feature"), r.alias("r"), F.count(x).alias("n")))
    one = df.agg(F.array(*cells).alias("c")).select(F.inline("c"))
    return one.filter(F.col("r").isNotNull() & ~F.isnan("r") & (F.col("n") >= least) & (F.abs("r") > most))


def coverage(df: DataFrame, keys: list[str], cols: list[str], digits: int = 4) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[F.round(F.avg(F.col(c).isNotNull().cast("int")), digits).alias(f"{c}_rate") for c in cols])


def quantile_dates(df: DataFrame, day: str, at: list[float]) -> DataFrame:
    e = F.unix_date(F.col(day).cast("date"))
    return df.agg(*[F.date_from_unix_date(F.floor(F.percentile(e, q)).cast("int")).alias(f"q{round(q * 100)}") for q in at])


def dup_by_hash(df: DataFrame, content: str, ident: str, least: int = 2) -> DataFrame:
    """(hash, n, first_id) of contents that occur ``least`` times or more."""
    return df.groupBy(F.md5(F.col(content).cast("binary")).alias("hash")).agg(F.count("*").alias("n"), F.min(ident).alias("first_id")).filter(F.col("n") >= least)


def profile(df: DataFrame, approx: bool = True) -> DataFrame:
    """(column, n_rows, n_null, n_distinct, min, max), one pass over the table."""
    cells = []
    for name, kind in df.dtypes:
        if kind.startswith(("array", "map", "struct", "variant", "binary")):
            continue
        c = F.col(f"`{name}`")
        distinct = F.approx_count_distinct(c) if approx else F.count_distinct(c)
        cells.append(F.struct(F.lit(name).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count(F.when(c.isNull(), 1)).alias("n_null"), distinct.alias("n_distinct"), F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max")))
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, at: list[float], enough: int = 1_000_000, bins: int = 1024) -> DataFrame:
    """(keys, q0, q1, ...): exact quantiles with linear interpolation, nulls and NaN left out.

    Where no key has more than ``enough`` values, they fit one buffer and the built-in aggregate does. Else every
    order statistic that a quantile needs is boxed in: rows are counted in ``bins`` equal parts of its range, the
    part that holds it becomes its range, and so on until no range holds more than ``enough`` rows or more than
    one value. Each pass keeps at most ``bins`` counters a key and order statistic, combined before the shuffle;
    what is left of a range is then ranked by its distinct values. Keys may be few or many, hot or not.
    """
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= enough:
        return rows.groupBy(*keys).agg(*[F.percentile("_v", q).alias(f"q{i}") for i, q in enumerate(at)])
    ranks = F.explode(F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place), F.ceil(place)) for place in [(F.col("n") - 1) * q for q in at]]))))
    boxes = sizes.select(*keys, "n", ranks.alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    same = lambda a, b: reduce(and_, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys], F.lit(True))
    held = lambda: rows.alias("r").join(small(boxes).alias("b"), same("r", "b") & F.col("_v").between(F.col("lo"), F.col("hi"))).select(*[F.col(f"b.{k}").alias(k) for k in keys], "n", "rank", "lo", "hi", "below", "_v")
    before = Window.partitionBy(*keys, "rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def chosen(parts: DataFrame) -> DataFrame:
        """Of the parts of each box, in order, the one that holds the wanted rank."""
        parts = parts.withColumn("below", F.col("below") + F.coalesce(F.sum("inside").over(before), F.lit(0)))
        return parts.filter((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("inside")))

    last, kinds = None, boxes.schema
    while True:
        open_rows = boxes.filter("inside > 1 and lo < hi").agg(F.max("inside")).first()[0] or 0
        if open_rows <= enough or open_rows == last:
            break
        last = open_rows
        width = F.col("hi") / bins - F.col("lo") / bins
        part = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("_v") / bins - F.col("lo") / bins) / width * bins), F.lit(bins - 1))).otherwise(F.lit(0))
        parts = held().groupBy(*keys, "n", "rank", "below", part.alias("part")).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("inside"))
        boxes = chosen(parts).select(*[f.name for f in kinds])
        boxes = cut_lineage(boxes)  # one row a key and order statistic
    found = chosen(held().groupBy(*keys, "n", "rank", "below", F.col("_v").alias("part")).agg(F.count("*").alias("inside")))
    values = found.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct(F.col("rank").alias("key"), F.col("part").alias("value")))).alias("at"))

    def between(q: float) -> Column:
        place = (F.col("n") - 1) * q
        low, high = (F.col("at")[f(place)] for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (place - F.floor(place)) * (high - low))

    return values.select(*keys, *[between(q).alias(f"q{i}") for i, q in enumerate(at)])


def calibration(df: DataFrame, p: str, y: str, bins: int = 10, enough: int = 1_000_000) -> DataFrame:
    """Mean prediction and outcome per bin of equal count, from exact cut points instead of a global sort."""
    cuts = exact_quantiles(df, [], p, [i / bins for i in range(1, bins)], enough)
    cuts = cuts.select(F.array(*[f"q{i}" for i in range(bins - 1)]).alias("_c"))  # one row
    at = F.size(F.filter("_c", lambda c: c < F.col(p)))
    return df.filter(F.col(p).isNotNull()).crossJoin(F.broadcast(cuts)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(y).cast("double")).alias("mean_y"))


def rank_desc(df: DataFrame, keys: list[str], score: str, tie: list[str], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(score).desc_nulls_last(), *tie)))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


EARTH_KM = 6371.0


def _chord(arc_km: float) -> float:
    return 2 * EARTH_KM * math.sin(min(math.pi / 2, arc_km / (2 * EARTH_KM)))


def pairwise_nearest(df: DataFrame, ident: str, lat: str, lon: str, n: int = 10) -> DataFrame:
    """(<ident>_a, <ident>_b, km): the ``n`` nearest pairs of places, a before b; ties by both ids.

    Places lie in grids of cubes around the globe, each four times as wide as the one before. One counting pass
    gives, for every grid, the number of pairs that share a cube; the finest grid with ``n`` of them proves that
    the ``n`` nearest pairs are no farther apart than its cubes' diagonal. Only places in neighbouring cubes of
    that size are compared. In the next finer grid fewer than ``n`` pairs share a cube, so no cube holds more than
    about sqrt(2n) places: the comparisons grow with the places, not with their square. Of places at the same
    point the n + 1 smallest ids can be among the nearest pairs; others are left out before. Places without id
    or coordinates take no part.
    """
    from tarn.functions.exprs import great_circle_km

    known = df.select(ident, F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).filter(F.col(ident).isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    first = F.row_number().over(Window.partitionBy("lat", "lon").orderBy(ident))
    known = known.withColumn("_n", first).filter(F.col("_n") <= n + 1).drop("_n")
    la, lo = F.radians("lat"), F.radians("lon")
    xyz = {"x": F.cos(la) * F.cos(lo), "y": F.cos(la) * F.sin(lo), "z": F.sin(la)}
    placed = known.withColumns({k: EARTH_KM * v for k, v in xyz.items()})
    sides = [1e-6 * 4**i for i in range(18)]  # a millimetre to more than the globe, which one cube then holds
    cube = lambda side: [F.floor((F.col(k) + 7000) / side).alias(f"c{k}") for k in "xyz"]
    level = placed.select("x", "y", "z", F.posexplode(F.array(*[F.lit(s) for s in sides])).alias("level", "side")).groupBy("level", *cube(F.col("side"))).agg(F.count("*").alias("m"))
    shared = {r["level"]: r["pairs"] for r in level.groupBy("level").agg(F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("pairs")).collect()}
    enough = min((i for i, pairs in shared.items() if pairs >= n), default=len(sides) - 1)
    diagonal = min(math.sqrt(3) * sides[enough], 2 * EARTH_KM)
    # as far along the globe, and what the arc cosine may err by for points close together
    reach = _chord(2 * EARTH_KM * math.asin(diagonal / (2 * EARTH_KM)) + 0.002)
    a = placed.select(*[F.col(c).alias(f"{c}_a") for c in (ident, "lat", "lon", "x", "y", "z")], *cube(reach))
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    b = placed.select(*[F.col(c).alias(f"{c}_b") for c in (ident, "lat", "lon", "x", "y", "z")], *cube(reach))
    for k in "xyz":
        b = b.withColumn(f"d{k}", F.explode(near)).withColumn(f"c{k}", F.col(f"c{k}") + F.col(f"d{k}")).drop(f"d{k}")
    close = sum((F.pow(F.col(f"{k}_a") - F.col(f"{k}_b"), 2) for k in "yz"), F.pow(F.col("x_a") - F.col("x_b"), 2)) <= reach * reach * (1 + 1e-9)
    pairs = a.join(b, ["cx", "cy", "cz"]).filter((F.col(f"{ident}_a") < F.col(f"{ident}_b")) & close)
    d = pairs.select(f"{ident}_a", f"{ident}_b", great_circle_km(*[F.col(c) for c in ("lat_a", "lon_a", "lat_b", "lon_b")]).alias("km"))
    return d.orderBy("km", f"{ident}_a", f"{ident}_b").limit(n)


def market_features(df: DataFrame, keys: list[str], book: str, odds: tuple[str, str, str], reference: str) -> DataFrame:
    """Mean margin-free probabilities over bookmakers, and those of one reference bookmaker."""
    from tarn.functions.exprs import implied_prob, overround

    ps = {n: implied_prob(odds, i) for i, n in enumerate(("home", "draw", "away"))}
    aggs = [F.avg(p).alias(f"mkt_{n}") for n, p in ps.items()] + [F.max(F.when(F.col(book) == reference, p)).alias(f"ref_{n}") for n, p in ps.items()]
    return df.groupBy(*keys).agg(F.count_distinct(book).alias("n_books"), F.avg(overround(odds)).alias("mean_overround"), *aggs)


def hours_mean(df: DataFrame, keys: list[str], ts: str, value: str, first: int = 14, last: int = 17) -> DataFrame:
    """(keys, day, mean_value, n): daily mean over the hours ``first`` to ``last``, both included."""
    inside = df.filter(F.hour(ts).between(first, last))
    return inside.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.avg(value).alias("mean_value"), F.count(value).alias("n"))


def market_by_season(df: DataFrame, keys: list[str], odds: list[str], result: str, outcomes: tuple[str, ...] = ("H", "D", "A")) -> DataFrame:
    """(keys, n_matches, mean_margin, rate_<outcome>): the bookmaker's mean margin, and how often each outcome came
    among the matches with a result."""
    n = F.count(result)
    rates = [(F.count(F.when(F.col(result) == o, 1)) / F.nullif(n, F.lit(0))).alias(f"rate_{o.lower()}") for o in outcomes]
    return df.groupBy(*keys).agg(n.alias("n_matches"), F.avg(overround(odds)).alias("mean_margin"), *rates)
