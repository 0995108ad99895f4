"""As-of, range and band joins; rolling and running windows that never see the future."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial, reduce
from operator import add, and_, neg

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Both sides of an as-of join together, by the optimizer's estimate, up to which a key's line needs no cutting.
UNCUT_BYTES = 2 << 30
#: Widths of the time ranges into which lines are cut, by the type of the time column.
RANGE_WIDTH = {"date": 512, "timestamp": 86_400, "timestamp_ntz": 86_400}


def scanned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of what the tables below ``df`` hold; huge where a size is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str], strict: bool = True, tie: list[str] | None = None, prefix: str = "", direction: str = "backward", cut: bool | None = None, width: int | None = None) -> DataFrame:
    """Each left row with the newest right row before its time (``strict``) or up to it.

    ``tie``: right columns that order rows of equal time. Left rows without a match, and rows with null keys
    or times, get nulls. Two plans give the same rows:

    Whole lines: one shuffle by the keys and one sort; both sides are laid on one time line and the last
    right row is carried along. A key's whole line is one window partition.

    Cut lines (``cut``; unset, where the scanned tables are estimated at over ``UNCUT_BYTES``): only the
    distinct instants of each side travel, right rows as the last one of their instant. Every key's line
    is cut into ranges of ``width`` (days of a date, seconds of a timestamp, units of a number), each seeded with
    the last right row of all earlier ranges, which a scan over one row a range carries over empty ones. So a
    window partition holds at most the instants of one range, whatever a key's share of the rows is; the answers
    are joined back by key and instant, where adaptive execution can split a hot instant.
    """
    if cut is None:
        ranged = width is not None or left.schema[left_ts].dataType.simpleString() in RANGE_WIDTH
        cut = ranged and scanned_bytes(left) + scanned_bytes(right) > UNCUT_BYTES
    if cut:
        return _asof_cut(left, right, by, left_ts, right_ts, values, strict, tie or [], prefix, direction == "backward", width)
    return _asof_whole(left, right, by, left_ts, right_ts, values, strict, tie or [], prefix, direction == "backward")


def all_known(cols: list[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def _asof_whole(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str], strict: bool, tie: list[str], prefix: str, backward: bool) -> DataFrame:
    left_first = 0 if strict else 2
    # rows without a key or time, whose answer is null, are dealt by their time and do not meet in one task
    deal = F.when(all_known([*by, left_ts]), F.lit(-1)).otherwise(F.pmod(F.xxhash64(left_ts), F.lit(1000)).cast("int"))
    lrow, rrow = F.struct(*[F.col(c) for c in left.columns]), F.struct(*[F.col(c) for c in values])
    tie_cols = [f"_t{i}" for i in range(len(tie))]
    r_types = {f.name: f.dataType for f in right.schema}
    lpart = left.select(*by, F.col(left_ts).alias("_ts"), F.lit(left_first).alias("_side"), deal.alias("_deal"), *[F.lit(None).cast(r_types[t]).alias(n) for t, n in zip(tie, tie_cols, strict=True)], lrow.alias("_l"), F.lit(None).cast(right.select(rrow.alias("x")).schema["x"].dataType).alias("_r"))
    rpart = right.filter(all_known([*by, right_ts])).select(*by, F.col(right_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(-1).alias("_deal"), *[F.col(t).alias(n) for t, n in zip(tie, tie_cols, strict=True)], F.lit(None).cast(left.select(lrow.alias("x")).schema["x"].dataType).alias("_l"), rrow.alias("_r"))
    ts = F.col("_ts").asc_nulls_first() if backward else F.col("_ts").desc_nulls_first()
    w = Window.partitionBy(*by, "_deal").orderBy(ts, "_side", *[F.col(t).asc_nulls_first() for t in tie_cols]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = lpart.unionByName(rpart).withColumn("_hit", F.last("_r", ignorenulls=True).over(w)).filter("_l is not null")
    hit = F.when(F.col("_deal") == -1, F.col("_hit"))
    return got.select(hit.alias("_hit"), "_l.*").select(*left.columns, *[F.col(f"_hit.{v}").alias(f"{prefix}{v}") for v in values])


def time_range(ts: str, kind: str, width: int | None) -> Column:
    """The number of the range of ``width`` that holds a time."""
    if width is None and kind not in RANGE_WIDTH:
        raise ValueError(f"give the width of the ranges for times of type {kind}")
    c, width = F.col(ts), width or RANGE_WIDTH[kind]
    if kind == "date":
        c = F.unix_date(c)
    elif kind.startswith("timestamp"):
        c = F.unix_seconds(c.cast("timestamp"))
    return F.floor(c / width).cast("long")


def cut_lines(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str], strict: bool, tie: list[str], backward: bool, width: int | None) -> DataFrame:
    """(by, _range, _ts, _side, _r): the distinct instants of both sides and each range's seed, first in its range."""
    kind = left.select(left_ts).unionAll(right.select(right_ts)).schema[0].dataType.simpleString()
    row = F.struct(*[F.col(c) for c in values])
    ranged = lambda df: df.withColumn("_range", time_range("_ts", kind, width))
    asked = ranged(left.filter(all_known([*by, left_ts])).select(*by, F.col(left_ts).cast(kind).alias("_ts")).distinct())
    newest = F.max_by(row, F.struct(*[F.col(t) for t in tie])) if tie else F.max(row)  # nulls are smallest, as in a sort
    known = right.filter(all_known([*by, right_ts])).withColumn("_ts", F.col(right_ts).cast(kind))
    instants = ranged(known.groupBy(*by, "_ts").agg(newest.alias("_r")))
    last = (F.max_by if backward else F.min_by)("_r", "_ts")
    none = F.lit(None).cast(instants.schema["_r"].dataType)
    filled = instants.groupBy(*by, "_range").agg(last.alias("_r")).unionByName(asked.select(*by, "_range").distinct().withColumn("_r", none))
    filled = filled.groupBy(*by, "_range").agg(F.first("_r", ignorenulls=True).alias("_r"))
    order = F.asc("_range") if backward else F.desc("_range")
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seeds = filled.select(*by, "_range", F.last("_r", ignorenulls=True).over(before).alias("_r")).filter("_r is not null")
    side = lambda n: F.lit(n).alias("_side")
    seeds = seeds.select(*by, "_range", F.lit(None).cast(kind).alias("_ts"), side(1), "_r")
    line = asked.select(*by, "_range", "_ts", side(0 if strict else 2), none.alias("_r")).unionByName(instants.select(*by, "_range", "_ts", side(1), "_r"))
    return line.unionByName(seeds)


def _asof_cut(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str], strict: bool, tie: list[str], prefix: str, backward: bool, width: int | None) -> DataFrame:
    line = cut_lines(left, right, by, left_ts, right_ts, values, strict, tie, backward, width)
    ts = F.col("_ts").asc_nulls_first() if backward else F.col("_ts").desc_nulls_first()
    w = Window.partitionBy(*by, "_range").orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asked = line.withColumn("_hit", F.last("_r", ignorenulls=True).over(w)).filter(F.col("_side") == (0 if strict else 2))
    keys = [f"_key{i}" for i in range(len(by) + 1)]
    answers = asked.select(*[F.col(c).alias(k) for c, k in zip([*by, "_ts"], keys, strict=True)], "_hit")
    same = reduce(and_, [F.col(c) == F.col(k) for c, k in zip([*by, left_ts], keys, strict=True)])
    has = all_known([*by, left_ts])
    cols = lambda hit: [*left.columns, *[hit(v).alias(f"{prefix}{v}") for v in values]]
    kinds = {f.name: f.dataType for f in right.schema}
    found = left.filter(has).join(answers, same, "left").select(*cols(lambda v: F.col(f"_hit.{v}")))
    return found.unionAll(left.filter(~has).select(*cols(lambda v: F.lit(None).cast(kinds[v]))))


def range_agg(left: DataFrame, right: DataFrame, by: list[str], left_id: list[str], left_day: str, right_day: str, lookback: int, aggs: list[Column], include_same: bool = False) -> DataFrame:
    """Aggregates of the right rows of the ``lookback`` days before each left row (left outer).

    Both sides meet in buckets of ``lookback`` days, so a heavy key never meets its whole history.
    """
    width = max(1, lookback)
    l_epoch, r_epoch = F.unix_date(F.col(left_day).cast("date")), F.unix_date(F.col(right_day).cast("date"))
    slim = left.select(*left_id, *[b for b in by if b not in left_id], l_epoch.alias("_ld")).distinct()
    spread = slim.withColumn("_bucket", F.explode(F.array(F.floor(F.col("_ld") / width), F.floor(F.col("_ld") / width) - 1)))
    r = right.withColumn("_rd", r_epoch).withColumn("_bucket", F.floor(F.col("_rd") / width))
    near = F.col("_rd") >= F.col("_ld") - lookback
    near = near & ((F.col("_rd") <= F.col("_ld")) if include_same else (F.col("_rd") < F.col("_ld")))
    drop = [c for c in left_id if c in right.columns and c not in by]
    hits = spread.join(r.drop(*drop), [*by, "_bucket"]).filter(near).groupBy(*left_id).agg(*aggs)
    return left.join(hits, left_id, "left")


def lookback_line(right: DataFrame, by: list[str], day: str, lookback: int, sums: dict[str, Column], item: str | None = None) -> DataFrame:
    """(by, _day, n_rows, sums, n_items) for every day that has right rows in the ``lookback`` days before it.

    ``_day`` counts from 1970-01-01. ``sums``: {name: column}; ``n_items``: distinct values of ``item`` over those days.
    Rows are summed by key and day first, and only these sums look back on each other, so no left row meets single
    right rows and a key's line is as long as its calendar. An item counts from each of its rows to its next one
    or to the end of the look-back, whichever is earlier: one step up, one down. Rows with null keys or days take no part.
    """
    rows = right.filter(all_known([*by, day])).select(*by, F.unix_date(F.col(day).cast("date")).alias("_at"), *[v.alias(k) for k, v in sums.items()], *([F.col(item).alias("_item")] if item else []))
    rows = rows.withColumn("n_rows", F.lit(1).cast("long"))
    cols = ["n_rows", *sums]
    if item:
        kinds = {f.name: f.dataType for f in rows.schema}
        step = F.col("_item").isNotNull().cast("long")
        following = F.lead("_at").over(Window.partitionBy(*by, "_item").orderBy("_at"))
        rows = rows.withColumn("_end", F.least(F.col("_at") + lookback, following))
        up = F.struct("_at", *cols, step.alias("_step"))
        down = F.struct(F.col("_end").alias("_at"), *[F.lit(None).cast(kinds[c]).alias(c) for c in cols], (-step).alias("_step"))
        rows = rows.select(*by, F.inline(F.array(up, down)))
    line = rows.groupBy(*by, "_at").agg(*[F.sum(c).alias(c) for c in [*cols, *(["_step"] if item else [])]])
    w = Window.partitionBy(*by)
    until = F.least(F.lead("_at").over(w.orderBy("_at")) - 1, F.col("_at") + lookback)
    days = line.withColumn("_until", until).withColumn("_day", F.explode(F.sequence("_at", "_until")))
    own = lambda c: F.sum(F.when(F.col("_day") == F.col("_at"), F.col(c)))
    out = {c: own(c).over(w.orderBy("_day").rangeBetween(-lookback, -1)) for c in cols}
    if item:
        out["n_items"] = own("_step").over(w.orderBy("_day").rangeBetween(Window.unboundedPreceding, -1))
    return days.select(*by, "_day", *[v.alias(k) for k, v in out.items()]).filter("n_rows > 0")


def band_join(a: DataFrame, b: DataFrame, by: list[str], a_day: str, b_day: str, tol: int = 1) -> DataFrame:
    """All pairs with equal keys and days at most ``tol`` apart, with ``day_gap``."""
    days = F.sequence(F.date_sub(F.col(a_day).cast("date"), tol), F.date_add(F.col(a_day).cast("date"), tol))
    left = a.withColumn("_day", F.explode(days))
    right = b.withColumn("_day", F.col(b_day).cast("date"))
    return left.join(right, [*by, "_day"]).withColumn("day_gap", F.abs(F.datediff(F.col("_day"), F.col(a_day).cast("date")))).drop("_day")


def band_nearest(a: DataFrame, b: DataFrame, by: list[str], a_id: list[str], a_day: str, b_day: str, tie: list[str], tol: int = 1) -> DataFrame:
    """The nearest of the pairs of ``band_join`` for each row of ``a``; ties by ``tie``, unknown values last.

    Which row of ``b`` is nearest depends on key and day only. So each key and day of ``b`` keeps its first row by
    ``tie``, each day around takes the nearest of these, and a row of ``a`` meets one row, not all of its days.
    """
    order = [F.col(t).asc_nulls_last() for t in tie]
    first = lambda df, keys, *o: df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*o))).filter("_rn = 1").drop("_rn")
    dated = b.withColumn("_bd", F.col(b_day).cast("date")).filter(all_known([*by, "_bd"]))
    if len(tie) == 1 and tie != [b_day] and sorted(b.columns) == sorted({*by, b_day, *tie}) and dict(b.dtypes)[b_day] == "date":
        best = dated.groupBy(*by, b_day, "_bd").agg(F.min(tie[0]).alias(tie[0]))  # no other columns: no sort
    else:
        best = first(dated, [*by, "_bd"], *order)
    around = best.withColumn("_day", F.explode(F.sequence(F.date_sub("_bd", tol), F.date_add("_bd", tol)))).withColumn("day_gap", F.abs(F.datediff("_bd", "_day")))
    nearest = first(around, [*by, "_day"], "day_gap", *order).select(*by, "_day", *[c for c in b.columns if c not in by], "day_gap")
    pairs = a.withColumn("_day", F.col(a_day).cast("date")).join(nearest, [*by, "_day"]).drop("_day")
    return first(pairs, a_id, "day_gap", *order)


def ordered(by: list[str], order: list[Column | str]):
    return Window.partitionBy(*by).orderBy(*order)


def roll_avg(value: Column | str, w, n: int, least: int | None = None) -> Column:
    """Mean of the current and n - 1 earlier rows; null with fewer than ``least`` (default n) values."""
    v = F.col(value) if isinstance(value, str) else value
    over = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(v).over(over) >= (n if least is None else least), F.avg(v).over(over))


def prior_avg(value: Column | str, w, n: int) -> Column:
    """Mean of the n rows before the current one."""
    return F.avg(value).over(w.rowsBetween(-n, -1))


def n_prior(w) -> Column:
    return F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, -1))


def cum_avg(value: Column | str, w, current: bool = True) -> Column:
    return F.avg(value).over(w.rowsBetween(Window.unboundedPreceding, 0 if current else -1))


def sum_before(value: Column | str, by: list[str], order: str) -> Column:
    """Sum over rows whose integer ``order`` is smaller; rows of equal order do not see each other."""
    w = Window.partitionBy(*by).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def gap_days(day: str, w, cap: int | None = None) -> Column:
    gap = F.datediff(F.col(day), F.lag(day).over(w))
    return gap if cap is None else F.when(gap.isNotNull(), F.least(gap, F.lit(cap)))


def form_string(code: Column | str, w, n: int = 5) -> Column:
    """The last ``n`` result codes up to the current row, oldest first."""
    return F.array_join(F.collect_list(code).over(w.rowsBetween(-(n - 1), Window.currentRow)), "")


def spikes(df: DataFrame, keys: list[str], day: str, value: str, window: int = 7, least: int = 3, z: float = 2.0) -> DataFrame:
    """Adds rolling mean and deviation of the days before, z-score, ratio and a spike flag."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(-window, -1)
    n, mean, sd = F.count(value).over(w), F.avg(value).over(w), F.stddev_samp(value).over(w)
    out = df.withColumns({"base_mean": F.when(n >= least, mean), "base_std": F.when(n >= least, sd)})
    score = (F.col(value) - F.col("base_mean")) / F.nullif(F.col("base_std"), F.lit(0.0))
    return out.withColumns({"z_score": score, "ratio": F.col(value) / F.nullif(F.col("base_mean"), F.lit(0.0)), "is_spike": F.coalesce(score >= z, F.lit(False))})


def period_change(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """First and last value in time and their difference."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(F.min_by(value, at).alias("first_value"), F.max_by(value, at).alias("last_value")).withColumn("change", F.col("last_value") - F.col("first_value"))


def dense_grid(df: DataFrame, group: list[str], a: str, b: str) -> DataFrame:
    """Every combination of the distinct ``a`` and ``b`` of a group."""
    return df.select(*group, a).distinct().join(df.select(*group, b).distinct(), group)


class Standings:
    """Totals of the entities of one group, and the sorted list of them that gives positions."""

    def __init__(self, width: int):
        self.totals, self.order, self.zero = {}, [], (0,) * width

    def add(self, entity, change: tuple) -> None:
        old = self.totals.get(entity)
        new = tuple(map(add, old or self.zero, change))
        if old is not None:
            if new == old:
                return
            del self.order[bisect_left(self.order, tuple(map(neg, old)))]
        self.totals[entity] = new
        insort(self.order, tuple(map(neg, new)))

    def position(self, entity) -> int:
        """One more than the number of entities with higher totals."""
        return 1 + bisect_left(self.order, tuple(map(neg, self.totals[entity])))


def _sweep(batches: Iterator[pd.DataFrame], group: list[str], width: int, top: int) -> Iterator[pd.DataFrame]:
    """Positions that are asked for, from lines sorted by group, day and kind: entries, questions, results."""
    at, table = None, None
    for pdf in batches:
        rows, kept = [], []
        keys = zip(*[pdf[g] for g in group], strict=True)
        values = zip(*[pdf[f"_v{i}"] for i in range(width)], strict=True)
        for i, (key, entity, kind, change) in enumerate(zip(keys, pdf["_entity"], pdf["_kind"], values, strict=True)):
            if key != at:
                at, table = key, Standings(width)
            if kind == 1:
                place = table.position(entity)
                rows.append((*table.totals[entity], place, place <= top))
                kept.append(i)
            else:
                table.add(entity, change)
        new = pd.DataFrame(rows, columns=[*[f"_v{i}" for i in range(width)], "position", "is_top"])
        yield pd.concat([pdf[[*group, "_entity", "_day"]].iloc[kept].reset_index(drop=True), new], axis=1)


def rank_before(df: DataFrame, group: list[str], entity: str, day: str, points: str, extra: list[str], top: int = 6, asked: DataFrame | None = None) -> DataFrame:
    """(group, day, entity, points_before, extra_before, position, is_top): tables of a group before given days.

    Without ``asked`` the result is the whole grid of a group's days and entities, from windows. ``asked``
    (group, entity, day) says whose positions on which days are wanted: then each group's daily sums are swept
    in order of days, batch by batch, and a task holds the totals of the group's entities in a sorted list,
    never days times entities. Entities stand in the table from the beginning, with zeros; equal totals share a
    position. Totals are whole numbers (longs) in a sweep; rows with a null group, entity or day take no part in it.
    """
    cols = [points, *extra]
    if asked is None:
        grid = dense_grid(df, group, day, entity)
        daily = df.groupBy(*group, entity, day).agg(*[F.sum(c).alias(c) for c in cols])
        w = Window.partitionBy(*group, entity).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
        sums = grid.join(daily, [*group, entity, day], "left").select(*group, entity, day, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_before") for c in cols])
        place = F.rank().over(Window.partitionBy(*group, day).orderBy(*[F.col(f"{c}_before").desc() for c in cols]))
        return sums.withColumn("position", place).withColumn("is_top", F.col("position") <= top)
    use = df.filter(all_known([*group, entity, day]))
    asked = asked.filter(all_known([*group, entity, day])).select(*group, entity, day).distinct()
    kind = use.schema[day].dataType
    zero = [F.lit(0).cast("long").alias(f"_v{i}") for i in range(len(cols))]
    line = lambda d, n, at, values: d.select(*group, F.col(entity).alias("_entity"), at.cast(kind).alias("_day"), F.lit(n).alias("_kind"), *values)
    entries = line(use.select(*group, entity).union(asked.select(*group, entity)).distinct(), 0, F.lit(None), zero)
    daily = use.groupBy(*group, entity, day).agg(*[F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(c) for c in cols])
    results = line(daily, 2, F.col(day), [F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    lines = entries.unionAll(line(asked, 1, F.col(day), zero)).unionAll(results)
    order = [*group, F.asc_nulls_first("_day"), "_kind"]
    dealt = lines.repartition(*group).sortWithinPartitions(*order)
    names = {f.name: f.dataType.simpleString() for f in lines.schema}
    schema = ", ".join(f"`{c}` {names[c]}" for c in [*group, "_entity", "_day", *[f"_v{i}" for i in range(len(cols))]])
    swept = dealt.mapInPandas(partial(_sweep, group=group, width=len(cols), top=top), f"{schema}, position int, is_top boolean")
    before = [F.col(f"_v{i}").alias(f"{c}_before") for i, c in enumerate(cols)]
    return swept.select(*group, F.col("_day").alias(day), F.col("_entity").alias(entity), *before, "position", "is_top")


def pair_history(df: DataFrame, a: str, b: str, order: list[str], value: str, n: int = 5) -> DataFrame:
    """Adds count and mean of the last ``n`` meetings of the unordered pair before each row."""
    w = Window.partitionBy(F.least(a, b), F.greatest(a, b)).orderBy(*order).rowsBetween(-n, -1)
    return df.withColumns({"h2h_n": F.count(F.lit(1)).over(w), "h2h_avg": F.avg(value).over(w)})


def lag_by_key(df: DataFrame, keys: list[str], step: str, values: list[str], back: int = 1) -> DataFrame:
    """Adds ``prev<back>_<value>`` from the row whose ``step`` is smaller by ``back``; gaps give nulls."""
    past = df.select(*keys, (F.col(step) + back).alias(step), *[F.col(v).alias(f"prev{back}_{v}") for v in values])
    return df.join(past, [*keys, step], "left")


def count_known_before(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str) -> DataFrame:
    """Adds ``n_known``: right rows of the key whose time is strictly before the left row's."""
    running = right.filter(F.col(right_ts).isNotNull()).withColumn("n_known", F.row_number().over(Window.partitionBy(*by).orderBy(right_ts)))
    got = asof_join(left, running, by, left_ts, right_ts, ["n_known"], tie=["n_known"])
    return got.withColumn("n_known", F.coalesce("n_known", F.lit(0)))


def calendar_split(day: str, train_end: str, valid_end: str, test_end: str | None = None) -> Column:
    d = F.col(day)
    out = F.when(d < F.lit(train_end).cast("date"), "train").when(d < F.lit(valid_end).cast("date"), "valid")
    return out.otherwise("test") if test_end is None else out.when(d < F.lit(test_end).cast("date"), "test").otherwise("predict")


def season_split(df: DataFrame, season: str, valid: int = 1, test: int = 1) -> DataFrame:
    """train / valid / test by the order of the seasons: the newest are test, those before them valid."""
    names = df.select(season).distinct()
    rank = names.withColumn("_r", F.row_number().over(Window.orderBy(F.col(season).desc())))
    split = F.when(F.col("_r") <= test, "test").when(F.col("_r") <= test + valid, "valid").otherwise("train")
    return df.join(rank.select(season, split.alias("split")), season, "left")


def fraction_split(df: DataFrame, day: str, cuts: tuple[float, float] = (0.7, 0.85)) -> DataFrame:
    """Chronological split at quantiles of the day."""
    e = F.unix_date(F.col(day).cast("date"))
    q = df.agg(F.percentile(e, F.array(*[F.lit(c) for c in cuts])).alias("_q"))
    split = F.when(e <= F.col("_q")[0], "train").when(e <= F.col("_q")[1], "valid").otherwise("test")
    return df.crossJoin(F.broadcast(q)).withColumn("split", split).drop("_q")


def training_window(spark, as_of: str, valid_months: int = 1, test_months: int = 1, policy: str = "monthly") -> DataFrame:
    """One row: month boundaries for a snapshot taken at ``as_of``, and their identifier."""
    base = spark.range(1).select(F.lit(as_of).cast("date").alias("training_data_as_of"))
    test = F.add_months(F.trunc("training_data_as_of", "month"), 1 - test_months)
    w = base.withColumns({"training_test_start": test}).withColumn("training_valid_start", F.add_months("training_test_start", -valid_months))
    w = w.withColumns({"training_train_end": F.date_sub("training_valid_start", 1), "training_valid_end": F.date_sub("training_test_start", 1), "training_valid_months": F.lit(valid_months), "training_test_months": F.lit(test_months), "training_split_policy": F.lit(policy)})
    ident = F.md5(F.concat_ws("|", "training_split_policy", *[F.col(c).cast("string") for c in ("training_data_as_of", "training_train_end", "training_valid_start", "training_test_start")]))
    return w.withColumn("training_window_id", ident)


def training_snapshot(features: DataFrame, window: DataFrame, day: str, label: str, known_ts: str, lag_hours: int = 0) -> DataFrame:
    """Labelled rows with their split, and only labels that were known at the split's cutoff."""
    j = features.crossJoin(F.broadcast(window))
    d = F.col(day)
    split = F.when(d <= F.col("training_train_end"), "train").when(d <= F.col("training_valid_end"), "valid").when(d <= F.col("training_data_as_of"), "test")
    j = j.withColumn("split", split)
    bound = F.when(F.col("split") == "train", F.col("training_valid_start")).when(F.col("split") == "valid", F.col("training_test_start")).otherwise(F.date_add("training_data_as_of", 1))
    j = j.withColumn("training_label_cutoff_ts", bound.cast("timestamp_ntz"))
    known = F.col(known_ts).cast("timestamp_ntz") + F.expr(f"INTERVAL {lag_hours} HOUR")
    return j.withColumn("training_label_known_ts", known).filter(F.col("split").isNotNull() & F.col(label).isNotNull() & (F.col("training_label_known_ts") < F.col("training_label_cutoff_ts")))
