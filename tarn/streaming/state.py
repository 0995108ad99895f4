"""Running state of entities from event streams, and ratings that depend on order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tarn.operators.resolve import small
from tarn.session import cut_lineage


def running_state(events: DataFrame, key: list[str], order: list[str], counts: dict[str, Column], last: list[str]) -> DataFrame:
    """Conditional counts and newest values per entity; batch, or a stream in update mode."""
    at = F.struct(*order)
    return events.groupBy(*key).agg(F.count("*").alias("n_events"), *[F.count(F.when(c, 1)).alias(n) for n, c in counts.items()], *[F.max_by(c, at).alias(f"last_{c}") for c in last])


def windowed_counts(events: DataFrame, ts: str, keys: list[str], window: str = "10 minutes", slide: str | None = None, late: str = "30 minutes") -> DataFrame:
    """Counts per event-time window with a watermark (an extension beside the parity operators)."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return events.withWatermark(ts, late).groupBy(w, *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


def _expected(diff: float) -> float:
    return 1 / (1 + 10 ** (-diff / 400))


def elo_step(home: float, away: float, hg: int, ag: int, k: float, edge: float) -> tuple[float, float]:
    """Change of the home rating, and the home side's expected score."""
    e = _expected(home + edge - away)
    gap = abs(hg - ag)
    factor = 1.0 if gap <= 1 else 1.5 if gap == 2 else (11 + gap) / 8
    return k * factor * ((1.0 if hg > ag else 0.5 if hg == ag else 0.0) - e), e


def meeting_groups(matches: DataFrame, home: str, away: str) -> DataFrame:
    """(entity, component): entities that are linked by any chain of matches share the smallest entity among them.

    Labels pass along the distinct pairs as pre-aggregated minima, and every label then jumps to its own label,
    so the number of rounds grows with the logarithm of the chains. A round's table has one row an entity.
    """
    pairs = matches.select(F.col(home).alias("a"), F.col(away).alias("b")).filter("a is not null and b is not null").distinct()
    both = cut_lineage(pairs.unionAll(pairs.select("b", "a")).distinct())
    labels = both.select(F.col("a").alias("entity")).distinct().withColumn("component", F.col("entity"))
    while True:
        told = both.join(labels.select(F.col("entity").alias("b"), F.col("component").alias("m")), "b").groupBy(F.col("a").alias("entity")).agg(F.min("m").alias("m"))
        low = labels.join(told, "entity").select("entity", F.least("component", "m").alias("low"), F.col("component").alias("old"))
        jump = low.select(F.col("entity").alias("low"), F.col("low").alias("lower"))
        new = cut_lineage(low.join(jump, "low").select("entity", F.least("low", "lower").alias("component"), "old"))
        if new.filter("component <> old").isEmpty():
            return new.drop("old")
        labels = new.drop("old")


COLUMNS = "home_elo_before double, away_elo_before double, elo_diff double, home_expected double"


def elo(matches: DataFrame, group: str | None, season: str, order: list[str], home: str, away: str, hg: str, ag: str, ident: str, k: float = 20, edge: float = 60, start: float = 1500, regress: float = 0.25) -> DataFrame:
    """Ratings before each match of a group (competition), which is rated in order in one task.

    Matches arrive sorted, batch by batch; only the ratings of the group at hand are held, never its matches.
    With a ``group`` column, entities of two groups have two ratings. Without one an entity has one rating in all
    its competitions: those who are linked by any chain of matches form a group, ``component``, and are rated
    together in order of time. Ratings depend on all earlier ones of both sides, so a component is one task.
    At a new season ratings go back towards the start by ``regress``; unplayed matches change nothing.
    """
    if group is None:
        group = "component"
        of = meeting_groups(matches, home, away).select(F.col("entity").alias(home), "component")
        matches = matches.drop(group).join(small(of), home, "left").withColumn(group, F.coalesce(group, home))
    kind = {f.name: f.dataType.simpleString() for f in matches.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rating: dict = {}
        at, now = (), None
        for pdf in batches:
            rows = []
            for r in pdf[[group, season, home, away, hg, ag]].itertuples(index=False, name=None):
                g = (None if pd.isna(r[0]) else r[0],)
                if g != at:
                    at, rating, now = g, {}, None
                if now is not None and r[1] != now:
                    rating = {t: start + (1 - regress) * (v - start) for t, v in rating.items()}
                now = r[1]
                h, a = rating.get(r[2], start), rating.get(r[3], start)
                done = not (pd.isna(r[4]) or pd.isna(r[5]))
                delta, e = elo_step(h, a, int(r[4]), int(r[5]), k, edge) if done else (0.0, _expected(h + edge - a))
                rows.append((h, a, h + edge - a, e))
                rating[r[2]], rating[r[3]] = h + delta, a - delta
            new = pd.DataFrame(rows, columns=["home_elo_before", "away_elo_before", "elo_diff", "home_expected"], index=pdf.index)
            yield pd.concat([pdf[[group, ident]], new], axis=1)

    cols = [*dict.fromkeys([group, ident, season, *order, home, away, hg, ag])]
    dealt = matches.select(*cols).repartition(group).sortWithinPartitions(group, *[F.asc_nulls_last(c) for c in [*order, ident]])
    return dealt.mapInPandas(run, f"{group} {kind[group]}, {ident} {kind[ident]}, {COLUMNS}")


class EloState(StatefulProcessor):
    """Ratings of a group between micro-batches, which must arrive in order."""

    def __init__(self, k: float = 20, edge: float = 60, start: float = 1500):
        self.k, self.edge, self.start = k, edge, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ratings = handle.getMapState("ratings", "team string", "elo double")

    def _get(self, team: str) -> float:
        return self.ratings.getValue((team,))[0] if self.ratings.containsKey((team,)) else self.start

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["ord", "match_id"], kind="stable")
        out = []
        for r in pdf.itertuples(index=False):
            h, a = self._get(r.home), self._get(r.away)
            delta, e = elo_step(h, a, int(r.hg), int(r.ag), self.k, self.edge)
            self.ratings.updateValue((r.home,), (h + delta,))
            self.ratings.updateValue((r.away,), (a - delta,))
            out.append((key[0], r.match_id, h, a, h + self.edge - a, e))
        yield pd.DataFrame(out, columns=["grp", "match_id", "home_elo_before", "away_elo_before", "elo_diff", "home_expected"])

    def close(self) -> None:
        pass


def elo_stream(stream: DataFrame, **options) -> DataFrame:
    """Streaming form of ``elo`` over (grp, match_id, ord, home, away, hg, ag) with strings as teams."""
    return stream.groupBy("grp").transformWithStateInPandas(EloState(**options), f"grp string, match_id long, {COLUMNS}", "Append", "None")
