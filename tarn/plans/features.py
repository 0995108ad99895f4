"""Feature tables around a match spine (match_id, match_date, season, home, away, goals) and wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.operators import reshape as R
from tarn.operators.aggregates import market_features, sentiment_metrics
from tarn.operators.quality import assert_grain
from tarn.operators.resolve import small
from tarn.operators.temporal import asof_join, band_nearest, gap_days, lookback_line, n_prior, pair_history, period_change, prior_avg, range_agg, rank_before, spikes
from tarn.streaming.state import elo

KEY = "match_id"


def sides(m: DataFrame) -> DataFrame:
    """Two rows per match: team, opponent, goals, points."""
    c = F.col
    s = R.two_sides(m, {"team": c("home"), "opponent": c("away"), "gf": c("home_goals"), "ga": c("away_goals")}, {"team": c("away"), "opponent": c("home"), "gf": c("away_goals"), "ga": c("home_goals")}, [KEY, "match_date", "season"])
    return s.withColumn("points", F.when(c("gf") > c("ga"), 3).when(c("gf") == c("ga"), 1).when(c("gf") < c("ga"), 0))


def spread(m: DataFrame, team_rows: DataFrame, cols: list[str]) -> DataFrame:
    """(match_id, home_<col>, away_<col>) from rows per match and side."""
    aggs = [F.max(F.when(F.col("side") == s, F.col(x))).alias(f"{p}_{x}") for x in cols for s, p in (("h", "home"), ("a", "away"))]
    return m.select(KEY).join(team_rows.groupBy(KEY).agg(*aggs), KEY, "left")


def rolling_form(m: DataFrame, n: int = 5) -> DataFrame:
    """Means of the n matches before, rest days (at most 30) and number of earlier matches."""
    w = Window.partitionBy("team").orderBy("match_date", KEY)
    wy = Window.partitionBy("team", "season").orderBy("match_date", KEY)
    r = sides(m).withColumns({f"form_{x}": prior_avg(x, w, n) for x in ("points", "gf", "ga")} | {"rest_days": gap_days("match_date", w, 30), "n_before": n_prior(w), "season_ppg": F.avg("points").over(wy.rowsBetween(Window.unboundedPreceding, -1))})
    return spread(m, r, ["form_points", "form_gf", "form_ga", "rest_days", "n_before", "season_ppg"])


def season_position(m: DataFrame, top: int = 6) -> DataFrame:
    """Table position of both teams before the day of the match."""
    s = sides(m).withColumn("gd", F.col("gf") - F.col("ga")).fillna(0, ["points", "gd", "gf"])
    pos = rank_before(s, ["season"], "team", "match_date", "points", ["gd", "gf"], top, asked=sides(m))
    return spread(m, sides(m).join(pos.select("season", "team", "match_date", "position", "is_top"), ["season", "team", "match_date"], "left").withColumn("is_top", F.col("is_top").cast("int")), ["position", "is_top"])


def elo_features(m: DataFrame, group: str = "competition", **options) -> DataFrame:
    r = elo(m, group, "season", ["match_date"], "home", "away", "home_goals", "away_goals", KEY, **options)
    p = X.elo_outcome("elo_diff")
    return r.withColumns({f"elo_p_{s}": x for s, x in zip(("home", "draw", "away"), p, strict=True)}).drop(group)


def head_to_head(m: DataFrame, n: int = 5) -> DataFrame:
    """Of the last n meetings: how many, and the points that today's home team took."""
    lo = F.least("home", "away")
    pts = F.when(F.col("home_goals") == F.col("away_goals"), 1.0).when((F.col("home_goals") > F.col("away_goals")) == (F.col("home") == lo), 3.0).otherwise(0.0)
    h = pair_history(m.withColumn("_p", pts), "home", "away", ["match_date", KEY], "_p", n)
    low_view = F.col("h2h_avg")
    return h.select(KEY, "h2h_n", F.when(F.col("home") == lo, low_view).otherwise(F.when(low_view.isNotNull(), 3.0 - low_view)).alias("h2h_home_points"))


def odds_features(quotes: DataFrame, reference: str = "b365") -> DataFrame:
    """quotes: (match_id, bookmaker, home, draw, away)."""
    return market_features(quotes, [KEY], "bookmaker", ("home", "draw", "away"), reference)


def attention(m: DataFrame, daily: DataFrame, days: int = 7) -> DataFrame:
    """daily: (team, day, views). Mean views of the days before, per side, and their ratio."""
    out = m.select(KEY, "match_date", "home", "away")
    for s in ("home", "away"):
        r = daily.select(F.col("team").alias(s), "day", "views")
        out = range_agg(out, r, [s], [KEY], "match_date", "day", days, [F.avg("views").alias(f"{s}_views"), F.count("*").alias(f"{s}_view_days")])
    return out.withColumn("views_ratio", X.ratio("home_views", "away_views")).drop("match_date", "home", "away")


def from_lines(m: DataFrame, line: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(match_id, home_<value>, away_<value>) from a ``lookback_line`` by team; null without rows to look back on."""
    out = m.select(KEY, "match_date", "home", "away").withColumn("_day", F.unix_date(F.col("match_date").cast("date")))
    for s in ("home", "away"):
        out = out.join(line.select(F.col("team").alias(s), "_day", *[v.alias(f"{s}_{k}") for k, v in values.items()]), [s, "_day"], "left")
    return out.select(KEY, *[f"{s}_{k}" for s in ("home", "away") for k in values])


def injury_load(m: DataFrame, injuries: DataFrame, days: int = 14) -> DataFrame:
    """injuries: (team, player, day, xg). Players out in the days before, and the goals they stand for."""
    line = lookback_line(injuries.select("team", "player", "day", "xg").distinct(), ["team"], "day", days, {"xg": F.col("xg")}, "player")
    return from_lines(m, line, {"injured": F.col("n_items"), "missing_xg": F.col("xg")}).fillna(0, ["home_injured", "away_injured"])


def lineup_averages(m: DataFrame, lineups: DataFrame, players: DataFrame) -> DataFrame:
    """lineups: (match_id, side, player); players: (player, height, weight, dob). Per side, not per match."""
    j = lineups.join(players, "player", "left").join(m.select(KEY, "match_date"), KEY)
    g = j.groupBy(KEY, "side").agg(F.avg(X.to_number("height")).alias("avg_height"), F.avg(X.to_number("weight")).alias("avg_weight"), F.avg(X.age_years("dob", "match_date")).alias("avg_age"))
    return spread(m, g, ["avg_height", "avg_weight", "avg_age"])


def media_shock(m: DataFrame, daily: DataFrame, days: int = 7) -> DataFrame:
    """Whether the views of a team spiked in the days before the match."""
    sp = spikes(daily, ["team"], "day", "views").filter("is_spike")
    out = m.select(KEY, "match_date", "home", "away")
    for s in ("home", "away"):
        out = range_agg(out, sp.select(F.col("team").alias(s), "day"), [s], [KEY], "match_date", "day", days, [F.max(F.lit(1)).alias(f"{s}_media_shock")])
    return out.fillna(0, ["home_media_shock", "away_media_shock"]).drop("match_date", "home", "away")


def comment_sentiment(m: DataFrame, comments: DataFrame, positive: list[str], negative: list[str], days: int = 7) -> DataFrame:
    """comments: (team, day, text). Mean lexicon sentiment of the days before the match."""
    label, _ = X.lexicon_sentiment("text", positive, negative)
    scored = comments.withColumn("s", X.lookup(label, {"positive": 1, "negative": -1, "neutral": 0}, "int"))
    line = lookback_line(scored, ["team"], "day", days, {"s": F.col("s"), "_known": F.col("s").isNotNull().cast("int")})
    return from_lines(m, line, {"sentiment": X.ratio("s", "_known"), "comments": F.col("n_rows")})


def match_context(m: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    out = m.select(KEY, F.hour("kickoff").alias("kickoff_hour"), X.day_of_week_sunday0("match_date").alias("dow"), (X.iso_day_of_week("match_date") >= 6).alias("is_weekend"))
    if weather is None:
        return out
    return out.join(weather.select(KEY, "temperature_c", "precipitation_mm"), KEY, "left").withColumn("is_rain", F.col("precipitation_mm") > 0)


def travel_distance(m: DataFrame, venues: DataFrame) -> DataFrame:
    """venues: (team, lat, lon) of home grounds; the home side travels 0 km."""
    h, a = (venues.groupBy(F.col("team").alias(s)).agg(F.max(F.struct("lat", "lon")).alias(f"_{s}")) for s in ("home", "away"))
    km = X.haversine_km(F.col("_home.lat"), F.col("_home.lon"), F.col("_away.lat"), F.col("_away.lon"))
    return m.select(KEY, "home", "away").join(h, "home", "left").join(a, "away", "left").select(KEY, F.lit(0.0).alias("home_travel_km"), km.alias("away_travel_km"))


def wide(m: DataFrame, parts: dict[str, DataFrame], n: int | None = None) -> DataFrame:
    """All feature tables on the match key, prefixed where names would clash; grain checked."""
    out, seen = m, set(m.columns)
    for name, df in parts.items():
        cols = [c for c in df.columns if c != KEY]
        out = out.join(df.select(KEY, *[F.col(c).alias(c if c not in seen else f"{name}_{c}") for c in cols]), KEY, "left")
        seen |= {c if c not in seen else f"{name}_{c}" for c in cols}
    return assert_grain(out, [KEY], n)


def feature_catalog(spark: SparkSession, parts: dict[str, DataFrame]) -> DataFrame:
    """(feature, feature_group, data_type), from schemas alone."""
    return spark.createDataFrame([(c, g, k) for g, df in parts.items() for c, k in df.dtypes if c != KEY], "feature string, feature_group string, data_type string")


def builder_checks(m: DataFrame, team_rows: DataFrame, rolled: DataFrame, n_before: str = "n_before", value: str = "form_points") -> dict[str, int]:
    """Counts that must be 0: rows off 2 per match, and rolled values on a team's first match."""
    a, b = m.count(), team_rows.count()
    leak = rolled.filter((F.col(f"home_{n_before}") == 0) & F.col(f"home_{value}").isNotNull()).count()
    return {"row_excess": b - 2 * a, "first_match_leak": leak}


def match_360(m: DataFrame, parts: dict[str, DataFrame], snapshots: DataFrame | None = None, second: DataFrame | None = None) -> DataFrame:
    """One big table: feature tables, the newest dated snapshot of each side up to the match day, and a
    second source's nearest match within a day."""
    out = wide(m, parts)
    if snapshots is not None:
        cols = [c for c in snapshots.columns if c not in ("team", "snapshot_date")]
        for s in ("home", "away"):
            r = snapshots.select(F.col("team").alias(s), "snapshot_date", *[F.col(c).alias(f"{s}_{c}") for c in cols])
            out = asof_join(out, r, [s], "match_date", "snapshot_date", [f"{s}_{c}" for c in cols], strict=False)
    if second is not None:
        b = band_nearest(m.select(KEY, "home", "away", "match_date"), second.withColumnRenamed("match_date", "other_date"), ["home", "away"], [KEY], "match_date", "other_date", ["other_date"])
        out = out.join(b.select(KEY, *[F.col(c).alias(f"b_{c}") for c in second.columns if c not in ("home", "away", "match_date")], "day_gap"), KEY, "left")
    return assert_grain(out, [KEY])


def player_360(players: DataFrame, seasons: DataFrame, status: DataFrame) -> DataFrame:
    """Players by season; the current status only on the latest season of each player."""
    last = Window.partitionBy("player_key")
    s = seasons.withColumn("is_latest", F.col("season") == F.max("season").over(last))
    st = status.select("player_key", *[F.col(c).alias(f"status_{c}") for c in status.columns if c != "player_key"])
    out = s.join(players, "player_key", "left").join(st, "player_key", "left")
    return assert_grain(out.withColumns({c: F.when(F.col("is_latest"), F.col(c)) for c in st.columns if c != "player_key"}), ["player_key", "season"])


def absences(docs: DataFrame, item: str = "item") -> DataFrame:
    """(fixture_id, team_id, player_id, player, kind, reason, is_suspension) from absence items."""
    g = lambda p, t="string": F.try_variant_get(item, p, t)
    reason = g("$.player.reason")
    return docs.select(g("$.fixture.id", "bigint").alias("fixture_id"), g("$.team.id", "bigint").alias("team_id"), g("$.player.id", "bigint").alias("player_id"), g("$.player.name").alias("player"), g("$.player.type").alias("kind"), reason.alias("reason"), F.lower(reason).rlike("suspen|red card|yellow card").alias("is_suspension"))


def weekly_report(ratings: DataFrame, matches: DataFrame, docs: DataFrame, start: str, end: str, n: int = 5) -> dict[str, DataFrame]:
    """Top ratings, changes of the week, its matches with surprises, its sentiment."""
    a, b = F.lit(start).cast("date"), F.lit(end).cast("date")
    week = lambda d: (F.col(d) >= a) & (F.col(d) <= b)
    newest = ratings.filter(F.col("day") <= b).groupBy("team").agg(F.max_by("elo", "day").alias("elo"))
    surprise = ((F.col("p_home") >= 0.6) & (F.col("result") == "A")) | ((F.col("p_away") >= 0.6) & (F.col("result") == "H"))
    return {
        "top": newest.orderBy(F.desc("elo"), "team").limit(n),
        "changes": period_change(ratings.filter(week("day")), ["team"], ["day"], "elo").orderBy(F.abs("change").desc(), "team").limit(n),
        "matches": matches.filter(week("match_date")).withColumn("is_surprise", F.coalesce(surprise, F.lit(False))),
        "sentiment": sentiment_metrics(docs.filter(week("event_date")), ["source_type"]),
    }


# Dashboard views: predictions, upcoming matches, long explanations, indicators, per class.
def prediction_views(pred: DataFrame, contrib: DataFrame, teams: DataFrame, metrics: DataFrame, today: Column) -> dict[str, DataFrame]:
    names = lambda s: teams.select(F.col("team_key").alias(f"{s}_key"), F.col("team_name").alias(f"{s}_name"))
    p = pred.join(small(names("home")), "home_key", "left").join(small(names("away")), "away_key", "left")
    p = p.withColumns({"summary": X.prob_summary("p_home", "p_draw", "p_away"), "timeline": X.timeline_bucket("match_date", today), "probability_pct": F.round(100 * F.col("confidence"), 2)})
    done = p.filter("actual_result is not null")
    kpi = done.groupBy("model_version").agg(F.count("*").alias("n_scored"), F.avg(F.col("is_correct").cast("double")).alias("accuracy"), F.avg("confidence").alias("mean_confidence"))
    return {"predictions": p, "upcoming": p.filter(~F.col("is_finished") & (F.col("match_date") >= today)), "explanations": contrib.join(p.select("match_key", "home_name", "away_name", "match_date"), "match_key"), "kpi": kpi, "per_class": metrics}


def select_for_scoring(df: DataFrame, split: str | None = None, upcoming: bool = False, since: str | None = None, limit: int | None = None) -> DataFrame:
    if split:
        df = df.filter(F.col("split") == split)
    if upcoming:
        df = df.filter(~F.coalesce("is_finished", F.lit(False)))
    if since:
        df = df.filter(F.col("match_date") >= F.lit(since).cast("date"))
    return df.orderBy("match_date", "match_key").limit(limit) if limit else df
