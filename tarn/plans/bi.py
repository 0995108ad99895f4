"""Business marts: match analysis, team match, team season, player season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions import exprs as X

PAIRS = ["xg", "shots", "shots_target", "corners", "fouls", "yellows", "reds"]
SUMS = ["xg_for", "xg_against", "xg_difference", "goals_minus_xg", "shots", "shots_target", "corners", "fouls", "yellows", "reds", "deep", "deep_allowed", "xpts", "npxg", "npxga"]


def match_analysis(m: DataFrame) -> DataFrame:
    """One row per match; statistics only of finished matches, results only where both scores are there."""
    fin = F.col("is_finished")
    scored = F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()
    base = m.withColumns({"has_result": fin & scored, "is_missing_final_score": fin & ~scored, "core_result": F.col("result")})
    weather = [c for c in base.columns if c.startswith("weather_")]
    base = base.withColumns({c: F.when(F.col("has_result"), F.col(c)) for c in ("home_goals", "away_goals", "result")} | {c: F.when(fin, F.col(c)) for c in ["ht_home_goals", "ht_away_goals", *[f"{s}_{p}" for p in PAIRS for s in ("home", "away")], *weather]})
    h, a, has = F.col("home_goals"), F.col("away_goals"), F.col("has_result")
    points = lambda x, y: F.when(has, F.when(x > y, 3).when(x == y, 1).otherwise(0))
    flag = lambda c: F.when(has, c.cast("int"))
    valid = lambda s: F.when(F.col(f"{s}_shots").isNotNull() & F.col(f"{s}_shots_target").isNotNull(), (F.col(f"{s}_shots") >= 0) & (F.col(f"{s}_shots_target") >= 0) & (F.col(f"{s}_shots_target") <= F.col(f"{s}_shots")))
    cols: dict[str, Column] = {
        "home_points": points(h, a), "away_points": points(a, h), "is_home_win": flag(h > a), "is_draw": flag(h == a), "is_away_win": flag(h < a), "total_goals": h + a, "goal_difference": h - a,
        **{f"{s}_goals_minus_xg": F.when(has, F.col(f"{s}_goals") - F.col(f"{s}_xg")) for s in ("home", "away")}, **{f"{s}_shot_accuracy": X.ratio(1.0 * F.col(f"{s}_shots_target"), f"{s}_shots") for s in ("home", "away")},
        **{f"{s}_shots_pair_valid": valid(s) for s in ("home", "away")}, "match_year": F.year("match_date"), "match_month": F.month("match_date"), "match_day_of_week": X.iso_day_of_week("match_date"), "is_weekend": X.iso_day_of_week("match_date") >= 6, "kickoff_hour_utc": F.hour("kickoff_utc"),
    }
    for p in PAIRS:
        x, y = F.col(f"home_{p}"), F.col(f"away_{p}")
        cols |= {f"total_{p}": x + y, f"{p}_difference": x - y, f"has_{p}_pair": x.isNotNull() & y.isNotNull()}
    return base.withColumns(cols)


def team_match(t: DataFrame) -> DataFrame:
    fin = F.col("is_finished")
    base = t.withColumn("has_result", fin & F.col("goals_for").isNotNull() & F.col("goals_against").isNotNull())
    has = F.col("has_result")
    plain = ["xg_for", "xg_against", "shots", "shots_target", "corners", "fouls", "yellows", "reds", "ppda_att", "ppda_def", "deep", "deep_allowed", "xpts", "npxg", "npxga"]
    keys = ["team_match_key", "match_key", "team_key", "opponent_key", "competition_key", "season", "match_date", "kickoff_utc", "side"]
    gf, ga, p = F.col("goals_for"), F.col("goals_against"), F.col("points")
    when = lambda c: F.when(has, c)
    return base.select(
        *keys, (F.col("side") == "h").alias("is_home"), "is_finished", "has_result", when(gf).alias("goals_for"), when(ga).alias("goals_against"), when(gf - ga).alias("goal_difference"), when(gf + ga).alias("total_goals"), when(p).alias("points"),
        when(X.lookup(p, {3: "W", 1: "D", 0: "L"})).alias("team_result"), *[when((p == n).cast("int")).alias(f"is_{k}") for k, n in (("win", 3), ("draw", 1), ("loss", 0))], when((ga == 0).cast("int")).alias("is_clean_sheet"), *X.guard(fin, plain),
        F.when(fin, F.col("xg_for") - F.col("xg_against")).alias("xg_difference"), when(gf - F.col("xg_for")).alias("goals_minus_xg"), F.when(fin, X.ratio(1.0 * F.col("shots_target"), "shots")).alias("shot_accuracy"), F.when(fin, X.ratio("ppda_att", "ppda_def")).alias("ppda"),
    )


def team_season(tm: DataFrame) -> DataFrame:
    """Totals with their numbers of observations, whole and by side, in one aggregation."""
    c, has = F.col, F.col("has_result")
    flags, sums, counts = {}, {}, {}
    for prefix, on in (("", F.lit(True)), ("home_", c("side") == "h"), ("away_", c("side") == "a")):
        flags |= {f"{prefix}matches_total": on, f"{prefix}matches_finished": on & c("is_finished"), f"{prefix}matches_with_result": on & has, f"{prefix}matches_without_result": on & ~has}
        flags |= {f"{prefix}{w}": on & has & (c("team_result") == r) for r, w in (("W", "wins"), ("D", "draws"), ("L", "losses"))}
        sums |= {f"{prefix}{m}_total": F.when(on & has, c(m)) for m in ("points", "goals_for", "goals_against", "goal_difference")}
    for m in SUMS:
        sums[f"{m}_total"], counts[f"{m}_observations"] = F.when(has, c(m)), F.when(has, c(m))
    for name, num, den in (("shot_accuracy", "shots_target", "shots"), ("ppda", "ppda_att", "ppda_def")):
        both = has & c(num).isNotNull() & c(den).isNotNull()
        sums |= {f"{name}_numerator_total": F.when(both, c(num)), f"{name}_denominator_total": F.when(both, c(den))}
        counts[f"{name}_observations"] = F.when(both, 1)
    keys = ["competition_key", "season", "team_key"]
    # Matches are counted once each: flags are first raised per match, which many distinct counts would expand.
    per_match = tm.groupBy(*keys, "match_key").agg(F.count("*").alias("source_row_count"), *[F.max(F.coalesce(x, F.lit(False)).cast("int")).alias(n) for n, x in flags.items()], *[F.sum(x).alias(n) for n, x in sums.items()], *[F.count(x).alias(n) for n, x in counts.items()])
    g = per_match.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in ("source_row_count", *flags, *sums, *counts)])
    rates = {}
    for p in ("", "home_", "away_"):
        rates |= {f"{p}points_per_match": X.ratio(1.0 * c(f"{p}points_total"), f"{p}matches_with_result"), f"{p}win_rate": X.ratio(1.0 * c(f"{p}wins"), f"{p}matches_with_result")}
    rates |= {f"{m}_per_match": X.ratio(1.0 * c(f"{m}_total"), f"{m}_observations") for m in ("xg_for", "xg_against", "shots", "shots_target")}
    rates |= {n: X.ratio(1.0 * c(f"{n}_numerator_total"), f"{n}_denominator_total") for n in ("shot_accuracy", "ppda")}
    return g.withColumns(rates)


def player_season(stats: DataFrame, players: DataFrame) -> DataFrame:
    p = players.select("player_key", "player_name", "nationality", "date_of_birth", "photo_url")
    return stats.join(p, "player_key", "left").withColumns({
        "player_name": F.coalesce("player_name", "player_key"), "goal_contributions": F.col("goals") + F.col("assists"), "xg_contributions": F.col("xg") + F.col("xa"),
        "shot_conversion_rate": F.when(F.col("shots") > 0, F.round(F.col("goals") * 1.0 / F.col("shots"), 3)),
    })
