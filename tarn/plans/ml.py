"""Point-in-time marts: ``f_*`` is known before the event, ``y_*`` only after it.

Every result counts from ``known_ts`` on: three hours after kick-off, or the end of a day without one;
a prediction at ``ord_ts`` sees only what was known strictly before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.operators.resolve import first_variant_hit, name_variants, small
from tarn.operators.snapshot import latest
from tarn.operators.temporal import all_known, asof_join, range_agg, roll_avg, sum_before

MIN_DATE = "2000-01-01"
L5 = {"gd": "gd", "win": "win_rate", "cs": "cs_rate", "btts": "btts_rate", "over25": "over25_rate", "xg_for": "xgf", "xg_against": "xga", "shots": "shots", "shots_target": "sot", "corners": "corners", "fouls": "fouls", "yellows": "yellows", "reds": "reds", "ppda": "ppda", "deep": "deep", "deep_allowed": "deep_allowed", "npxg": "npxg", "npxga": "npxga"}
BASIC = {"points": "pts", "goals_for": "gf", "goals_against": "ga"}


def ord_ts(kick: str = "kickoff_utc", day: str = "match_date") -> Column:
    return F.coalesce(F.col(kick).cast("timestamp_ntz"), F.col(day).cast("timestamp_ntz"))


def known_ts(kick: str = "kickoff_utc", day: str = "match_date") -> Column:
    late = F.col(day).cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    return F.coalesce(F.col(kick).cast("timestamp_ntz") + F.expr("INTERVAL 3 HOUR"), late)


def team_match_features(t: DataFrame, min_date: str = MIN_DATE) -> DataFrame:
    """Form, side, season and head-to-head histories of each team before each of its matches.

    One time line a team: every match stands on it when it is predicted, a played one again when it is known.
    All families (by team, side, season, opponent) roll over the known rows and carry their last values along
    the same line, and the days-back counts are range frames on it, so matches are shuffled once, by team.
    """
    c = F.col
    gf, ga = c("goals_for"), c("goals_against")
    base = t.filter(c("team_key").isNotNull() & (c("match_date") >= F.lit(min_date).cast("date"))).withColumns({"ord_ts": ord_ts(), "known_ts": known_ts(), "played": F.coalesce(c("is_finished") & gf.isNotNull() & ga.isNotNull(), F.lit(False)), "ppda": X.ratio("ppda_att", "ppda_def")})
    base = base.withColumns({"win": (c("points") == 3).cast("int"), "cs": (ga == 0).cast("int"), "btts": ((gf > 0) & (ga > 0)).cast("int"), "over25": (gf + ga > 2).cast("int"), "gd": gf - ga, "res": F.when(c("points") == 3, "W").when(c("points") == 1, "D").otherwise("L")})
    line = base.withColumn("_known", F.explode(F.when(c("played"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    line = line.withColumns({"_at": F.when(c("_known"), c("known_ts")).otherwise(c("ord_ts")), "_us": F.unix_micros(c("ord_ts").cast("timestamp"))}).repartition("team_key")
    over = lambda *by: Window.partitionBy(*by, "_known").orderBy("known_ts", "match_key")
    w, ws = over("team_key"), over("team_key", "side")
    wy = over("team_key", "competition_key", "season").rowsBetween(Window.unboundedPreceding, 0)
    wh = over("team_key", "opponent_key").rowsBetween(-4, 0)
    last5 = w.rowsBetween(-4, 0)
    team = {"f_n_prev": F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)), "last_ord_ts": c("ord_ts"), "f_form5": F.when(F.count("res").over(last5) >= 5, F.array_join(F.collect_list("res").over(last5), ""))}
    for n in (3, 5, 10):
        team |= {f"f_{k}_l{n}": roll_avg(m, w, n) for m, k in BASIC.items()}
    team |= {f"f_{k}_l5": roll_avg(m, w, 5) for m, k in L5.items()} | {"f_xgf_l10": roll_avg("xg_for", w, 10), "f_xga_l10": roll_avg("xg_against", w, 10), "f_win_rate_l10": roll_avg("win", w, 10), "f_pts_l20": roll_avg("points", w, 20), "f_gd_l20": roll_avg("gd", w, 20)}
    side = {f"f_side_{k}_l5": roll_avg(m, ws, 5) for m, k in BASIC.items()}
    year = {"f_s_played": F.count(F.lit(1)).over(wy), "f_s_ppg": F.avg("points").over(wy), "f_s_gf_pg": F.avg("goals_for").over(wy), "f_s_ga_pg": F.avg("goals_against").over(wy), "f_s_gd_pg": F.avg("gd").over(wy)}
    h2h = {"f_h2h_n": F.count(F.lit(1)).over(wh), "f_h2h_pts": F.avg("points").over(wh), "f_h2h_gf": F.avg("goals_for").over(wh), "f_h2h_ga": F.avg("goals_against").over(wh)}
    families = ((["team_key"], team), (["team_key", "side"], side), (["team_key", "competition_key", "season"], year), (["team_key", "opponent_key"], h2h))
    # in structs, since a null of the newest known match must not be passed over for an older value
    out = line.withColumns({f"_{n}": F.when(c("_known"), F.struct(x.alias("v"))) for _, cols in families for n, x in cols.items()})
    seen = {}
    for by, cols in families:
        past = Window.partitionBy(*by).orderBy("_at", "_known", "match_key").rowsBetween(Window.unboundedPreceding, 0)
        seen |= {n: F.when(all_known(by), F.last(f"_{n}", ignorenulls=True).over(past)["v"]) for n in cols}
    on_day = Window.partitionBy("team_key").orderBy("_us")
    begun = lambda days: F.count(F.when(c("_known"), 1)).over(on_day.rangeBetween(Window.unboundedPreceding if days is None else -days * 86_400_000_000, 0))
    out = out.withColumns({**seen, **{f"_begun{n}": begun(n) for n in (7, 14, 30)}, "_begun": begun(None)}).filter(~c("_known"))
    # a match is known within a day of its start: those that began too early are all among the known ones
    out = out.withColumns({f"f_n_{n}d": F.coalesce("f_n_prev", F.lit(0)) - (c("_begun") - c(f"_begun{n}")) for n in (7, 14, 30)})
    rest = (F.unix_timestamp(c("ord_ts").cast("timestamp")) - F.unix_timestamp(c("last_ord_ts").cast("timestamp"))) / 86400.0
    zero = ["f_n_prev", "f_s_played", "f_h2h_n", "f_n_7d", "f_n_14d", "f_n_30d"]
    out = out.withColumns({"f_rest_days": F.when(c("last_ord_ts").isNotNull(), F.least(rest, F.lit(30.0))), **{z: F.coalesce(z, F.lit(0)) for z in zero}, **{f"y_{m}": F.when(c("played"), c(m)) for m in ("goals_for", "goals_against", "points", "xg_for", "xg_against")}})
    keys = ["team_match_key", "match_key", "competition_key", "season", "match_date", "kickoff_utc", "side", "team_key", "opponent_key", "is_finished"]
    return out.select(*keys, c("played").alias("is_labeled"), *[x for x in out.columns if x.startswith(("f_", "y_"))])


def match_features(m: DataFrame, team_features: DataFrame, comp: DataFrame, teams: DataFrame | None = None, train_until: str = "2024-06-30", valid_until: str = "2025-06-30", least_history: int = 5, min_date: str = MIN_DATE) -> DataFrame:
    """One row per match: both teams' features and their differences, odds, calendar, referee, labels."""
    c = F.col
    m = m.filter(c("match_date") >= F.lit(min_date).cast("date")).withColumn("ord_ts", ord_ts())
    num = [x for x in team_features.columns if x.startswith("f_") and x not in ("f_form5", "f_h2h_n")]
    # one row a match and side: the maximum is the only value, and unused columns are pruned
    at = lambda s, x: F.max(F.when(c("side") == s, c(x)))
    both = team_features.groupBy("match_key").agg(*[at(s, "side").alias(f"_{s}") for s in "ha"], *[at(s, x).alias(f"{s}_{x}") for s in "ha" for x in [*num, "f_form5", "f_h2h_n"]])
    j = m.join(both.filter("_h is not null and _a is not null").drop("_h", "_a"), "match_key")
    for name in ("mkt_avg", "b365", "odds_api"):
        for s in ("home", "draw", "away"):
            if f"{name}_{s}" not in j.columns:
                j = j.withColumn(f"{name}_{s}", F.lit(None).cast("double"))
    if "odds_api_updated_at" not in j.columns:
        j = j.withColumn("odds_api_updated_at", F.lit(None).cast("timestamp_ntz"))
    full = lambda n: (c(f"{n}_home") > 1) & (c(f"{n}_draw") > 1) & (c(f"{n}_away") > 1)
    src = F.when(full("mkt_avg"), "mkt_avg").when(full("b365"), "b365").when(full("odds_api") & (c("odds_api_updated_at").cast("timestamp_ntz") <= c("ord_ts")), "odds_api")
    odds = {f"_o{s}": F.when(c("odds_src") == "mkt_avg", c(f"mkt_avg_{s}")).when(c("odds_src") == "b365", c(f"b365_{s}")).when(c("odds_src") == "odds_api", c(f"odds_api_{s}")) for s in ("home", "draw", "away")}
    j = j.withColumn("odds_src", src).withColumns(odds)
    o3 = ["_ohome", "_odraw", "_oaway"]
    wr = Window.partitionBy("referee").orderBy("known_ts", "match_key")
    cards = c("home_yellows") + c("away_yellows") + F.coalesce("home_reds", F.lit(0)) + F.coalesce("away_reds", F.lit(0))
    refs = m.filter(c("referee").isNotNull() & c("is_finished") & c("home_yellows").isNotNull() & c("away_yellows").isNotNull()).withColumns({"known_ts": known_ts(), "cards": cards, "fouls": c("home_fouls") + c("away_fouls")})
    over = wr.rowsBetween(-49, 0)
    refs = refs.select("referee", "known_ts", "match_key", F.count(F.lit(1)).over(over).alias("f_ref_n_prev"), roll_avg("cards", wr, 50, 10).alias("f_ref_avg_cards"), roll_avg("fouls", wr, 50, 10).alias("f_ref_avg_fouls"))
    ref_cols = ["f_ref_n_prev", "f_ref_avg_cards", "f_ref_avg_fouls"]
    judged = asof_join(m.select("match_key", "referee", "ord_ts"), refs, ["referee"], "ord_ts", "known_ts", ref_cols, tie=["match_key"])
    j = j.join(judged.select("match_key", *ref_cols), "match_key", "left")  # only narrow rows are sorted by referee
    j = j.join(small(comp.select("competition_key", c("tier").alias("f_comp_tier"))), "competition_key", "left")
    if teams is not None:
        j = j.join(teams.select(c("team_key").alias("home_key"), c("stadium_capacity").alias("f_home_stadium_capacity")), "home_key", "left")
    labeled = F.coalesce(c("is_finished") & c("home_goals").isNotNull() & c("away_goals").isNotNull(), F.lit(False))
    d = c("match_date")
    split = F.when(~labeled, "predict").when(d <= F.lit(train_until).cast("date"), "train").when(d <= F.lit(valid_until).cast("date"), "valid").otherwise("test")
    y = lambda x: F.when(labeled, x)
    hg, ag, tot = c("home_goals"), c("away_goals"), c("total_goals")
    fan = [e for f in num for e in (c(f"h_{f}").alias(f"f_home_{f[2:]}"), c(f"a_{f}").alias(f"f_away_{f[2:]}"), (c(f"h_{f}") - c(f"a_{f}")).alias(f"f_diff_{f[2:]}"))]
    weather = [c(x).alias(f"f_{x}") for x in j.columns if x.startswith("weather_") and x != "weather_code"]
    keep = [x for x in ("match_key", "competition_key", "season", "match_date", "kickoff_utc", "home_key", "away_key", "fdo_match_id", "understat_match_id", "af_fixture_id", "openliga_match_id", "status", "is_finished", "goals_conflict", "in_fdo", "in_couk", "in_understat", "in_api_football", "in_openliga") if x in j.columns]
    n2 = lambda s: c(f"{s}_yellows") + F.coalesce(f"{s}_reds", F.lit(0))
    return j.select(
        *keep, labeled.alias("is_labeled"), split.alias("split"), ((c("h_f_n_prev") >= least_history) & (c("a_f_n_prev") >= least_history)).alias("is_warm"), "odds_src", c("odds_src").isNotNull().alias("has_odds"), c("home_xg").isNotNull().alias("has_xg"), *fan, c("h_f_h2h_n").alias("f_h2h_n"), c("h_f_form5").alias("f_home_form5"), c("a_f_form5").alias("f_away_form5"),
        *[X.implied_prob(o3, i).alias(f"f_mkt_p_{s}") for i, s in enumerate(("home", "draw", "away"))], F.when(X.implied_prob(o3, 0).isNotNull(), X.overround(o3)).alias("f_mkt_overround"), X.iso_day_of_week(d).alias("f_dow"), F.month(d).alias("f_month"), (X.iso_day_of_week(d) >= 6).cast("int").alias("f_is_weekend"), F.hour("kickoff_utc").alias("f_kickoff_hour_utc"), c("matchday").try_cast("int").alias("f_matchday"), "f_comp_tier",
        *(["f_home_stadium_capacity"] if teams is not None else []), *weather, F.coalesce("f_ref_n_prev", F.lit(0)).alias("f_ref_n_prev"), "f_ref_avg_cards", "f_ref_avg_fouls",
        y(hg).alias("y_home_goals"), y(ag).alias("y_away_goals"), y(tot).alias("y_total_goals"), y(hg - ag).alias("y_goal_diff"), y(c("result")).alias("y_result"), y(X.lookup("result", {"A": 0, "D": 1, "H": 2}, "int")).alias("y_result_code"), y(((hg > 0) & (ag > 0)).cast("int")).alias("y_btts"), *[y((tot > n).cast("int")).alias(f"y_over_{n}_5") for n in (1, 2, 3)],
        c("home_xg").alias("y_home_xg"), c("away_xg").alias("y_away_xg"), (c("home_corners") + c("away_corners")).alias("y_total_corners"), (n2("home") + n2("away")).alias("y_total_cards"),
    )


def temporal_audit(features: DataFrame) -> DataFrame:
    cols = ["match_key", "competition_key", "season", "match_date", "kickoff_utc", "split", "home_key", "away_key", "f_home_n_prev", "f_away_n_prev", "is_warm", "odds_src", "has_odds", "is_finished", "is_labeled", "y_result", "y_home_goals", "y_away_goals"]
    return features.select(*cols, F.col("kickoff_utc").isNull().alias("is_missing_kickoff"), ord_ts().alias("ord_ts"), known_ts().alias("known_ts"))


def shots(s: DataFrame, players: DataFrame | None = None) -> DataFrame:
    """Geometry, circumstances and the score before each shot (shots of the same minute unseen)."""
    c = F.col
    goal = lambda side: ((c("side") == side) & (c("result") == "Goal")).cast("int")
    s = s.withColumns({"_hg": goal("h"), "_ag": goal("a")}).withColumns({"_hb": sum_before("_hg", ["match_id"], "minute"), "_ab": sum_before("_ag", ["match_id"], "minute")})
    if players is not None:
        s = s.join(players.select(c("understat_player_id").alias("_pid"), "player_key"), c("player_id").cast("string") == c("_pid"), "left").drop("_pid")
    return s.withColumns({
        "f_minute": c("minute"), "f_x": c("x_coord"), "f_y": c("y_coord"), "f_distance_m": X.pitch_distance("x_coord", "y_coord"), "f_angle_rad": F.atan2(7.32 * (1 - c("x_coord")) * 105.0, F.pow((1 - c("x_coord")) * 105.0, 2) + F.pow((0.5 - c("y_coord")) * 68.0, 2) - 3.66 * 3.66),
        "f_is_header": (c("shot_type") == "Head").cast("int"), "f_is_penalty": (c("situation") == "Penalty").cast("int"), "f_is_assisted": c("assisted_by").isNotNull().cast("int"), "f_score_diff_before": F.when(c("side") == "h", c("_hb") - c("_ab")).otherwise(c("_ab") - c("_hb")), "y_is_goal": (c("result") == "Goal").cast("int"), "benchmark_xg": c("xg"), "is_home": c("side") == "h",
    }).drop("_hg", "_ag", "_hb", "_ab")


def goals(g: DataFrame, matches: DataFrame) -> DataFrame:
    c = F.col
    j = g.filter(c("scoring_side").isin("home", "away")).join(matches.select("match_key", "home_key", "away_key"), "match_key")
    s = X.game_state("minute", "scoring_side", "home_score_after", "away_score_after")
    diff = F.when(c("scoring_side") == "home", s["home_before"] - s["away_before"]).otherwise(s["away_before"] - s["home_before"])
    return j.withColumns({
        "f_minute": c("minute"), "f_minute_bucket": s["minute_bucket"], "f_home_goals_before": s["home_before"], "f_away_goals_before": s["away_before"], "f_scorer_diff_before": diff, "f_scorer_is_home": (c("scoring_side") == "home").cast("int"),
        "y_state_before_goal": F.when(diff < 0, "trailing").when(diff == 0, "tied").otherwise("leading"), "y_is_equalizer": (diff == -1).cast("int"), "y_is_go_ahead": (diff == 0).cast("int"), "y_is_penalty": c("is_penalty").cast("int"), "y_is_own_goal": c("is_own_goal").cast("int"), "y_is_late_goal": s["is_late"].cast("int"),
    })


# Name parts that are cut off a club's name, so that keys equal those of the page views' source.
SUFFIX = r" (f c|fc|cf|afc|a c|ac|sc|ssc|s s c)$"
PREFIX = r"^(fc|afc|ac|as|ssc|sv|vfl|vfb|tsg|rc|ud|cd|ca|sd|us|ss) "


def team_attention_daily(views: DataFrame, alias: DataFrame) -> DataFrame:
    """Views per team and day: articles are matched by four rewrites of their names, the first hit wins."""
    tight = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    arts = views.filter("entity_type = 'team'").select("article").distinct().withColumn("n0", X.name_norm(F.replace("article", F.lit("%26"), F.lit("&"))))
    cut = F.regexp_replace("n0", SUFFIX, "")
    de = lambda x: F.replace(x, F.lit(" de "), F.lit(" "))
    arts = arts.withColumn("v0", tight(F.col("n0")))
    v = name_variants(arts, "v0", [tight(cut), tight(de(cut)), tight(de(F.regexp_replace(cut, PREFIX, "")))], ["article"])
    names = alias.select(tight(X.name_norm("alias")).alias("compact"), "team_key").filter("compact <> ''").groupBy("compact").agg(F.min("team_key").alias("team_key"))
    hit = first_variant_hit(v, ["article"], names, "compact", "team_key")
    ok = views.filter("entity_type = 'team' and view_date is not null and views is not null").join(hit, "article")
    return _daily(ok, ["team_key"])


def _daily(v: DataFrame, keys: list[str]) -> DataFrame:
    return v.groupBy(*keys, "view_date").agg(F.sum("views").alias("views_total"), F.sum(F.when(F.col("lang") == "en", F.col("views"))).alias("views_en"), F.count_distinct("lang").alias("n_langs"))


def player_attention_daily(views: DataFrame, players: DataFrame) -> DataFrame:
    """Views per player article and day; a name that several players share links to none."""
    uniq = players.filter("name_norm is not null").groupBy("name_norm").agg(F.min("player_key").alias("player_key"), F.count_distinct("player_key").alias("n")).filter("n = 1").drop("n")
    name = X.name_norm(F.replace(F.replace("article", F.lit("%26"), F.lit("&")), F.lit("_"), F.lit(" ")))
    v = views.filter("entity_type = 'player' and view_date is not null and views is not null").withColumn("name_norm", name).join(uniq, "name_norm", "left").withColumnRenamed("article", "player_article")
    return _daily(v, ["player_article", "player_key"])


def match_attention(m: DataFrame, daily: DataFrame, least_days: int = 14) -> DataFrame:
    """Mean views of the 7 and 28 days before a match, where enough days are covered."""
    c, out = F.col, m.select("match_key", "match_date", "home_key", "away_key")
    for s in ("home", "away"):
        r = daily.select(c("team_key").alias(f"{s}_key"), "view_date", "views_total")
        aggs = [F.avg(F.when(c("_rd") >= c("_ld") - 7, c("views_total"))).alias(f"_{s}7"), F.avg("views_total").alias(f"_{s}28"), F.count("*").alias(f"_{s}n")]
        out = range_agg(out, r, [f"{s}_key"], ["match_key"], "match_date", "view_date", 28, aggs)
        ok = c(f"_{s}n") >= least_days
        out = out.withColumns({f"f_{s}_att_7d": F.when(ok, c(f"_{s}7")), f"f_{s}_att_28d": F.when(ok, c(f"_{s}28")), f"f_{s}_att_ratio": F.when(ok, X.ratio(f"_{s}7", f"_{s}28"))})
    both = (c("f_home_att_7d") > 0) & (c("f_away_att_7d") > 0)
    out = out.withColumn("f_att_log_ratio_7d", F.when(both, F.ln(c("f_home_att_7d") / c("f_away_att_7d"))))
    return out.filter((c("_homen") >= least_days) | (c("_awayn") >= least_days)).drop(*[f"_{s}{x}" for s in ("home", "away") for x in ("7", "28", "n")])


def player_season_features(p: DataFrame, players: DataFrame, comp: DataFrame, today: Column | None = None) -> DataFrame:
    """A player's rates of the two seasons before (by season number, not by row)."""
    c = F.col
    today = F.current_date() if today is None else today
    sums = ["minutes_played", "games", "goals", "assists", "xg", "xa", "shots", "key_passes"]
    tot = p.groupBy("player_key", "season").agg(*[F.sum(s).alias(s) for s in sums]).withColumnRenamed("minutes_played", "minutes")
    rates = ["goals", "xg", "assists", "xa", "shots", "key_passes"]
    tot = tot.withColumns({f"{r}_p90": F.when(c("minutes") >= 450, c(r) * 90.0 / c("minutes")) for r in rates})
    keep = ["minutes", "games", *[f"{r}_p90" for r in rates]]
    past = p.select("player_key", "season").distinct()
    for back, cols in ((1, keep), (2, ["minutes", "goals_p90", "xg_p90"])):
        prev = tot.select("player_key", (c("season") + back).alias("season"), *[c(k).alias(f"f_prev{back}_{k}") for k in cols], *([F.lit(1).alias("f_has_prev1")] if back == 1 else []))
        past = past.join(prev, ["player_key", "season"], "left")
    dp = players.select("player_key", "date_of_birth", "nationality", c("height_cm").alias("f_height_cm"))
    out = p.join(past, ["player_key", "season"]).join(dp, "player_key", "left").join(F.broadcast(comp.select("competition_key", c("tier").alias("f_comp_tier"))), "competition_key", "left")
    done = c("season") < X.season_of(today)
    names = {"minutes_played": "y_minutes", **{x: f"y_{x}" for x in ("games", "goals", "assists", "xg", "xa", "goals_per90", "xg_per90", "xa_per90") if x in out.columns}}
    return out.withColumns({"f_age": X.age_years("date_of_birth", F.make_date("season", F.lit(8), F.lit(1))), "f_has_prev1": F.coalesce("f_has_prev1", F.lit(0)), "season_complete": done, "is_reliable_target": done & (c("minutes_played") >= 900)}).withColumnsRenamed(names)


def text_marts(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One row per text document, with the queries that found it, counts, hashes and dates seen."""
    c = F.col
    words = lambda x: F.size(F.split(F.trim(F.coalesce(x, F.lit(""))), " "))
    digest = lambda x: F.md5(F.lower(F.trim(F.coalesce(x, F.lit("")))))
    seen = [F.min("ingest_date").alias("first_seen_date"), F.max("ingest_date").alias("last_seen_date")]
    first = lambda *cols: [F.min(x).alias(x) for x in cols]
    out: dict[str, DataFrame] = {}
    if "stg_google_news" in t:
        g = t["stg_google_news"].groupBy("news_id").agg(*first("title", "summary", "url", "publisher", "published_at", "language", "source_type"), F.array_sort(F.collect_set("search_query")).alias("search_queries"), *seen)
        out["google_news"] = g.withColumn("text", F.trim(F.concat_ws(" ", "title", "summary"))).withColumns({"doc_date": F.to_date("published_at"), "n_words": words(c("text")), "title_hash": digest(c("title"))})
    if "stg_football_news" in t:
        g = t["stg_football_news"].filter("url is not null").groupBy("url").agg(*first("title", "image_url", "source_name", "published_at"), *seen)
        out["football_news"] = g.withColumns({"news_id": F.md5("url"), "doc_date": F.to_date("published_at"), "text": c("title"), "n_words": words(c("title")), "title_hash": digest(c("title"))})
    if "stg_wikipedia" in t:
        out["wikipedia"] = latest(t["stg_wikipedia"], ["page_id", "language", "category"], [F.desc_nulls_last("fetched_date")]).withColumn("n_words_counted", words(c("content")))
    if "stg_youtube_videos" in t and "stg_youtube_comments" in t:
        com = latest(t["stg_youtube_comments"], ["comment_id"], [F.desc_nulls_last("ingest_date")])
        v = t["stg_youtube_videos"].groupBy("video_id").agg(*first("title", "description", "channel_id", "channel_title", "published_at"), F.array_sort(F.collect_set("search_query")).alias("search_queries"), *seen)
        n = t["stg_youtube_comments"].groupBy("video_id").agg(F.count("*").alias("n_comments_collected"), F.sum("like_count").alias("comment_likes_sum"))
        out["youtube_videos"] = v.join(n, "video_id", "left").fillna(0, ["n_comments_collected", "comment_likes_sum"]).withColumn("text", F.trim(F.concat_ws(" ", "title", "description"))).withColumns({"doc_date": F.to_date("published_at"), "n_words": words(c("text")), "title_hash": digest(c("title"))})
        short = v.select("video_id", c("title").alias("video_title"), c("channel_title").alias("video_channel_title"), c("published_at").alias("video_published_at"))
        out["youtube_comments"] = com.join(short, "video_id", "left").withColumns({"doc_date": F.to_date("published_at"), "n_words": words(c("text")), "text_hash": digest(c("text")), "days_after_video": F.datediff("published_at", "video_published_at")})
    return out
