import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarn.plans import bi, core, features, ml
from tarn.plans.q_marts import matches

SF = "/root/testdata/sf0.001"
T = dt.datetime


def team_rows(spark, rows):
    cols = "match_key string, match_date date, kickoff_utc timestamp_ntz, team_key string, opponent_key string, goals_for int, goals_against int"
    df = spark.createDataFrame(rows, cols)
    gf, ga = F.col("goals_for"), F.col("goals_against")
    none = {c: F.lit(None).cast("double") for c in ("xg_for", "xg_against", "shots", "shots_target", "corners", "fouls", "yellows", "reds", "ppda_att", "ppda_def", "deep", "deep_allowed", "npxg", "npxga", "xpts")}
    return df.withColumns({**none, "side": F.lit("h"), "competition_key": F.lit("EPL"), "season": F.lit(2025), "is_finished": F.lit(True), "team_match_key": F.col("match_key"), "points": F.when(gf > ga, 3).when(gf == ga, 1).when(gf < ga, 0)})


def test_no_row_sees_itself_its_day_or_the_future(spark):
    rows = [("m1", dt.date(2026, 1, 1), T(2026, 1, 1, 12), "A", "B", 1, 0), ("m2", dt.date(2026, 1, 1), T(2026, 1, 1, 14), "A", "C", 0, 0), ("m3", dt.date(2026, 1, 1), T(2026, 1, 1, 16), "A", "B", 0, 2), ("m4", dt.date(2026, 1, 2), None, "A", "B", 2, 0), ("m5", dt.date(2026, 1, 2), None, "A", "B", 5, 0), ("m6", dt.date(2026, 1, 3), None, "A", "B", None, None), ("m7", dt.date(2026, 2, 20), None, "A", "B", 1, 1)]
    got = {r.match_key: r for r in ml.team_match_features(team_rows(spark, rows)).collect()}
    assert [got[f"m{i}"].f_n_prev for i in range(1, 8)] == [0, 0, 1, 3, 3, 5, 5]
    assert got["m3"].f_pts_l3 is None and got["m4"].f_pts_l3 == pytest.approx(4 / 3) and got["m6"].f_form5 == "WDLWW"
    assert got["m6"].f_n_7d == 5 and got["m7"].f_n_30d == 0 and got["m7"].f_rest_days == 30 and not got["m6"].is_labeled
    more = {r.match_key: r for r in ml.team_match_features(team_rows(spark, rows + [("m9", dt.date(2027, 1, 1), None, "A", "B", 9, 9)])).collect()}
    assert all(more[k] == got[k] for k in got)


def test_consolidation_by_priority_with_conflicts(spark):
    alias = core.aliases(spark.createDataFrame([("s", "Alpha FC", "Alpha"), ("s", "B United", "Beta")], "source string, alias string, team_key string"))
    comp = core.dim_competition(spark)
    fdo = spark.createDataFrame([(1, "PL", T(2026, 1, 1, 15), "Alpha FC", "Beta", "FINISHED", "REG", 3, "Ref", 2, 1, 1, 0)], "match_id int, competition_code string, utc_date timestamp_ntz, home_team string, away_team string, status string, stage string, matchday int, referee string, home_goals int, away_goals int, ht_home_goals int, ht_away_goals int")
    us = spark.createDataFrame([(9, "EPL", T(2026, 1, 1, 15), "alpha", " b united ", True, 2, 2, 1.5, 0.5, 0.5, 0.3, 0.2), (10, "EPL", T(2026, 1, 2, 15), "Same", "same", True, 1, 1, 0.1, 0.1, 0.3, 0.3, 0.4)], "match_id int, league string, match_date timestamp_ntz, home_team_name string, away_team_name string, is_result boolean, home_goals int, away_goals int, home_xg double, away_xg double, forecast_home_win double, forecast_draw double, forecast_away_win double")
    t = {"stg_football_data_org_matches": fdo, "stg_understat_matches": us}
    rows = core.consolidate(core.match_sources(t, alias, comp)).collect()
    r = next(x for x in rows if x.home_key == "Alpha")
    assert (r.away_key, r.competition_key, r.season, r.home_goals, r.away_goals, r.result, r.goals_conflict, r.in_fdo, r.in_understat, r.in_couk, r.home_xg, r.fdo_match_id, r.understat_match_id) == ("Beta", "EPL", 2025, 2, 1, "H", True, True, True, False, 1.5, "1", "9")


def test_players_link_by_birth_date_or_only_candidate(spark):
    alias = spark.createDataFrame([], "alias string, team_key string")
    p = spark.createDataFrame([(1, "José Peña", dt.date(2000, 1, 1), "ES", "FW", "T"), (2, "Ann Two", dt.date(1999, 1, 1), "UK", "GK", "T"), (3, "Ann Two", dt.date(1998, 1, 1), "UK", "GK", "U")], "player_id int, name string, date_of_birth date, nationality string, position string, team_name string")
    u = spark.createDataFrame([(7, "Jose Pena", "FW", "S,T", 2025, "EPL"), (8, "Ann Two", "GK", "Z", 2025, "EPL")], "player_id int, player_name string, position string, team_name string, season int, league string")
    none = {k: None for k in ("stg_players", "stg_wikidata_players", "stg_thesportsdb_players")}
    keys = core.player_keys(core.player_sightings({"stg_football_data_org_players": p, "stg_understat_players": u, **none}, alias))
    d = {r.player_name: r for r in core.dim_player(keys).collect()}
    assert d["José Peña"].understat_player_id == "7" and d["José Peña"].n_sources == 2
    assert keys.filter("source = 'understat' and source_player_id = '8'").first().player_key == "understat_8"


def test_business_marts_keep_their_invariants(spark):
    m = matches(spark, SF)
    a = bi.match_analysis(m)
    assert a.count() == m.count() and a.filter("not has_result and home_points is not null").count() == 0
    t = bi.team_match(core.fact_team_match(m))
    s = bi.team_season(t)
    assert s.filter("wins + draws + losses <> matches_with_result or matches_total <> home_matches_total + away_matches_total").count() == 0
    assert s.agg(F.sum("source_row_count")).first()[0] == 2 * m.count()


def test_feature_tables_and_wide(spark):
    c = F.col
    m = matches(spark, SF).select(c("match_key").alias("match_id"), "match_date", "season", c("competition_key").alias("competition"), c("home_key").alias("home"), c("away_key").alias("away"), "home_goals", "away_goals", F.lit(None).cast("timestamp").alias("kickoff"))
    teams = m.select(c("home").alias("team")).union(m.select("away")).distinct()
    views = teams.crossJoin(m.select(c("match_date").alias("day")).distinct()).withColumn("views", F.pmod(F.xxhash64("team", "day"), F.lit(100)))
    inj = teams.withColumns({"player": F.concat(F.lit("p"), "team"), "day": F.lit("1996-01-01").cast("date"), "xg": F.lit(0.5)})
    com = teams.withColumns({"day": F.lit("1996-01-01").cast("date"), "text": F.lit("good win")})
    ven = teams.withColumns({"lat": c("team").cast("double"), "lon": c("team").cast("double")})
    parts = {
        "form": features.rolling_form(m), "position": features.season_position(m), "elo": features.elo_features(m), "h2h": features.head_to_head(m), "attention": features.attention(m, views), "injury": features.injury_load(m, inj), "media": features.media_shock(m, views), "sentiment": features.comment_sentiment(m, com, ["good"], ["bad"]), "context": features.match_context(m), "travel": features.travel_distance(m, ven),
    }
    w = features.match_360(m, parts)
    assert w.count() == m.count() and features.builder_checks(m, features.sides(m), parts["form"]) == {"row_excess": 0, "first_match_leak": 0}
    assert features.feature_catalog(spark, parts).filter("feature_group = 'elo'").count() == 7
    assert w.filter("elo_p_home + elo_p_draw + elo_p_away not between 0.999999 and 1.000001").count() == 0


def test_attention_and_text_marts(spark):
    v = spark.createDataFrame([("team", "en", "Foo_F.C.", dt.date(2026, 1, d), 10 * d) for d in range(1, 20)] + [("team", "de", "Foo", dt.date(2026, 1, 1), 5), ("player", "en", "Jos%C3%A9", dt.date(2026, 1, 1), 3)], "entity_type string, lang string, article string, view_date date, views int")
    alias = spark.createDataFrame([("foo", "Foo")], "alias string, team_key string")
    d = ml.team_attention_daily(v, alias)
    assert d.filter("view_date = '2026-01-01'").first().views_total == 15 and d.count() == 19
    m = spark.createDataFrame([("m", dt.date(2026, 1, 20), "Foo", "Bar")], "match_key string, match_date date, home_key string, away_key string")
    (a,) = ml.match_attention(m, d).collect()
    assert a.f_home_att_7d == 160 and a.f_away_att_7d is None and a.f_att_log_ratio_7d is None
    news = spark.createDataFrame([("g", q, "T", None, "u", "p", T(2026, 1, 1), "en", "rss", dt.date(2026, 1, n)) for n, q in ((2, "b"), (1, "a"))], "news_id string, search_query string, title string, summary string, url string, publisher string, published_at timestamp_ntz, language string, source_type string, ingest_date date")
    (r,) = ml.text_marts({"stg_google_news": news})["google_news"].collect()
    assert r.search_queries == ["a", "b"] and r.n_words == 1 and str(r.first_seen_date) == "2026-01-01"


def test_shots_and_goals(spark):
    s = spark.createDataFrame([("1", 5, "h", 10, 0.9, 0.5, 0.3, "Goal", "Head", "OpenPlay", None), ("2", 5, "a", 10, 0.8, 0.5, 0.1, "Saved", "Foot", "Penalty", "x"), ("3", 5, "a", 11, 0.8, 0.4, 0.1, "Goal", "Foot", "OpenPlay", "x")], "shot_id string, match_id int, side string, minute int, x_coord double, y_coord double, xg double, result string, shot_type string, situation string, assisted_by string")
    got = {r.shot_id: r for r in ml.shots(s).collect()}
    assert [got[i].f_score_diff_before for i in "123"] == [0, 0, -1] and got["1"].f_distance_m == pytest.approx(10.5)
    g = spark.createDataFrame([(1, "m", "home", 80, 1, 0, False, False), (2, "m", "away", 90, 1, 1, True, False)], "goal_id int, match_key string, scoring_side string, minute int, home_score_after int, away_score_after int, is_penalty boolean, is_own_goal boolean")
    m = spark.createDataFrame([("m", "A", "B")], "match_key string, home_key string, away_key string")
    r = {x.goal_id: x for x in ml.goals(g, m).collect()}
    assert r[1].y_is_go_ahead == 1 and r[2].y_is_equalizer == 1 and r[2].f_minute_bucket == 5
