"""The marts over matches that are derived from orders and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.operators import reshape as R
from tarn.plans import bi, core, features, ml
from tarn.plans.q_core import DAYS, orders, table
from tarn.plans.registry import register

# Each order is a match of two of its suppliers: the lines with the lowest and highest number.
MATCHES = f"""
    x AS (SELECT o_orderkey, {DAYS} AS match_date, o_orderpriority AS competition_key, o_orderstatus <> 'P' AS is_finished, o_orderkey % 23 AS ref,
                 arg_min(l_suppkey % 40, (l_linenumber, l_suppkey, l_quantity)) AS home, arg_max(l_suppkey % 40, (l_linenumber, l_suppkey, l_quantity)) AS away,
                 CAST(arg_min(l_quantity, (l_linenumber, l_suppkey, l_quantity)) AS INTEGER) AS hq, CAST(arg_max(l_quantity, (l_linenumber, l_suppkey, l_quantity)) AS INTEGER) AS aq
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
    m AS (SELECT CAST(o_orderkey AS VARCHAR) AS match_key, match_date, competition_key, is_finished, CAST(home AS VARCHAR) AS home_key, CAST(away AS VARCHAR) AS away_key,
                 CASE WHEN o_orderkey % 17 <> 0 THEN hq % 5 END AS home_goals, CASE WHEN o_orderkey % 17 <> 0 THEN aq % 4 END AS away_goals, hq AS home_shots, aq AS away_shots,
                 CASE WHEN o_orderkey % 3 <> 0 THEN hq % 7 END AS home_shots_target, CASE WHEN o_orderkey % 3 <> 0 THEN aq % 7 END AS away_shots_target,
                 CAST(CASE WHEN month(match_date) >= 7 THEN year(match_date) ELSE year(match_date) - 1 END AS INTEGER) AS season, o_orderkey
          FROM x WHERE home <> away)"""


def matches(spark: SparkSession, d: str) -> DataFrame:
    c, i = F.col, lambda x: x.cast("int")
    j = orders(spark, d).join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    at = c("l_linenumber").cast("long") * (1 << 50) + c("l_suppkey") * 8192 + (c("l_quantity") * 100).cast("long")  # one long: minima of structs are sorted for
    x = j.groupBy("o_orderkey", c("day").alias("match_date"), c("o_orderpriority").alias("competition_key"), c("o_orderstatus")).agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    hq, aq = (i(F.floor(c(s) % 8192 / 100)) for s in ("lo", "hi"))
    side = lambda s: (F.shiftright(c(s) % (1 << 50), 13) % 40).cast("string")
    known, shot = c("o_orderkey") % 17 != 0, c("o_orderkey") % 3 != 0
    none = F.lit(None).cast("int")
    m = x.select(
        c("o_orderkey").cast("string").alias("match_key"), "match_date", "competition_key", (c("o_orderstatus") != "P").alias("is_finished"), side("lo").alias("home_key"), side("hi").alias("away_key"), F.when(known, hq % 5).alias("home_goals"), F.when(known, aq % 4).alias("away_goals"),
        hq.alias("home_shots"), aq.alias("away_shots"), F.when(shot, hq % 7).alias("home_shots_target"), F.when(shot, aq % 7).alias("away_shots_target"), F.lit(None).cast("timestamp_ntz").alias("kickoff_utc"), "o_orderkey",
        *[none.alias(f"{s}_{k}") for k in ("corners", "fouls", "yellows", "reds") for s in ("home", "away")], *[F.lit(None).cast("double").alias(f"{s}_xg") for s in ("home", "away")], *[none.alias(f"ht_{s}_goals") for s in ("home", "away")], (c("o_orderkey") % 23).cast("string").alias("referee"), none.alias("matchday"),
    ).filter("home_key <> away_key")
    h, a = c("home_goals"), c("away_goals")
    done = c("is_finished") & h.isNotNull()
    return m.withColumns({"season": F.when(F.month("match_date") >= 7, F.year("match_date")).otherwise(F.year("match_date") - 1), "result": F.when(done, F.when(h > a, "H").when(h == a, "D").otherwise("A")), "total_goals": F.when(c("is_finished"), h + a)})


@register("bi_match_analysis", f"""
    WITH {MATCHES}, b AS (SELECT *, is_finished AND home_goals IS NOT NULL AND away_goals IS NOT NULL AS has_result FROM m)
    SELECT match_key, has_result, is_finished AND NOT (home_goals IS NOT NULL AND away_goals IS NOT NULL) AS is_missing_final_score, CASE WHEN has_result THEN CASE WHEN home_goals > away_goals THEN 3 WHEN home_goals = away_goals THEN 1 ELSE 0 END END AS home_points,
           CASE WHEN has_result THEN home_goals - away_goals END AS goal_difference, CASE WHEN is_finished THEN home_shots + away_shots END AS total_shots, CASE WHEN is_finished THEN home_shots_target - away_shots_target END AS shots_target_difference,
           round(CASE WHEN is_finished THEN home_shots_target / nullif(home_shots, 0) END, 6) AS home_shot_accuracy, CAST(isodow(match_date) AS INTEGER) AS match_day_of_week FROM b""")
def bi_match_analysis(spark, d):
    b = bi.match_analysis(matches(spark, d))
    return b.select("match_key", "has_result", "is_missing_final_score", "home_points", "goal_difference", "total_shots", "shots_target_difference", F.round("home_shot_accuracy", 6).alias("home_shot_accuracy"), "match_day_of_week")


TEAM = f"""{MATCHES}, t AS (
    SELECT match_key, 'h' AS side, home_key AS team_key, competition_key, season, match_date, is_finished, home_goals AS gf, away_goals AS ga, home_shots AS shots, home_shots_target AS st FROM m
    UNION ALL SELECT match_key, 'a', away_key, competition_key, season, match_date, is_finished, away_goals, home_goals, away_shots, away_shots_target FROM m),
    r AS (SELECT *, is_finished AND gf IS NOT NULL AND ga IS NOT NULL AS has, CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END AS p FROM t)"""


@register("bi_team_match", f"""
    WITH {TEAM} SELECT match_key, side, team_key, CASE WHEN has THEN p END AS points, CASE WHEN has THEN CASE p WHEN 3 THEN 'W' WHEN 1 THEN 'D' ELSE 'L' END END AS team_result, CASE WHEN has THEN CAST(ga = 0 AS INTEGER) END AS is_clean_sheet, CASE WHEN is_finished THEN shots END AS shots FROM r""")
def bi_team_match(spark, d):
    return bi.team_match(core.fact_team_match(matches(spark, d))).select("match_key", "side", "team_key", "points", "team_result", "is_clean_sheet", "shots")


@register("bi_team_season", f"""
    WITH {TEAM} SELECT competition_key, season, team_key, count(*) AS source_row_count, count(DISTINCT match_key) AS matches_total, count(DISTINCT match_key) FILTER (WHERE has) AS matches_with_result, count(DISTINCT match_key) FILTER (WHERE has AND p = 3) AS wins,
           CAST(sum(p) FILTER (WHERE has) AS BIGINT) AS points_total, CAST(sum(p) FILTER (WHERE has AND side = 'h') AS BIGINT) AS home_points_total, round(sum(p) FILTER (WHERE has) / nullif(count(DISTINCT match_key) FILTER (WHERE has), 0), 6) AS points_per_match,
           count(st) FILTER (WHERE has) AS shots_target_observations, round(sum(st) FILTER (WHERE has AND st IS NOT NULL) / nullif(sum(shots) FILTER (WHERE has AND st IS NOT NULL), 0), 6) AS shot_accuracy FROM r GROUP BY ALL""")
def bi_team_season(spark, d):
    s = bi.team_season(bi.team_match(core.fact_team_match(matches(spark, d))))
    return s.select("competition_key", "season", "team_key", "source_row_count", "matches_total", "matches_with_result", "wins", "points_total", "home_points_total", F.round("points_per_match", 6).alias("points_per_match"), "shots_target_observations", F.round("shot_accuracy", 6).alias("shot_accuracy"))


@register("ml_team_features", f"""
    WITH {TEAM}, pl AS (SELECT *, CAST(match_date AS TIMESTAMP) AS ord, CAST(match_date AS TIMESTAMP) + INTERVAL '23 hours 59 minutes 59 seconds' AS known FROM r WHERE has),
    roll AS (SELECT team_key, known, match_key, count(*) OVER (w ROWS UNBOUNDED PRECEDING) AS n, CASE WHEN count(*) OVER (w ROWS 2 PRECEDING) >= 3 THEN avg(p) OVER (w ROWS 2 PRECEDING) END AS p3, CASE WHEN count(st) OVER (w ROWS 4 PRECEDING) >= 5 THEN avg(st) OVER (w ROWS 4 PRECEDING) END AS st5,
             CASE WHEN count(*) OVER (w ROWS 4 PRECEDING) >= 5 THEN array_to_string(list(CASE p WHEN 3 THEN 'W' WHEN 1 THEN 'D' ELSE 'L' END) OVER (w ROWS 4 PRECEDING), '') END AS form5 FROM pl WINDOW w AS (PARTITION BY team_key ORDER BY known, match_key)),
    last_known AS (SELECT * FROM roll QUALIFY row_number() OVER (PARTITION BY team_key, known ORDER BY match_key DESC) = 1),
    busy AS (SELECT r.match_key, r.side, count(*) AS n30 FROM r JOIN pl ON pl.team_key = r.team_key AND pl.known < CAST(r.match_date AS TIMESTAMP) AND pl.ord >= CAST(r.match_date AS TIMESTAMP) - INTERVAL 30 DAY GROUP BY ALL)
    SELECT r.match_key AS match_key, r.side AS side, coalesce(k.n, 0) AS f_n_prev, round(k.p3, 6) AS f_pts_l3, round(k.st5, 6) AS f_sot_l5, k.form5 AS f_form5, coalesce(n30, 0) AS f_n_30d, CASE WHEN r.has THEN r.p END AS y_points
    FROM (SELECT *, CAST(match_date AS TIMESTAMP) AS ord FROM r WHERE match_date >= DATE '1990-01-01') r ASOF LEFT JOIN last_known k ON k.team_key = r.team_key AND r.ord > k.known LEFT JOIN busy b ON b.match_key = r.match_key AND b.side = r.side""")
def ml_team_features(spark, d):
    f = ml.team_match_features(core.fact_team_match(matches(spark, d)), "1990-01-01")
    return f.select("match_key", "side", "f_n_prev", F.round("f_pts_l3", 6).alias("f_pts_l3"), F.round("f_sot_l5", 6).alias("f_sot_l5"), "f_form5", "f_n_30d", "y_points")


# What is known of a team before each of its matches: its own form, by side, by season, against the opponent.
FAMILIES = f"""{MATCHES}, t AS (
    SELECT match_key, 'h' AS side, home_key AS team_key, away_key AS opponent_key, competition_key, season, match_date, is_finished, home_goals AS gf, away_goals AS ga, home_shots_target AS st FROM m
    UNION ALL SELECT match_key, 'a', away_key, home_key, competition_key, season, match_date, is_finished, away_goals, home_goals, away_shots_target FROM m),
    r AS (SELECT *, CAST(match_date AS TIMESTAMP) AS ord, is_finished AND gf IS NOT NULL AND ga IS NOT NULL AS has, CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END AS p FROM t WHERE match_date >= DATE '1990-01-01'),
    pl AS (SELECT *, CAST(match_date AS TIMESTAMP) + INTERVAL '23 hours 59 minutes 59 seconds' AS known FROM r WHERE has),
    team AS (SELECT team_key, known, match_key, CASE WHEN count(*) OVER (w ROWS 9 PRECEDING) >= 10 THEN avg(gf) OVER (w ROWS 9 PRECEDING) END AS gf10, CASE WHEN count(*) OVER (w ROWS 9 PRECEDING) >= 10 THEN avg(CAST(p = 3 AS INTEGER)) OVER (w ROWS 9 PRECEDING) END AS win10 FROM pl WINDOW w AS (PARTITION BY team_key ORDER BY known, match_key)),
    team1 AS (SELECT * FROM team QUALIFY row_number() OVER (PARTITION BY team_key, known ORDER BY match_key DESC) = 1),
    side AS (SELECT team_key, side, known, match_key, CASE WHEN count(*) OVER (w ROWS 4 PRECEDING) >= 5 THEN avg(p) OVER (w ROWS 4 PRECEDING) END AS pts5 FROM pl WINDOW w AS (PARTITION BY team_key, side ORDER BY known, match_key)),
    side1 AS (SELECT * FROM side QUALIFY row_number() OVER (PARTITION BY team_key, side, known ORDER BY match_key DESC) = 1),
    year AS (SELECT team_key, competition_key, season, known, match_key, count(*) OVER w AS n, avg(p) OVER w AS ppg, avg(gf - ga) OVER w AS gd FROM pl WINDOW w AS (PARTITION BY team_key, competition_key, season ORDER BY known, match_key ROWS UNBOUNDED PRECEDING)),
    year1 AS (SELECT * FROM year QUALIFY row_number() OVER (PARTITION BY team_key, competition_key, season, known ORDER BY match_key DESC) = 1),
    met AS (SELECT team_key, opponent_key, known, match_key, count(*) OVER w AS n, avg(p) OVER w AS pts, avg(ga) OVER w AS ga FROM pl WINDOW w AS (PARTITION BY team_key, opponent_key ORDER BY known, match_key ROWS 4 PRECEDING)),
    met1 AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY team_key, opponent_key, known ORDER BY match_key DESC) = 1)"""


@register("ml_team_feature_families", f"""
    WITH {FAMILIES}
    SELECT r.match_key AS match_key, r.side AS side, round(a.gf10, 6) AS f_gf_l10, round(a.win10, 6) AS f_win_rate_l10, round(b.pts5, 6) AS f_side_pts_l5, coalesce(y.n, 0) AS f_s_played, round(y.ppg, 6) AS f_s_ppg, round(y.gd, 6) AS f_s_gd_pg, coalesce(h.n, 0) AS f_h2h_n, round(h.pts, 6) AS f_h2h_pts, round(h.ga, 6) AS f_h2h_ga
    FROM r ASOF LEFT JOIN team1 a ON a.team_key = r.team_key AND r.ord > a.known ASOF LEFT JOIN side1 b ON b.team_key = r.team_key AND b.side = r.side AND r.ord > b.known
    ASOF LEFT JOIN year1 y ON y.team_key = r.team_key AND y.competition_key = r.competition_key AND y.season = r.season AND r.ord > y.known ASOF LEFT JOIN met1 h ON h.team_key = r.team_key AND h.opponent_key = r.opponent_key AND r.ord > h.known""")
def ml_team_feature_families(spark, d):
    f = ml.team_match_features(core.fact_team_match(matches(spark, d)), "1990-01-01")
    names = ["f_gf_l10", "f_win_rate_l10", "f_side_pts_l5", "f_s_ppg", "f_s_gd_pg", "f_h2h_pts", "f_h2h_ga"]
    counts = [F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("f_s_played", "f_h2h_n")]
    return f.select("match_key", "side", *[F.round(n, 6).alias(n) for n in names], *counts)


@register("ml_match_features", f"""
    WITH {FAMILIES},
    form AS (SELECT team_key, known, match_key, count(*) OVER (w ROWS UNBOUNDED PRECEDING) AS n, CASE WHEN count(*) OVER (w ROWS 4 PRECEDING) >= 5 THEN array_to_string(list(CASE p WHEN 3 THEN 'W' WHEN 1 THEN 'D' ELSE 'L' END) OVER (w ROWS 4 PRECEDING), '') END AS form5 FROM pl WINDOW w AS (PARTITION BY team_key ORDER BY known, match_key)),
    form1 AS (SELECT * FROM form QUALIFY row_number() OVER (PARTITION BY team_key, known ORDER BY match_key DESC) = 1),
    tf AS (SELECT r.match_key, r.side, coalesce(k.n, 0) AS n, k.form5, a.gf10, b.pts5, y.ppg, coalesce(h.n, 0) AS met, h.pts AS met_pts
           FROM r ASOF LEFT JOIN team1 a ON a.team_key = r.team_key AND r.ord > a.known ASOF LEFT JOIN side1 b ON b.team_key = r.team_key AND b.side = r.side AND r.ord > b.known
           ASOF LEFT JOIN year1 y ON y.team_key = r.team_key AND y.competition_key = r.competition_key AND y.season = r.season AND r.ord > y.known
           ASOF LEFT JOIN met1 h ON h.team_key = r.team_key AND h.opponent_key = r.opponent_key AND r.ord > h.known ASOF LEFT JOIN form1 k ON k.team_key = r.team_key AND r.ord > k.known),
    q AS (SELECT *, CAST(match_date AS TIMESTAMP) AS ord, CAST(o_orderkey % 23 AS VARCHAR) AS referee, home_shots % 6 AS yellows, CASE WHEN o_orderkey % 2 = 0 THEN away_shots % 2 END AS reds, home_shots + away_shots AS fouls, is_finished AND home_goals IS NOT NULL AND away_goals IS NOT NULL AS has,
                 o_orderkey % 4 AS book, 1.0 + home_shots / 20.0 AS oh, 3.25 AS od, 1.0 + away_shots / 20.0 AS oa FROM m WHERE match_date >= DATE '1990-01-01'),
    o AS (SELECT *, CASE book WHEN 0 THEN 'mkt_avg' WHEN 1 THEN 'b365' WHEN 2 THEN CASE WHEN o_orderkey % 5 <> 0 THEN 'odds_api' END END AS odds_src, 1 / oh + 1 / od + 1 / oa AS total FROM q),
    c AS (SELECT referee, known, match_key, count(*) OVER w AS n, CASE WHEN count(*) OVER w >= 10 THEN avg(cards) OVER w END AS cards, CASE WHEN count(*) OVER w >= 10 THEN avg(fouls) OVER w END AS fouls
          FROM (SELECT referee, match_key, ord + INTERVAL '23 hours 59 minutes 59 seconds' AS known, yellows + yellows + coalesce(reds, 0) AS cards, fouls FROM q WHERE is_finished) WINDOW w AS (PARTITION BY referee ORDER BY known, match_key ROWS 49 PRECEDING)),
    c1 AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY referee, known ORDER BY match_key DESC) = 1)
    SELECT o.match_key AS match_key, CASE WHEN NOT coalesce(has, false) THEN 'predict' WHEN match_date <= DATE '1996-06-30' THEN 'train' WHEN match_date <= DATE '1997-06-30' THEN 'valid' ELSE 'test' END AS split,
           CASE WHEN has THEN CASE WHEN home_goals > away_goals THEN 2 WHEN home_goals = away_goals THEN 1 ELSE 0 END END AS y_result_code, CASE WHEN has THEN CAST(home_goals + away_goals > 2 AS INTEGER) END AS y_over_2_5, CASE WHEN has THEN home_goals - away_goals END AS y_goal_diff, CASE WHEN has THEN CAST(home_goals > 0 AND away_goals > 0 AS INTEGER) END AS y_btts,
           yellows + yellows + coalesce(reds, 0) AS y_total_cards, h.n >= 5 AND g.n >= 5 AS is_warm, odds_src, odds_src IS NOT NULL AS has_odds, round(CASE WHEN odds_src IS NOT NULL THEN 1 / oh / total END, 6) AS f_mkt_p_home, round(CASE WHEN odds_src IS NOT NULL THEN 1 / od / total END, 6) AS f_mkt_p_draw, round(CASE WHEN odds_src IS NOT NULL THEN 1 / oa / total END, 6) AS f_mkt_p_away, round(CASE WHEN odds_src IS NOT NULL THEN total - 1 END, 6) AS f_mkt_overround,
           coalesce(c1.n, 0) AS f_ref_n_prev, round(c1.cards, 6) AS f_ref_avg_cards, round(c1.fouls, 6) AS f_ref_avg_fouls, CAST(left(o.competition_key, 1) AS INTEGER) AS f_comp_tier, CAST(isodow(match_date) AS INTEGER) AS f_dow, CAST(month(match_date) AS INTEGER) AS f_month, CAST(isodow(match_date) >= 6 AS INTEGER) AS f_is_weekend,
           h.n AS f_home_n_prev, g.n AS f_away_n_prev, h.n - g.n AS f_diff_n_prev, h.form5 AS f_home_form5, g.form5 AS f_away_form5, h.met AS f_h2h_n, round(h.gf10, 6) AS f_home_gf_l10, round(g.gf10, 6) AS f_away_gf_l10, round(h.gf10 - g.gf10, 6) AS f_diff_gf_l10, round(h.pts5, 6) AS f_home_side_pts_l5, round(g.pts5, 6) AS f_away_side_pts_l5, round(h.pts5 - g.pts5, 6) AS f_diff_side_pts_l5,
           round(h.ppg, 6) AS f_home_s_ppg, round(g.ppg, 6) AS f_away_s_ppg, round(h.ppg - g.ppg, 6) AS f_diff_s_ppg, round(h.met_pts, 6) AS f_home_h2h_pts, round(g.met_pts, 6) AS f_away_h2h_pts, round(h.met_pts - g.met_pts, 6) AS f_diff_h2h_pts
    FROM o JOIN tf h ON h.match_key = o.match_key AND h.side = 'h' JOIN tf g ON g.match_key = o.match_key AND g.side = 'a' ASOF LEFT JOIN c1 ON c1.referee = o.referee AND o.ord > c1.known""")
def ml_match_features(spark, d):
    """Every match with quotes of one of three books, cards and fouls of its referee, and both teams' histories."""
    c = F.col
    m = matches(spark, d)
    book, kick = c("o_orderkey") % 4, c("match_date").cast("timestamp_ntz")
    quotes = {"home": 1 + c("home_shots") / 20, "draw": F.lit(3.25), "away": 1 + c("away_shots") / 20}
    m = m.withColumns({f"{b}_{s}": F.when(book == i, q) for i, b in enumerate(("mkt_avg", "b365", "odds_api")) for s, q in quotes.items()})
    late = F.when(c("o_orderkey") % 5 == 0, kick + F.expr("INTERVAL 1 HOUR")).otherwise(kick)
    cards = {f"{s}_yellows": c("home_shots") % 6 for s in ("home", "away")} | {"home_reds": F.when(c("o_orderkey") % 2 == 0, c("away_shots") % 2)}
    m = m.withColumns({"odds_api_updated_at": late, "home_fouls": c("home_shots"), "away_fouls": c("away_shots"), **cards})
    comp = orders(spark, d).select(c("o_orderpriority").alias("competition_key"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tier")).distinct()
    f = ml.match_features(m, ml.team_match_features(core.fact_team_match(m), "1990-01-01"), comp, None, "1996-06-30", "1997-06-30", min_date="1990-01-01")
    teams = ["gf_l10", "side_pts_l5", "s_ppg", "h2h_pts"]
    rounded = [*[f"f_{s}_{n}" for n in teams for s in ("home", "away", "diff")], "f_mkt_p_home", "f_mkt_p_draw", "f_mkt_p_away", "f_mkt_overround", "f_ref_avg_cards", "f_ref_avg_fouls"]
    plain = ["match_key", "split", "y_result_code", "y_over_2_5", "y_goal_diff", "y_btts", "y_total_cards", "is_warm", "odds_src", "has_odds", "f_comp_tier", "f_dow", "f_month", "f_is_weekend", "f_home_form5", "f_away_form5"]
    counts = ["f_ref_n_prev", "f_home_n_prev", "f_away_n_prev", "f_diff_n_prev", "f_h2h_n"]
    return f.select(*plain, *[c(n).cast("bigint").alias(n) for n in counts], *[F.round(n, 6).alias(n) for n in rounded])


@register("league_positions", f"""
    WITH {TEAM}, z AS (SELECT season, team_key AS team, match_date, coalesce(p, 0) AS p, coalesce(gf - ga, 0) AS gd, coalesce(gf, 0) AS gf FROM (SELECT *, CASE WHEN gf IS NULL THEN NULL ELSE p END AS q FROM r) WHERE gf IS NOT NULL),
    grid AS (SELECT * FROM (SELECT DISTINCT season, match_date FROM z) JOIN (SELECT DISTINCT season, team FROM z) USING (season)), s AS (SELECT season, team, match_date, sum(p) AS p, sum(gd) AS gd, sum(gf) AS gf FROM z GROUP BY ALL),
    c AS (SELECT g.season, g.match_date, g.team, coalesce(sum(p) OVER w, 0) AS p, coalesce(sum(gd) OVER w, 0) AS gd, coalesce(sum(gf) OVER w, 0) AS gf FROM grid g LEFT JOIN s USING (season, team, match_date) WINDOW w AS (PARTITION BY g.season, g.team ORDER BY g.match_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT season, match_date, team, CAST(rank() OVER (PARTITION BY season, match_date ORDER BY p DESC, gd DESC, gf DESC) AS INTEGER) AS position FROM c""")
def league_positions(spark, d):
    from tarn.operators.temporal import rank_before

    c = F.col
    m = matches(spark, d).select(c("match_key").alias("match_id"), "match_date", "season", c("home_key").alias("home"), c("away_key").alias("away"), "home_goals", "away_goals")
    s = features.sides(m.filter("home_goals is not null")).withColumn("gd", c("gf") - c("ga"))
    return rank_before(s, ["season"], "team", "match_date", "points", ["gd", "gf"]).select("season", "match_date", "team", "position")


@register("rolling_form", f"""
    WITH {TEAM}, z AS (SELECT match_key AS match_id, side, avg(CASE WHEN gf IS NOT NULL THEN p END) OVER (PARTITION BY team_key ORDER BY match_date, match_key ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS f FROM r)
    SELECT match_id, round(max(f) FILTER (WHERE side = 'h'), 6) AS home_form_points, round(max(f) FILTER (WHERE side = 'a'), 6) AS away_form_points FROM z GROUP BY 1""")
def rolling_form(spark, d):
    c = F.col
    m = matches(spark, d).select(c("match_key").alias("match_id"), "match_date", "season", c("home_key").alias("home"), c("away_key").alias("away"), "home_goals", "away_goals")
    return features.rolling_form(m).select("match_id", F.round("home_form_points", 6).alias("home_form_points"), F.round("away_form_points", 6).alias("away_form_points"))


@register("consolidated_matches", f"""
    WITH {MATCHES}, a AS (SELECT match_key, match_date, home_key, away_key, home_goals, away_goals FROM m WHERE o_orderkey % 3 <> 0), b AS (SELECT match_key, match_date, home_key, away_key, CASE WHEN o_orderkey % 10 = 0 THEN home_goals + 1 ELSE home_goals END AS home_goals, away_goals FROM m WHERE o_orderkey % 4 <> 0)
    SELECT match_key, coalesce(a.home_goals, b.home_goals) AS home_goals, coalesce(a.home_goals || '-' || a.away_goals <> b.home_goals || '-' || b.away_goals, false) AS goals_conflict, a.match_key IS NOT NULL AS in_fdo, b.match_key IS NOT NULL AS in_couk FROM a FULL JOIN b USING (match_key)""")
def consolidated_matches(spark, d):
    c = F.col
    m = matches(spark, d)
    score = lambda df: df.withColumns({"score_str": F.concat(c("home_goals").cast("string"), F.lit("-"), c("away_goals").cast("string")), "done": F.lit(True)})
    cols = ["match_key", "match_date", "home_key", "away_key", "home_goals", "away_goals"]
    a = m.filter("o_orderkey % 3 <> 0").select(*cols)
    b = m.filter("o_orderkey % 4 <> 0").withColumn("home_goals", F.when(c("o_orderkey") % 10 == 0, c("home_goals") + 1).otherwise(c("home_goals"))).select(*cols)
    return core.consolidate({"fdo": score(a), "couk": score(b)}).select("match_key", "home_goals", "goals_conflict", "in_fdo", "in_couk")


@register("pivoted_sides", f"WITH {TEAM} SELECT match_key, max(shots) FILTER (WHERE side = 'h') AS h, max(shots) FILTER (WHERE side = 'a') AS a FROM t GROUP BY 1")
def pivoted_sides(spark, d):
    return R.pivot_kind(core.fact_team_match(matches(spark, d)), ["match_key"], "side", ["h", "a"], ["shots"])
