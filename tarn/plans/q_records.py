"""Queries of the marts and sources that had none: attention, shots, spikes, big tables, absences, page tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.operators import reshape as R
from tarn.operators import resolve as E
from tarn.operators import text as TX
from tarn.plans import core, features, ml
from tarn.plans.q_core import orders, table
from tarn.plans.q_docs import TEAM_DAYS, _spine, _team_lines
from tarn.plans.q_marts import MATCHES, matches
from tarn.plans.registry import register
from tarn.sources.readers import extract_html_tables

c = F.col


@register("order_page_tables", """
    WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag) AS n FROM lineitem)
    SELECT l_orderkey, 0 AS table_no, CAST(n AS INTEGER) AS row_no, CAST(l_linenumber AS VARCHAR) AS line, l_partkey || ' & co' AS part, l_returnflag AS mode FROM x
    UNION ALL SELECT DISTINCT l_orderkey, 0, 0, 'No', 'Part', 'Mode' FROM lineitem UNION ALL SELECT DISTINCT l_orderkey, 1, 0, 'lines', CAST(count(*) AS VARCHAR), NULL FROM lineitem GROUP BY l_orderkey""")
def order_page_tables(spark, d):
    """Each order as a web page with two tables, one of them without closing tags, read back as cells."""
    row = lambda x: F.concat(F.lit("<tr><td>"), x["l_linenumber"].cast("string"), F.lit("</td><td class='p'>"), x["l_partkey"].cast("string"), F.lit(" &amp; <b>co</b></td><td> "), x["l_returnflag"], F.lit("\n</td></tr>"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("a"))
    body = F.array_join(F.transform("a", row), "")
    page = F.concat(F.lit("<html><p>Order</p><table><thead><tr><th>No</th><th>Part</th><th>Mode</th></tr></thead>"), body, F.lit("</table><table><tr><td>lines<td>"), F.size("a").cast("string"), F.lit("</table></html>"))
    cells = extract_html_tables(lines.select("l_orderkey", page.alias("html")), "l_orderkey", "html", expected=2)
    return cells.select("l_orderkey", "table_no", "row_no", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("line", "part", "mode"))])


@register("team_attention_daily", """
    SELECT p_name AS team_key, CAST(l_shipdate AS DATE) AS view_date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS views_total, CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linenumber % 2 = 0) AS BIGINT) AS views_en, count(DISTINCT l_linenumber % 2) AS n_langs
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def team_attention_daily(spark, d):
    """Page views whose articles are written in four ways; each way must reach the same team."""
    n = c("l_linenumber") % 4
    article = F.when(n == 0, c("p_name")).when(n == 1, F.concat("p_name", F.lit(" FC"))).when(n == 2, F.concat(F.lit("FC "), "p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit(" de ")))
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), c("l_partkey") == c("p_partkey"))
    views = j.select(F.lit("team").alias("entity_type"), article.alias("article"), F.to_date("l_shipdate").alias("view_date"), c("l_quantity").cast("bigint").alias("views"), F.when(c("l_linenumber") % 2 == 0, "en").otherwise("de").alias("lang"))
    return ml.team_attention_daily(views, table(spark, d, "part").select(c("p_name").alias("alias"), c("p_name").alias("team_key")).distinct())


def _attention_side(side: str) -> str:
    return f"""SELECT match_key, avg(views) FILTER (WHERE day >= match_date - 7) AS d7, avg(views) AS d28, count(*) AS n FROM m JOIN v ON team = {side}_key AND day >= match_date - 28 AND day < match_date GROUP BY 1"""


@register("match_attention", f"""
    WITH {TEAM_DAYS}, h AS ({_attention_side("home")}), a AS ({_attention_side("away")}),
    j AS (SELECT m.match_key, h.n AS hn, a.n AS an, CASE WHEN h.n >= 14 THEN h.d7 END AS h7, CASE WHEN h.n >= 14 THEN h.d28 END AS h28, CASE WHEN a.n >= 14 THEN a.d7 END AS a7, CASE WHEN a.n >= 14 THEN a.d28 END AS a28 FROM m LEFT JOIN h USING (match_key) LEFT JOIN a USING (match_key))
    SELECT match_key, round(h7, 6) AS f_home_att_7d, round(h28, 6) AS f_home_att_28d, round(h7 / nullif(h28, 0), 6) AS f_home_att_ratio, round(a7, 6) AS f_away_att_7d, round(a28, 6) AS f_away_att_28d, round(a7 / nullif(a28, 0), 6) AS f_away_att_ratio, round(CASE WHEN h7 > 0 AND a7 > 0 THEN ln(h7 / a7) END, 6) AS f_att_log_ratio_7d
    FROM j WHERE hn >= 14 OR an >= 14""")
def match_attention(spark, d):
    daily = _team_lines(spark, d).groupBy(c("team").alias("team_key"), c("day").alias("view_date")).agg(F.count("*").alias("views_total"))
    f = ml.match_attention(matches(spark, d), daily)
    return f.select("match_key", *[F.round(x, 6).alias(x) for x in f.columns if x.startswith("f_")])


@register("shot_features", """
    WITH s AS (SELECT l_orderkey AS match_id, l_linenumber AS shot_id, CAST(l_quantity AS INTEGER) AS minute, CASE WHEN l_linenumber % 2 = 0 THEN 'h' ELSE 'a' END AS side, l_returnflag = 'R' AS goal, 0.5 + l_discount * 4 AS x, l_tax * 10 AS y, l_returnflag, l_linestatus, l_linenumber % 3 = 0 AS assisted, l_discount AS xg FROM lineitem),
    b AS (SELECT *, coalesce(sum(CAST(goal AND side = 'h' AS INTEGER)) OVER w, 0) AS hb, coalesce(sum(CAST(goal AND side = 'a' AS INTEGER)) OVER w, 0) AS ab FROM s WINDOW w AS (PARTITION BY match_id ORDER BY minute RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT match_id, shot_id, minute AS f_minute, round(sqrt(power((1 - x) * 105, 2) + power((0.5 - y) * 68, 2)), 6) AS f_distance_m, round(atan2(7.32 * (1 - x) * 105.0, power((1 - x) * 105.0, 2) + power((0.5 - y) * 68.0, 2) - 3.66 * 3.66), 6) AS f_angle_rad, CAST(l_returnflag = 'A' AS INTEGER) AS f_is_header, CAST(l_linestatus = 'O' AND shot_id = 1 AS INTEGER) AS f_is_penalty,
           CAST(assisted AS INTEGER) AS f_is_assisted, CAST(CASE WHEN side = 'h' THEN hb - ab ELSE ab - hb END AS BIGINT) AS f_score_diff_before, CAST(goal AS INTEGER) AS y_is_goal, round(xg, 6) AS benchmark_xg, side = 'h' AS is_home FROM b""")
def shot_features(spark, d):
    """Every line is a shot of its order's match; shots of one minute do not see each other."""
    k = c("l_linenumber")
    s = table(spark, d, "lineitem").select(
        c("l_orderkey").alias("match_id"), k.alias("shot_id"), c("l_quantity").cast("int").alias("minute"), F.when(k % 2 == 0, "h").otherwise("a").alias("side"), F.when(c("l_returnflag") == "R", "Goal").otherwise("Saved").alias("result"), (0.5 + c("l_discount") * 4).alias("x_coord"), (c("l_tax") * 10).alias("y_coord"),
        F.when(c("l_returnflag") == "A", "Head").otherwise("Foot").alias("shot_type"), F.when((c("l_linestatus") == "O") & (k == 1), "Penalty").otherwise("Open").alias("situation"), F.when(k % 3 == 0, "x").alias("assisted_by"), c("l_discount").alias("xg"))
    f = ml.shots(s)
    rounded = [F.round(x, 6).alias(x) for x in ("f_distance_m", "f_angle_rad", "benchmark_xg")]
    return f.select("match_id", "shot_id", "f_minute", *rounded, "f_is_header", "f_is_penalty", "f_is_assisted", c("f_score_diff_before").cast("bigint").alias("f_score_diff_before"), "y_is_goal", "is_home")


def _shock_side(side: str) -> str:
    return f"(SELECT match_key, 1 AS x FROM m SEMI JOIN k ON team = {side}_key AND day >= match_date - 7 AND day < match_date)"


@register("media_shock_features", f"""
    WITH {TEAM_DAYS}, b AS (SELECT *, count(views) OVER w AS n, avg(views) OVER w AS mean, stddev_samp(views) OVER w AS sd FROM v WINDOW w AS (PARTITION BY team ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
    k AS (SELECT team, day FROM b WHERE n >= 3 AND (views - mean) / nullif(sd, 0) >= 2.0)
    SELECT m.match_key AS match_id, coalesce(h.x, 0) AS home_media_shock, coalesce(a.x, 0) AS away_media_shock FROM m LEFT JOIN {_shock_side("home")} h USING (match_key) LEFT JOIN {_shock_side("away")} a USING (match_key)""")
def media_shock_features(spark, d):
    return features.media_shock(_spine(spark, d), _team_lines(spark, d).groupBy("team", "day").agg(F.count("*").alias("views")))


@register("match_360", f"""
    WITH {MATCHES}, s AS (SELECT CAST(l_suppkey % 40 AS VARCHAR) AS team, CAST(l_shipdate AS DATE) AS day, max(l_extendedprice) AS strength FROM lineitem GROUP BY ALL),
    o AS (SELECT CAST(o_orderkey AS VARCHAR) AS match_key, o_totalprice AS price, length(o_orderpriority) AS season FROM orders),
    b AS (SELECT home_key, away_key, match_date + CAST(o_orderkey % 3 - 1 AS INTEGER) AS other, o_orderkey FROM m WHERE o_orderkey % 2 = 0),
    n AS (SELECT m.match_key, b.o_orderkey AS other_id, abs(datediff('day', m.match_date, other)) AS gap FROM m JOIN b USING (home_key, away_key) WHERE abs(datediff('day', m.match_date, other)) <= 1 QUALIFY row_number() OVER (PARTITION BY m.match_key ORDER BY abs(datediff('day', m.match_date, other)), other, b.o_orderkey) = 1)
    SELECT m.match_key AS match_id, round(o.price, 2) AS price, o.season AS order_season, round(h.strength, 2) AS home_strength, round(a.strength, 2) AS away_strength, n.other_id AS b_other_id, CAST(n.gap AS INTEGER) AS day_gap
    FROM m LEFT JOIN o USING (match_key) ASOF LEFT JOIN s h ON h.team = home_key AND m.match_date >= h.day ASOF LEFT JOIN s a ON a.team = away_key AND m.match_date >= a.day LEFT JOIN n ON n.match_key = m.match_key""")
def match_360(spark, d):
    """Matches with a feature table, the newest strength of both sides, and the nearest match of a second source."""
    m = _spine(spark, d)
    part = table(spark, d, "orders").select(c("o_orderkey").cast("string").alias("match_id"), c("o_totalprice").alias("price"), F.length("o_orderpriority").cast("bigint").alias("season"))
    snaps = _team_lines(spark, d).groupBy("team", c("day").alias("snapshot_date")).agg(F.max("l_extendedprice").alias("strength"))
    key = c("match_id").cast("bigint")
    second = m.filter(key % 2 == 0).select("home", "away", F.date_add("match_date", (key % 3 - 1).cast("int")).alias("match_date"), key.alias("other_id"))
    second = second.groupBy("home", "away", "match_date").agg(F.min("other_id").alias("other_id"))
    f = features.match_360(m, {"order": part}, snaps, second)
    return f.select("match_id", F.round("price", 2).alias("price"), "order_season", F.round("home_strength", 2).alias("home_strength"), F.round("away_strength", 2).alias("away_strength"), "b_other_id", c("day_gap").cast("int").alias("day_gap"))


@register("player_360", """
    WITH s AS (SELECT l_partkey AS player_key, CAST(year(l_shipdate) AS INTEGER) AS season, count(*) AS games FROM lineitem GROUP BY ALL), x AS (SELECT *, season = max(season) OVER (PARTITION BY player_key) AS is_latest FROM s)
    SELECT player_key, season, games, is_latest, p_name AS name, CASE WHEN is_latest THEN p_brand END AS status_container FROM x LEFT JOIN part ON p_partkey = player_key""")
def player_360(spark, d):
    p = table(spark, d, "part")
    seasons = table(spark, d, "lineitem").groupBy(c("l_partkey").alias("player_key"), F.year("l_shipdate").alias("season")).agg(F.count("*").alias("games"))
    f = features.player_360(p.select(c("p_partkey").alias("player_key"), c("p_name").alias("name")), seasons, p.select(c("p_partkey").alias("player_key"), c("p_brand").alias("container")))
    return f.select("player_key", "season", "games", "is_latest", "name", "status_container")


@register("absence_items", """
    SELECT l_orderkey AS fixture_id, l_suppkey AS team_id, l_partkey AS player_id, l_returnflag AS player, l_linestatus AS kind, l_returnflag || CASE WHEN l_linenumber % 3 = 0 THEN ' Suspended' WHEN l_linenumber % 3 = 1 THEN ' Red Card' ELSE '' END AS reason, l_linenumber % 3 < 2 AS is_suspension FROM lineitem""")
def absence_items(spark, d):
    """Absences as documents of nested objects, one a line."""
    reason = F.concat("l_returnflag", F.when(c("l_linenumber") % 3 == 0, " Suspended").when(c("l_linenumber") % 3 == 1, " Red Card").otherwise(""))
    player = F.struct(c("l_partkey").alias("id"), c("l_returnflag").alias("name"), c("l_linestatus").alias("type"), reason.alias("reason"))
    item = F.to_json(F.struct(F.struct(c("l_orderkey").alias("id")).alias("fixture"), F.struct(c("l_suppkey").alias("id")).alias("team"), player.alias("player")))
    return features.absences(table(spark, d, "lineitem").select(F.parse_json(item).alias("item")))


@register("unified_documents", """
    WITH u AS (SELECT 'd' || doc_id AS doc_id, 'documents' AS source_type, CAST(NULL AS VARCHAR) AS title, text AS body, CAST(NULL AS TIMESTAMP) AS published_at, CAST(n_chars AS DOUBLE) AS engagement, lang AS language FROM documents
               UNION ALL SELECT 'o' || o_custkey, 'orders', '<b>' || o_orderpriority || '</b>', o_orderstatus || ' &amp;  http://x.y/' || o_orderkey || ' end', CAST(o_orderdate AS TIMESTAMP), o_totalprice, NULL FROM orders),
    k AS (SELECT *, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(concat_ws(' ', title, body), 'https?://[^ \\t\\n\\x0B\\f\\r]+|www\\.[^ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS clean FROM u)
    SELECT doc_id, source_type, language, round(engagement, 2) AS engagement, length(body) AS n_body, left(clean, 5000) AS text_clean, md5(coalesce(body, '')) AS body_md5 FROM k""")
def unified_documents(spark, d):
    """Two sources in one schema; the whole body stays beside the capped model input."""
    u = _unified(spark, d)
    return u.select("doc_id", "source_type", "language", F.round("engagement", 2).alias("engagement"), F.length("body").cast("bigint").alias("n_body"), "text_clean", F.md5(F.coalesce("body", F.lit(""))).alias("body_md5"))


def _unified(spark, d):
    docs, o = table(spark, d, "documents"), table(spark, d, "orders")
    words = F.concat("o_orderstatus", F.lit(" &amp;  http://x.y/"), c("o_orderkey").cast("string"), F.lit(" end"))
    return TX.normalise({
        "documents": (docs, {"doc_id": F.concat(F.lit("d"), c("doc_id").cast("string")), "body": c("text"), "engagement": c("n_chars"), "language": c("lang")}),
        "orders": (o, {"doc_id": F.concat(F.lit("o"), c("o_custkey").cast("string")), "title": F.concat(F.lit("<b>"), "o_orderpriority", F.lit("</b>")), "body": words, "published_at": c("o_orderdate"), "engagement": c("o_totalprice")}),
    })


@register("newest_valid_documents", """
    WITH k AS (SELECT 'o' || o_custkey AS doc_id, CAST(o_orderdate AS TIMESTAMP) AS published_at, o_orderpriority || ' ' || o_orderstatus || ' & end' AS text_clean FROM orders)
    SELECT doc_id, published_at, text_clean FROM k QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY published_at DESC, text_clean DESC) = 1""")
def newest_valid_documents(spark, d):
    """Of equal ids the newest; documents without time go."""
    return TX.drop_invalid(_unified(spark, d)).select("doc_id", "published_at", "text_clean")


@register("row_expressions", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS label, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority ELSE o_orderstatus END AS first_known, o_orderstatus AS present, CAST(NULL AS VARCHAR) AS absent,
           CASE WHEN n < 0 THEN 'past' WHEN n = 0 THEN 'today' WHEN n = 1 THEN 'tomorrow' WHEN n <= 7 THEN 'next 7 days' ELSE 'later' END AS bucket, printf('H %.1f%% | D 10.0%% | A %.1f%%', o_orderkey % 10 * 5.0, 90 - o_orderkey % 10 * 5.0) AS summary,
           round(e * (1 - draw), 6) AS p_home, round(draw, 6) AS p_draw, round((1 - e) * (1 - draw), 6) AS p_away, round(abs(atan2(7.32 * dx, dx * dx + dy * dy - 3.66 * 3.66)), 6) AS angle
    FROM (SELECT *, datediff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE)) AS n, 0.28 * exp(-power((o_orderkey % 600 - 300) / 250.0, 2) / 2) AS draw, 1 / (1 + power(10, -(o_orderkey % 600 - 300) / 400.0)) AS e, (1 - (o_orderkey % 50) / 60.0) * 105 AS dx, ((o_orderkey % 31) / 31.0 - 0.5) * 68 AS dy FROM orders)""")
def row_expressions(spark, d):
    k = c("o_orderkey")
    o = R.select_except(table(spark, d, "orders"), "o_totalprice", "no_such_column")
    label = X.blank_to_null(F.when(k % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))))
    p, elo = k % 10 / 20.0, X.elo_outcome((k % 600 - 300).cast("double"))
    return o.select(
        "o_orderkey", label.alias("label"), X.coalesce_priority(label, "o_orderstatus").alias("first_known"), X.first_present(o, ["o_totalprice", "o_orderstatus"]).alias("present"), X.first_present(o, ["o_totalprice"]).alias("absent"),
        X.timeline_bucket(F.to_date("o_orderdate"), F.lit("1998-01-01").cast("date")).alias("bucket"), X.prob_summary(p, F.lit(0.1), 0.9 - p).alias("summary"), *[F.round(e, 6).alias(n) for n, e in zip(("p_home", "p_draw", "p_away"), elo, strict=True)], F.round(X.shot_angle(k % 50 / 60.0, k % 31 / 31.0), 6).alias("angle"))


@register("side_by_side", """
    WITH t AS (SELECT s_nationkey AS n, count(*) AS suppliers, min(s_suppkey) AS low FROM supplier GROUP BY 1)
    SELECT h.n, h.suppliers AS f_home_suppliers, a.suppliers AS f_away_suppliers, h.suppliers - a.suppliers AS f_diff_suppliers, h.low AS f_home_low, a.low AS f_away_low, h.low - a.low AS f_diff_low FROM t h JOIN t a ON a.n = (h.n + 1) % 25""")
def side_by_side(spark, d):
    t = table(spark, d, "supplier").groupBy(c("s_nationkey").alias("n")).agg(F.count("*").alias("f_suppliers"), F.min("s_suppkey").alias("f_low"))
    return t.alias("h").join(t.alias("a"), c("a.n") == (c("h.n") + 1) % 25).select(c("h.n").alias("n"), *X.fan_out(["f_suppliers", "f_low"]))


@register("plausible_matches", """
    SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 1 AND o_orderkey % 11 <> 0 AND o_custkey % 9 <> o_orderkey % 9 AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderkey % 7 <> 0""")
def plausible_matches(spark, d):
    k = c("o_orderkey")
    away = F.when(k % 11 != 0, k % 9)
    m = table(spark, d, "orders").select("o_orderkey", (k % 4).alias("sport_id"), (c("o_custkey") % 9).alias("home_team_id"), away.alias("away_team_id"), F.concat(F.lit(" t"), (c("o_custkey") % 9).cast("string")).alias("home_team"), F.concat(F.lit("t"), away.cast("string"), F.lit(" ")).alias("away_team"), c("o_orderdate").cast("timestamp_ntz").alias("match_time_utc"), F.when(k % 7 == 0, F.upper(F.lit(core.TEST_LEAGUES[0]))).otherwise("bl1").alias("league_shortcut"))
    return core.plausible_matches(m, since="1995-01-01").select("o_orderkey")


@register("best_sightings", """
    WITH s AS (SELECT 'suppliers' AS source, 2 AS prio, CAST(s_suppkey AS VARCHAR) AS id, s_nationkey AS n, CAST(NULL AS INTEGER) AS founded FROM supplier UNION ALL SELECT 'customers', 1, CAST(c_custkey AS VARCHAR), c_nationkey, CAST(1900 + c_custkey % 100 AS INTEGER) FROM customer WHERE c_nationkey % 3 <> 0)
    SELECT 'nation ' || n AS raw_name, source, id AS source_team_id, founded FROM s QUALIFY row_number() OVER (PARTITION BY n ORDER BY prio, id) = 1""")
def best_sightings(spark, d):
    """Occurrences in two sources in one schema; of each name the one of the best source."""
    name = lambda k: F.concat(F.lit("nation "), c(k).cast("string"))
    s = core.sightings(core.SIGHTING, [
        ("suppliers", 2, table(spark, d, "supplier"), {"source_team_id": "s_suppkey", "raw_name": name("s_nationkey")}),
        ("customers", 1, table(spark, d, "customer").filter("c_nationkey % 3 <> 0"), {"source_team_id": "c_custkey", "raw_name": name("c_nationkey"), "founded": 1900 + c("c_custkey") % 100}),
        ("nameless", 0, table(spark, d, "customer"), {"source_team_id": "c_custkey", "raw_name": F.lit(" ")}),
    ], "raw_name")
    return E.best_by(s, ["raw_name"], [c("prio"), c("source_team_id")]).select("raw_name", "source", "source_team_id", "founded")


@register("player_season_features", """
    WITH p AS (SELECT l_partkey AS k, CAST(year(l_shipdate) AS INTEGER) AS s, l_returnflag AS comp, CAST(sum(l_quantity * 30) AS DOUBLE) AS minutes, count(*) AS games, sum(l_tax * 100) AS goals FROM lineitem GROUP BY ALL),
    t AS (SELECT k, s, sum(minutes) AS minutes, sum(games) AS games, CASE WHEN sum(minutes) >= 450 THEN sum(goals) * 90.0 / sum(minutes) END AS g90 FROM p GROUP BY ALL)
    SELECT p.k AS player_key, p.s AS season, p.comp AS competition_key, round(p.minutes, 6) AS y_minutes, round(a.minutes, 6) AS f_prev1_minutes, CAST(a.games AS BIGINT) AS f_prev1_games, round(a.g90, 6) AS f_prev1_goals_p90, round(b.minutes, 6) AS f_prev2_minutes, round(b.g90, 6) AS f_prev2_goals_p90, CAST(a.k IS NOT NULL AS INTEGER) AS f_has_prev1,
           CASE p.comp WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS f_comp_tier, p_size + 150 AS f_height_cm, p.s < 1998 AS season_complete, p.s < 1998 AND p.minutes >= 900 AS is_reliable_target
    FROM p LEFT JOIN t a ON a.k = p.k AND a.s = p.s - 1 LEFT JOIN t b ON b.k = p.k AND b.s = p.s - 2 LEFT JOIN part ON p_partkey = p.k""")
def player_season_features(spark, d):
    """Parts as players: a season's lines of one return flag are its matches in one competition."""
    zero = F.lit(0.0)
    p = table(spark, d, "lineitem").groupBy(c("l_partkey").alias("player_key"), F.year("l_shipdate").alias("season"), c("l_returnflag").alias("competition_key")).agg(F.sum(c("l_quantity") * 30).alias("minutes_played"), F.count("*").alias("games"), F.sum(c("l_tax") * 100).alias("goals"))
    p = p.withColumns(dict.fromkeys(("assists", "xg", "xa", "shots", "key_passes"), zero))
    players = table(spark, d, "part").select(c("p_partkey").alias("player_key"), F.lit("1975-05-05").cast("date").alias("date_of_birth"), F.lit("x").alias("nationality"), (c("p_size") + 150).alias("height_cm"))
    comp = table(spark, d, "lineitem").select(c("l_returnflag").alias("competition_key")).distinct().withColumn("tier", X.lookup("competition_key", {"A": 1, "N": 2}, "int"))
    f = ml.player_season_features(p, players, comp, F.lit("1998-08-01").cast("date"))
    rounded = [F.round(x, 6).alias(x) for x in ("y_minutes", "f_prev1_minutes", "f_prev1_goals_p90", "f_prev2_minutes", "f_prev2_goals_p90")]
    return f.select("player_key", "season", "competition_key", *rounded, "f_prev1_games", "f_has_prev1", "f_comp_tier", "f_height_cm", "season_complete", "is_reliable_target")


@register("scoring_batch", f"""
    WITH {MATCHES} SELECT match_key, match_date, season, home_key, away_key, true AS is_missing_kickoff, CAST(match_date AS TIMESTAMP) AS ord_ts, CAST(match_date AS TIMESTAMP) + INTERVAL '23 hours 59 minutes 59 seconds' AS known_ts, CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals = away_goals THEN 'D' ELSE 'A' END AS y_result
    FROM m WHERE is_finished AND home_goals IS NOT NULL AND away_goals IS NOT NULL AND match_date > DATE '1996-06-30' AND match_date <= DATE '1997-06-30' AND match_date >= DATE '1996-09-01' ORDER BY match_date, match_key LIMIT 500""")
def scoring_batch(spark, d):
    """The first 500 matches of the validation year that are to be scored, with what the audit asks for."""
    m = matches(spark, d)
    comp = orders(spark, d).select(c("o_orderpriority").alias("competition_key"), F.lit(1).alias("tier")).distinct()
    f = ml.match_features(m, ml.team_match_features(core.fact_team_match(m), "1990-01-01"), comp, None, "1996-06-30", "1997-06-30", min_date="1990-01-01")
    batch = features.select_for_scoring(ml.temporal_audit(f), "valid", since="1996-09-01", limit=500)
    return batch.select("match_key", "match_date", "season", "home_key", "away_key", "is_missing_kickoff", "ord_ts", "known_ts", "y_result")


@register("match_weather", f"""
    WITH {MATCHES}, k AS (SELECT match_key, home_key, match_date, o_orderkey % 24 AS hour FROM m), w AS (SELECT DISTINCT CAST(l_suppkey % 40 AS VARCHAR) AS team, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_suppkey % 40 < 30)
    SELECT match_key, w.team IS NOT NULL AS has_weather, CASE WHEN w.team IS NOT NULL THEN CAST(w.team AS DOUBLE) + hour END AS weather_temp_c FROM k LEFT JOIN w ON w.team = home_key AND w.day = match_date AND hour IN (14, 15)""")
def match_weather(spark, d):
    """Hourly weather at the home ground for two hours of a day; kick-off minutes are cut to the hour."""
    hour = c("o_orderkey") % 24
    m = matches(spark, d).withColumn("kickoff_utc", F.timestamp_seconds(F.unix_date("match_date").cast("bigint") * 86400 + hour * 3600 + 1740).cast("timestamp_ntz"))
    team = (c("l_suppkey") % 40).cast("string")
    lines = table(spark, d, "lineitem")
    teams = lines.select(team.alias("team_key"), F.concat(F.lit("v"), team).alias("openmeteo_venue_key")).distinct()
    days = lines.filter("l_suppkey % 40 < 30").select(team.alias("t"), F.to_date("l_shipdate").alias("day")).distinct().withColumn("h", F.explode(F.array(F.lit(14), F.lit(15))))
    none = F.lit(0.0)
    weather = days.select(F.concat(F.lit("v"), "t").alias("venue_name"), F.lit("UTC").alias("timezone"), F.timestamp_seconds(F.unix_date("day").cast("bigint") * 86400 + c("h") * 3600).cast("timestamp_ntz").alias("weather_time"), (c("t").cast("double") + c("h")).alias("temperature_c"), none.alias("precipitation_mm"), none.alias("windspeed_kmh"), none.alias("humidity_pct"), F.lit(0).alias("weather_code"))
    return core.with_weather(m, teams, weather).select("match_key", "has_weather", "weather_temp_c")


@register("prediction_summaries", f"""
    WITH {MATCHES} SELECT match_key, 'team ' || home_key AS home_name, 'team ' || away_key AS away_name, printf('H %.1f%% | D 20.0%% | A %.1f%%', o_orderkey % 9 * 5.0, 80 - o_orderkey % 9 * 5.0) AS summary,
           CASE WHEN n < 0 THEN 'past' WHEN n = 0 THEN 'today' WHEN n = 1 THEN 'tomorrow' WHEN n <= 7 THEN 'next 7 days' ELSE 'later' END AS timeline, CAST(o_orderkey % 9 * 5 AS DOUBLE) AS probability_pct FROM (SELECT *, datediff('day', DATE '1998-01-01', match_date) AS n FROM m)""")
def prediction_summaries(spark, d):
    m = matches(spark, d)
    p = c("o_orderkey") % 9 / 20.0
    pred = m.select("match_key", "match_date", "home_key", "away_key", "is_finished", p.alias("p_home"), F.lit(0.2).alias("p_draw"), (0.8 - p).alias("p_away"), p.alias("confidence"), F.lit("m").alias("model_version"), c("result").alias("actual_result"), F.lit(True).alias("is_correct"))
    teams = m.select(c("home_key").alias("team_key")).union(m.select("away_key")).distinct().withColumn("team_name", F.concat(F.lit("team "), "team_key"))
    views = features.prediction_views(pred, m.select("match_key"), teams, m.select("match_key"), F.lit("1998-01-01").cast("date"))
    return views["predictions"].select("match_key", "home_name", "away_name", "summary", "timeline", "probability_pct")
