"""Queries of document shaping, expressions and feature tables, over documents and rows derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.functions import json as J
from tarn.operators import aggregates as A
from tarn.operators import reshape as R
from tarn.operators import resolve as E
from tarn.operators import text as TX
from tarn.plans import bi, features
from tarn.plans.q_core import DAYS, orders, table
from tarn.plans.q_marts import MATCHES, matches
from tarn.plans.registry import register
from tarn.streaming import cdc

c = F.col


def _doc(df: DataFrame, keys: list[str], **fields) -> DataFrame:
    """(keys, doc): one JSON document per row, as a variant."""
    return df.select(*keys, F.parse_json(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))).alias("doc"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct(c("l_linenumber").alias("n"), c("l_quantity").alias("q"), c("l_returnflag").alias("f"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))


@register("json_array", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS n, l_quantity AS q, l_returnflag AS f FROM lineitem")
def json_array(spark: SparkSession, d: str) -> DataFrame:
    doc = _doc(_lines(spark, d), ["l_orderkey"], response=c("items"))
    i = J.explode_array(doc, "doc", "$.response")
    return i.select("l_orderkey", J.jget("item", "$.n", "bigint").alias("n"), J.jget("item", "$.q", "double").alias("q"), J.jget("item", "$.f").alias("f"))


@register("json_nested_path", "SELECT o_custkey, CAST(o_orderkey AS BIGINT) AS id, CAST(l_linenumber AS BIGINT) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def json_nested_path(spark, d):
    o = table(spark, d, "orders").join(_lines(spark, d), c("l_orderkey") == c("o_orderkey"))
    docs = _doc(o.groupBy("o_custkey").agg(F.collect_list(F.struct(c("o_orderkey").alias("id"), "items")).alias("all")), ["o_custkey"], orders=c("all"))
    p = J.explode_path(docs, "doc", ["$.orders", "$.items"], ["ord", "line"])
    return p.select("o_custkey", J.jget("ord", "$.id", "bigint").alias("id"), J.jget("line", "$.n", "bigint").alias("n"))


@register("json_parallel_arrays", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS n, CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_quantity DESC, l_returnflag DESC) > 1 THEN l_quantity END AS q FROM lineitem""")
def json_parallel_arrays(spark, d):
    short = F.slice(F.transform("items", lambda x: x["q"]), 1, F.size("items") - 1)
    docs = _doc(_lines(spark, d), ["l_orderkey"], n=F.transform("items", lambda x: x["n"]), q=short)
    return J.explode_parallel(docs, "doc", {"n": ("$.n", "bigint"), "q": ("$.q", "double")})


@register("json_named_positions", """
    SELECT s_suppkey, CAST(0 AS INTEGER) AS pos, 'balance' AS table_name, s_acctbal AS v FROM supplier UNION ALL SELECT s_suppkey, 1, 'nation', s_nationkey FROM supplier UNION ALL SELECT s_suppkey, 2, NULL, 7 FROM supplier""")
def json_named_positions(spark, d):
    item = lambda x: F.struct(x.cast("double").alias("v"))
    docs = _doc(table(spark, d, "supplier"), ["s_suppkey"], all=F.array(item(c("s_acctbal")), item(c("s_nationkey")), item(F.lit(7))))
    return J.explode_named(docs, "doc", "$.all", ["balance", "nation"]).select("s_suppkey", "pos", "table_name", J.jget("item", "$.v", "double").alias("v"))


@register("json_sides", "SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN 'h' ELSE 'a' END AS side, CAST(l_linenumber AS BIGINT) AS n FROM lineitem")
def json_sides(spark, d):
    even = F.filter("items", lambda x: x["n"] % 2 == 0)
    docs = _doc(_lines(spark, d), ["l_orderkey"], h=even, a=F.filter("items", lambda x: x["n"] % 2 != 0))
    return J.explode_sides(docs, "doc", {"h": "$.h", "a": "$.a"}).select("l_orderkey", "side", J.jget("item", "$.n", "bigint").alias("n"))


@register("json_wrapped_or_bare", "SELECT s_suppkey, s_name AS name FROM supplier")
def json_wrapped_or_bare(spark, d):
    s = table(spark, d, "supplier").withColumn("one", F.struct(c("s_name").alias("name")))
    wrapped = _doc(s.filter("s_suppkey % 2 = 0"), ["s_suppkey"], data=F.array("one"))
    return J.array_or_self(wrapped.union(_doc(s.filter("s_suppkey % 2 <> 0"), ["s_suppkey"], name=c("s_name"))), "doc", "$.data").select("s_suppkey", J.jget("item", "$.name").alias("name"))


@register("rdf_bindings", """
    SELECT n_nationkey, 'http://e.org/entity/Q' || s_suppkey AS item, 'Q' || s_suppkey AS item_qid, CAST(s_suppkey % 180 AS DOUBLE) AS lon, CAST(s_suppkey % 90 AS DOUBLE) + 0.5 AS lat, DATE '2026-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS day
    FROM nation JOIN supplier ON s_nationkey = n_nationkey""")
def rdf_bindings(spark, d):
    k = c("s_suppkey")
    val = lambda x: F.struct(x.alias("value"))
    at = F.concat(F.lit("Point("), (k % 180).cast("string"), F.lit(" "), (k % 90).cast("string"), F.lit(".5)"))
    day = F.concat(F.date_add(F.lit("2026-01-01").cast("date"), (k % 28).cast("int")).cast("string"), F.lit("T00:00:00Z"))
    b = F.struct(val(F.concat(F.lit("http://e.org/entity/Q"), k.cast("string"))).alias("item"), val(at).alias("at"), val(day).alias("day"))
    docs = _doc(table(spark, d, "supplier").groupBy(c("s_nationkey").alias("n_nationkey")).agg(F.collect_list(b).alias("bindings")), ["n_nationkey"], results=F.struct("bindings"))
    flat = J.flatten_bindings(docs, "doc", ["item", "at", "day"])
    rows = J.explode_array(docs, "doc", "$.results.bindings", "item")
    more = rows.select(J.rdf_value("item", "item").alias("item"), J.rdf_point("item", "at", "lon").alias("lon"), J.rdf_point("item", "at", "lat").alias("lat"), J.rdf_date("item", "day").alias("day"))
    return flat.select("n_nationkey", "item", "item_qid").join(more, "item")


@register("json_times_and_paths", f"""
    SELECT o_orderkey, o_orderdate AS iso, o_orderdate AS cdc_text, o_orderdate AS cdc_micros, 'eu' AS region, {DAYS} AS ingest_day FROM orders""")
def json_times_and_paths(spark, d):
    o = table(spark, d, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    docs = _doc(o.withColumn("path", F.concat(F.lit("s3://b/region=eu/ingest_date="), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH"), F.lit("/x.json"))), ["o_orderkey", "path"], a=text, b=text, e=F.unix_micros(c("o_orderdate").cast("timestamp")))
    return docs.select("o_orderkey", J.jts("doc", "$.a").alias("iso"), J.cdc_ts("doc", "$.b").alias("cdc_text"), J.cdc_ts("doc", "$.e").alias("cdc_micros"), J.path_part("region").alias("region"), J.path_date().alias("ingest_day"))


@register("cdc_parsed", """
    SELECT event_id AS "offset", CASE event_id % 4 WHEN 3 THEN 'bad' WHEN 2 THEN 'tombstone' ELSE 'ok' END AS status, CASE WHEN event_id % 4 < 2 THEN 'u' END AS op, CASE WHEN event_id % 4 < 2 THEN event_id * 10 END AS lsn,
           CASE WHEN event_id % 4 < 2 THEN user_id END AS user_id, 'events' AS "table" FROM events""")
def cdc_parsed(spark, d):
    e = table(spark, d, "events")
    body = F.struct(F.lit("u").alias("op"), F.struct("user_id", "value").alias("after"), F.struct((c("event_id") * 10).alias("lsn")).alias("source"))
    value = F.when(c("event_id") % 4 == 0, F.to_json(F.struct(body.alias("payload")))).when(c("event_id") % 4 == 1, F.to_json(body)).when(c("event_id") % 4 == 3, F.lit("{broken"))
    m = e.select(F.lit("db.public.events").alias("topic"), F.lit(0).alias("partition"), c("event_id").alias("offset"), value.alias("value"))
    return cdc.parse_events(m).select("offset", "status", "op", "lsn", F.try_variant_get(F.try_parse_json("after"), "$.user_id", "bigint").alias("user_id"), "table")


@register("dates_from_text", f"""
    SELECT o_orderkey, {DAYS} AS day_first, {DAYS} AS short_day, {DAYS} AS compact, date_trunc('second', o_orderdate) AS rfc, round(datediff('day', DATE '1990-05-01', {DAYS}) / 365.25, 6) AS age,
           CAST(last_day({DAYS} + INTERVAL 2 MONTH) AS DATE) AS month_end, o_orderdate - INTERVAL 9 HOUR AS utc FROM orders""")
def dates_from_text(spark, d):
    o = orders(spark, d)
    f = lambda p: F.date_format("o_orderdate", p)
    return o.select(
        "o_orderkey", X.parse_day_first(f("dd/MM/yyyy")).alias("day_first"), X.parse_day_first(f("dd/MM/yyyy")).alias("short_day"), X.parse_compact(F.concat(f("yyyyMMdd"), F.lit("00"))).alias("compact"), X.parse_rfc822(F.concat(f("EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))).alias("rfc"),
        F.round(X.age_years(F.lit("1990-05-01").cast("date"), "day"), 6).alias("age"), X.month_end("day", 2).alias("month_end"), X.local_to_utc("o_orderdate", "Asia/Tokyo").alias("utc"),
    )


@register("numbers_and_rates", """
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS number, CASE WHEN p_size > 10 THEN round(3 * 90.0 / p_size, 3) END AS per_90, round(p_size / nullif(p_partkey % 3, 0), 6) AS rate, round((3.0 + 1) / (3 * 3), 6) AS form,
           round(sqrt(power((1 - p_size / 60.0) * 105, 2) + power((0.4 - 0.5) * 68, 2)), 6) AS metres, round(1 / (1 + power(10.0, -p_size / 400.0)), 6) AS expected, round(exp(p_size / 10.0) / (exp(p_size / 10.0) + 1), 6) AS soft,
           CASE WHEN p_size = 1 THEN 'one' WHEN p_size = 2 THEN 'two' END AS looked_up FROM part""")
def numbers_and_rates(spark, d):
    size = c("p_size").cast("double")
    r = lambda x, n: F.round(x, 6).alias(n)
    return table(spark, d, "part").select(
        "p_partkey", X.to_number(F.concat(c("p_size").cast("string"), F.lit(" cm"))).alias("number"), X.per_90(F.lit(3), F.when(c("p_size") > 10, c("p_size"))).alias("per_90"), r(X.ratio("p_size", c("p_partkey") % 3), "rate"), r(X.form_points_rate(F.when(c("p_size") > 0, F.lit("WDL"))), "form"),
        r(X.pitch_distance(size / 60.0, F.lit(0.4)), "metres"), r(X.elo_expected(size), "expected"), r(X.softmax(size / 10.0, F.lit(0.0))[0], "soft"), X.lookup("p_size", {1: "one", 2: "two"}).alias("looked_up"),
    )


@register("row_guards_and_pairs", f"""
    WITH {MATCHES} SELECT match_key, CASE WHEN is_finished THEN home_shots END AS home_shots, home_shots_target + away_shots_target AS total_shots_target, home_shots_target - away_shots_target AS diff_shots_target, home_shots_target IS NOT NULL AND away_shots_target IS NOT NULL AS has_shots_target_pair,
           CASE WHEN home_shots_target IS NOT NULL THEN true END AS valid_shots_target_pair, lpad(CAST(season % 100 AS VARCHAR), 2, '0') || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS code, season || '/' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS label FROM m""")
def row_guards_and_pairs(spark, d):
    m = matches(spark, d)
    return m.select("match_key", *X.guard("is_finished", ["home_shots"]), *X.pair_metrics(["shots_target"]), X.season_code("season").alias("code"), X.season_label("season").alias("label"))


@register("event_words", """
    SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN 'positive' WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS label, CASE WHEN event_type IN ('click', 'purchase', 'error') THEN 0.95 ELSE 0.5 END AS confidence,
           CASE WHEN event_type = 'error' THEN 'fault' ELSE 'other' END AS scope, 'a ' || event_type || ' & b' AS cleaned, CAST(4 AS BIGINT) AS n_words FROM events""")
def event_words(spark, d):
    raw = F.concat(F.lit("<b>a</b>  "), c("event_type"), F.lit(" &amp; b http://x.org/y"))
    e = table(spark, d, "events").withColumn("cleaned", X.clean_text(raw))
    label, sure = X.lexicon_sentiment("cleaned", ["click", "purchase"], ["error"])
    return e.select("event_id", label.alias("label"), sure.alias("confidence"), X.scope_of("cleaned", ["error"], "fault").alias("scope"), "cleaned", X.word_count("cleaned").cast("bigint").alias("n_words"))


@register("variant_lookup", "SELECT c_custkey, CAST(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey ELSE c_nationkey + 100 END AS INTEGER) AS hit FROM customer WHERE c_custkey % 3 < 2")
def variant_lookup(spark, d):
    cu = table(spark, d, "customer").withColumn("name", F.when(c("c_custkey") % 3 == 0, F.concat(F.lit("n"), c("c_nationkey"))).when(c("c_custkey") % 3 == 1, F.concat(F.lit("club n"), c("c_nationkey"))).otherwise("nowhere"))
    v = E.name_variants(cu, "name", [F.regexp_replace("name", "^club ", "old ")], ["c_custkey"])
    n = table(spark, d, "nation")
    known = n.select(F.concat(F.lit("n"), c("n_nationkey")).alias("k"), c("n_nationkey").alias("v")).union(n.select(F.concat(F.lit("old n"), c("n_nationkey")), c("n_nationkey") + 100))
    return E.first_variant_hit(v, ["c_custkey"], known, "k", "v").withColumnRenamed("v", "hit")


@register("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, d):
    return R.union_distinct(table(spark, d, "customer").select(c("c_nationkey").alias("nation")), table(spark, d, "supplier").select(c("s_nationkey").alias("nation")))


@register("afternoon_means", "SELECT event_type, CAST(ts AS DATE) AS day, round(avg(value), 6) AS mean_value, count(value) AS n FROM events WHERE hour(ts) BETWEEN 14 AND 17 GROUP BY ALL")
def afternoon_means(spark, d):
    return A.hours_mean(table(spark, d, "events"), ["event_type"], "ts", "value").withColumn("mean_value", F.round("mean_value", 6))


@register("mentions_by_day", """
    SELECT CASE WHEN event_type = 'error' THEN 'fault' ELSE 'use' END AS entity, CAST(ts AS DATE) AS day, count(DISTINCT event_id) AS n_docs, count(*) AS n_mentions FROM events WHERE event_type IN ('error', 'click', 'view') GROUP BY ALL""")
def mentions_by_day(spark, d):
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), F.concat(F.lit("an "), c("event_type"), F.lit(" came.")).alias("text"))
    words = spark.createDataFrame([("error", "fault"), ("click", "use"), ("view", "use")], "alias string, entity string")
    return TX.mentions_by_day(e, words, "text", "event_id", "day")


@register("market_by_season", f"""
    WITH {MATCHES}, q AS (SELECT season, CASE WHEN is_finished AND home_goals IS NOT NULL THEN CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals = away_goals THEN 'D' ELSE 'A' END END AS result, 1.5 + home_shots / 20.0 AS h, 3.0 AS d, 1.5 + away_shots / 20.0 AS a FROM m)
    SELECT season, count(result) AS n_matches, round(avg(1 / h + 1 / d + 1 / a - 1), 6) AS mean_margin, round(count(*) FILTER (WHERE result = 'H') / nullif(count(result), 0), 6) AS rate_h, round(count(*) FILTER (WHERE result = 'D') / nullif(count(result), 0), 6) AS rate_d, round(count(*) FILTER (WHERE result = 'A') / nullif(count(result), 0), 6) AS rate_a FROM q GROUP BY 1""")
def market_by_season(spark, d):
    m = matches(spark, d).withColumns({"h": 1.5 + c("home_shots") / 20.0, "d": F.lit(3.0), "a": 1.5 + c("away_shots") / 20.0})
    s = A.market_by_season(m, ["season"], ["h", "d", "a"], "result")
    return s.withColumns({x: F.round(x, 6) for x in ("mean_margin", "rate_h", "rate_d", "rate_a")})


@register("bi_player_season", """
    WITH s AS (SELECT l_partkey, year(l_shipdate) AS season, CAST(sum(l_quantity) AS BIGINT) AS goals, count(*) AS assists, CAST(sum(l_linenumber) AS BIGINT) AS shots FROM lineitem GROUP BY ALL)
    SELECT CAST(l_partkey AS VARCHAR) AS player_key, CAST(season AS INTEGER) AS season, CASE WHEN l_partkey % 2 = 0 THEN p_name ELSE CAST(l_partkey AS VARCHAR) END AS player_name, goals + assists AS goal_contributions, CASE WHEN shots > 0 THEN round(goals * 1.0 / shots, 3) END AS shot_conversion_rate
    FROM s JOIN part ON p_partkey = l_partkey""")
def bi_player_season(spark, d):
    li = table(spark, d, "lineitem")
    stats = li.groupBy(c("l_partkey").cast("string").alias("player_key"), F.year("l_shipdate").alias("season")).agg(F.sum("l_quantity").cast("bigint").alias("goals"), F.count("*").alias("assists"), F.sum("l_linenumber").alias("shots"), F.sum("l_tax").alias("xg"), F.sum("l_discount").alias("xa"))
    none = F.lit(None).cast("string")
    players = table(spark, d, "part").filter("p_partkey % 2 = 0").select(c("p_partkey").cast("string").alias("player_key"), c("p_name").alias("player_name"), none.alias("nationality"), none.cast("date").alias("date_of_birth"), none.alias("photo_url"))
    return bi.player_season(stats, players).select("player_key", "season", "player_name", "goal_contributions", "shot_conversion_rate")


@register("corr_tripwire_hits", """
    WITH r AS (SELECT corr(l_quantity * l_discount, l_quantity) AS a, corr(l_tax, l_quantity) AS b, corr(-l_quantity, l_quantity) AS c, count(*) AS n FROM lineitem)
    SELECT feature, round(r, 6) AS r, n FROM (SELECT 'weighted' AS feature, a AS r, n FROM r UNION ALL SELECT 'l_tax', b, n FROM r UNION ALL SELECT 'negative', c, n FROM r) WHERE n >= 500 AND abs(r) > 0.3""")
def corr_tripwire_hits(spark, d):
    li = table(spark, d, "lineitem").withColumns({"weighted": c("l_quantity") * c("l_discount"), "negative": -c("l_quantity")})
    return A.corr_tripwire(li, ["weighted", "l_tax", "negative"], "l_quantity", 0.3).withColumn("r", F.round("r", 6))


@register("pivot_named_stats", """
    SELECT user_id, max(round(value, 4)) FILTER (WHERE event_type = 'click') AS click, max(round(value, 4)) FILTER (WHERE event_type = 'error') AS error FROM events GROUP BY 1""")
def pivot_named_stats(spark, d):
    best = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max(F.round("value", 4)).alias("v"))
    return R.pivot_stats(best, ["user_id"], "event_type", "v", ["click", "error"])


def _spine(spark: SparkSession, d: str) -> DataFrame:
    return matches(spark, d).select(c("match_key").alias("match_id"), "match_date", "season", c("home_key").alias("home"), c("away_key").alias("away"), "home_goals", "away_goals")


TEAM_DAYS = f"{MATCHES}, v AS (SELECT CAST(l_suppkey % 40 AS VARCHAR) AS team, CAST(l_shipdate AS DATE) AS day, count(*) AS views FROM lineitem GROUP BY ALL)"


def _team_lines(spark, d):
    return table(spark, d, "lineitem").withColumns({"team": (c("l_suppkey") % 40).cast("string"), "day": F.to_date("l_shipdate")})


@register("attention_features", f"""
    WITH {TEAM_DAYS}, s AS (SELECT match_key, 'h' AS side, avg(views) AS mv, count(*) AS n FROM m JOIN v ON team = home_key AND day >= match_date - 7 AND day < match_date GROUP BY ALL UNION ALL SELECT match_key, 'a', avg(views), count(*) FROM m JOIN v ON team = away_key AND day >= match_date - 7 AND day < match_date GROUP BY ALL)
    SELECT m.match_key AS match_id, round(h.mv, 6) AS home_views, h.n AS home_view_days, round(a.mv, 6) AS away_views, a.n AS away_view_days, round(h.mv / nullif(a.mv, 0), 6) AS views_ratio FROM m LEFT JOIN s h ON h.match_key = m.match_key AND h.side = 'h' LEFT JOIN s a ON a.match_key = m.match_key AND a.side = 'a'""")
def attention_features(spark, d):
    daily = _team_lines(spark, d).groupBy("team", "day").agg(F.count("*").alias("views"))
    return features.attention(_spine(spark, d), daily).withColumns({x: F.round(x, 6) for x in ("home_views", "away_views", "views_ratio")})


@register("injury_features", f"""
    WITH {MATCHES}, i AS (SELECT DISTINCT CAST(l_suppkey % 40 AS VARCHAR) AS team, l_partkey AS player, CAST(l_shipdate AS DATE) AS day, l_discount AS xg FROM lineitem WHERE l_returnflag = 'R'),
    s AS (SELECT match_key, 'h' AS side, count(DISTINCT player) AS n, sum(xg) AS x FROM m JOIN i ON team = home_key AND day >= match_date - 14 AND day < match_date GROUP BY ALL UNION ALL SELECT match_key, 'a', count(DISTINCT player), sum(xg) FROM m JOIN i ON team = away_key AND day >= match_date - 14 AND day < match_date GROUP BY ALL)
    SELECT m.match_key AS match_id, coalesce(h.n, 0) AS home_injured, round(coalesce(h.x, 0), 6) AS home_missing_xg, coalesce(a.n, 0) AS away_injured, round(coalesce(a.x, 0), 6) AS away_missing_xg FROM m LEFT JOIN s h ON h.match_key = m.match_key AND h.side = 'h' LEFT JOIN s a ON a.match_key = m.match_key AND a.side = 'a'""")
def injury_features(spark, d):
    i = _team_lines(spark, d).filter("l_returnflag = 'R'").select("team", c("l_partkey").alias("player"), "day", c("l_discount").alias("xg"))
    f = features.injury_load(_spine(spark, d), i)
    return f.withColumns({x: F.round(F.coalesce(x, F.lit(0.0)), 6) for x in ("home_missing_xg", "away_missing_xg")})


@register("comment_features", f"""
    WITH {MATCHES}, k AS (SELECT CAST(l_suppkey % 40 AS VARCHAR) AS team, CAST(l_shipdate AS DATE) AS day, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN -1 ELSE 0 END AS s FROM lineitem),
    s AS (SELECT match_key, 'h' AS side, avg(s) AS x, count(*) AS n FROM m JOIN k ON team = home_key AND day >= match_date - 7 AND day < match_date GROUP BY ALL UNION ALL SELECT match_key, 'a', avg(s), count(*) FROM m JOIN k ON team = away_key AND day >= match_date - 7 AND day < match_date GROUP BY ALL)
    SELECT m.match_key AS match_id, round(h.x, 6) AS home_sentiment, h.n AS home_comments, round(a.x, 6) AS away_sentiment, a.n AS away_comments FROM m LEFT JOIN s h ON h.match_key = m.match_key AND h.side = 'h' LEFT JOIN s a ON a.match_key = m.match_key AND a.side = 'a'""")
def comment_features(spark, d):
    k = _team_lines(spark, d).withColumn("text", F.when(c("l_returnflag") == "A", "a good win").when(c("l_returnflag") == "R", "a bad day").otherwise("a game"))
    f = features.comment_sentiment(_spine(spark, d), k.select("team", "day", "text"), ["good", "win"], ["bad"])
    return f.withColumns({x: F.round(x, 6) for x in ("home_sentiment", "away_sentiment")})


@register("travel_and_context", f"""
    WITH {MATCHES}, v AS (SELECT DISTINCT CAST(s_suppkey % 40 AS VARCHAR) AS team, (s_suppkey % 40) * 1.5 AS lat, (s_suppkey % 40) * 2.25 AS lon FROM supplier)
    SELECT m.match_key AS match_id, 0.0::DOUBLE AS home_travel_km, round(2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(a.lat - h.lat) / 2), 2) + cos(radians(h.lat)) * cos(radians(a.lat)) * power(sin(radians(a.lon - h.lon) / 2), 2)))), 4) AS away_travel_km,
           CAST(m.o_orderkey % 24 AS INTEGER) AS kickoff_hour, CAST(dayofweek(match_date) AS INTEGER) AS dow, isodow(match_date) >= 6 AS is_weekend, CASE WHEN m.o_orderkey % 2 = 0 THEN m.o_orderkey % 5 > 0 END AS is_rain
    FROM m LEFT JOIN v h ON h.team = home_key LEFT JOIN v a ON a.team = away_key""")
def travel_and_context(spark, d):
    k = c("s_suppkey") % 40
    venues = table(spark, d, "supplier").select(k.cast("string").alias("team"), (k * 1.5).alias("lat"), (k * 2.25).alias("lon"))
    m = _spine(spark, d)
    timed = matches(spark, d).select(c("match_key").alias("match_id"), "match_date", F.timestamp_seconds(F.unix_date("match_date").cast("bigint") * 86400 + (c("o_orderkey") % 24) * 3600).alias("kickoff"), "o_orderkey")
    weather = timed.filter("o_orderkey % 2 = 0").select("match_id", F.lit(9.0).alias("temperature_c"), (c("o_orderkey") % 5).cast("double").alias("precipitation_mm"))
    ctx = features.match_context(timed, weather).select("match_id", "kickoff_hour", "dow", "is_weekend", "is_rain")
    return features.travel_distance(m, venues).withColumn("away_travel_km", F.round("away_travel_km", 4)).join(ctx, "match_id")


@register("lineup_features", f"""
    WITH {MATCHES}, p AS (SELECT match_key, CASE WHEN l_linenumber % 2 = 0 THEN 'h' ELSE 'a' END AS side, p_size + 150.0 AS height, p_size + 50.0 AS weight, datediff('day', DATE '1970-01-01' + CAST(p_size * 100 AS INTEGER), match_date) / 365.25 AS age FROM m JOIN lineitem ON CAST(l_orderkey AS VARCHAR) = match_key JOIN part ON p_partkey = l_partkey)
    SELECT m.match_key AS match_id, round(avg(height) FILTER (WHERE side = 'h'), 6) AS home_avg_height, round(avg(height) FILTER (WHERE side = 'a'), 6) AS away_avg_height, round(avg(weight) FILTER (WHERE side = 'h'), 6) AS home_avg_weight, round(avg(weight) FILTER (WHERE side = 'a'), 6) AS away_avg_weight, round(avg(age) FILTER (WHERE side = 'h'), 6) AS home_avg_age, round(avg(age) FILTER (WHERE side = 'a'), 6) AS away_avg_age
    FROM m LEFT JOIN p USING (match_key) GROUP BY 1""")
def lineup_features(spark, d):
    lineups = table(spark, d, "lineitem").select(c("l_orderkey").cast("string").alias("match_id"), F.when(c("l_linenumber") % 2 == 0, "h").otherwise("a").alias("side"), c("l_partkey").alias("player"))
    text = lambda n, unit: F.concat((c("p_size") + n).cast("string"), F.lit(unit))
    players = table(spark, d, "part").select(c("p_partkey").alias("player"), text(150, " cm").alias("height"), text(50, "kg").alias("weight"), F.date_add(F.lit("1970-01-01").cast("date"), c("p_size") * 100).alias("dob"))
    f = features.lineup_averages(_spine(spark, d), lineups, players)
    return f.withColumns({x: F.round(x, 6) for x in f.columns if x != "match_id"})


@register("season_position_features", f"""
    WITH {MATCHES}, t AS (SELECT match_key, 'h' AS side, season, match_date, home_key AS team, home_goals AS gf, away_goals AS ga FROM m UNION ALL SELECT match_key, 'a', season, match_date, away_key, away_goals, home_goals FROM m),
    z AS (SELECT *, coalesce(CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 WHEN gf < ga THEN 0 END, 0) AS p, coalesce(gf - ga, 0) AS gd, coalesce(gf, 0) AS g FROM t),
    grid AS (SELECT * FROM (SELECT DISTINCT season, match_date FROM z) JOIN (SELECT DISTINCT season, team FROM z) USING (season)), s AS (SELECT season, team, match_date, sum(p) AS p, sum(gd) AS gd, sum(g) AS g FROM z GROUP BY ALL),
    k AS (SELECT x.season, x.match_date, x.team, coalesce(sum(p) OVER w, 0) AS p, coalesce(sum(gd) OVER w, 0) AS gd, coalesce(sum(g) OVER w, 0) AS g FROM grid x LEFT JOIN s USING (season, team, match_date) WINDOW w AS (PARTITION BY x.season, x.team ORDER BY x.match_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    r AS (SELECT season, match_date, team, CAST(rank() OVER (PARTITION BY season, match_date ORDER BY p DESC, gd DESC, g DESC) AS INTEGER) AS position FROM k)
    SELECT match_key AS match_id, max(position) FILTER (WHERE side = 'h') AS home_position, max(position) FILTER (WHERE side = 'a') AS away_position, max(CAST(position <= 6 AS INTEGER)) FILTER (WHERE side = 'h') AS home_is_top, max(CAST(position <= 6 AS INTEGER)) FILTER (WHERE side = 'a') AS away_is_top FROM t JOIN r USING (season, match_date, team) GROUP BY 1""")
def season_position_features(spark, d):
    return features.season_position(_spine(spark, d))
