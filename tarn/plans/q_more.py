"""Queries of the remaining operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.functions import json as J
from tarn.operators import aggregates as A
from tarn.operators import mlops as M
from tarn.operators import quality as Q
from tarn.operators import reshape as R
from tarn.operators import snapshot as S
from tarn.operators import temporal as T
from tarn.operators import text as X2
from tarn.plans.q_core import DAYS, orders, table
from tarn.plans.registry import register
from tarn.sources.readers import date_dim, extract_html_tables
from tarn.streaming import cdc
from tarn.streaming.state import elo, running_state


@register("corr_tripwire", """
    WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_discount, l_extendedprice) AS b, corr(l_tax, l_extendedprice) AS c, count(*) AS n FROM lineitem)
    SELECT feature, round(r, 6) AS r, n FROM (SELECT 'l_quantity' AS feature, a AS r, n FROM r UNION ALL SELECT 'l_discount', b, n FROM r UNION ALL SELECT 'l_tax', c, n FROM r)
    WHERE r IS NOT NULL AND NOT isnan(r) AND n >= 500 AND abs(r) > 0.3""")
def corr_tripwire(spark: SparkSession, d: str) -> DataFrame:
    return A.corr_tripwire(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", 0.3).withColumn("r", F.round("r", 6))


LABEL = "CASE WHEN value < 30 THEN 'negative' WHEN value < 60 THEN 'neutral' ELSE 'positive' END"


def _events(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return e.withColumn("sentiment_label", F.when(F.col("value") < 30, "negative").when(F.col("value") < 60, "neutral").otherwise("positive"))


@register("daily_metrics", f"""
    WITH e AS (SELECT *, CAST(ts AS DATE) AS day, {LABEL} AS l FROM events)
    SELECT day, event_type, count(*) AS documents, count(*) FILTER (WHERE l = 'negative') AS negative, count(*) FILTER (WHERE l = 'neutral') AS neutral, count(*) FILTER (WHERE l = 'positive') AS positive,
           round(count(*) FILTER (WHERE l = 'negative') / count(*), 6) AS negative_rate, round(count(*) FILTER (WHERE l = 'positive') / count(*), 6) AS positive_rate,
           round((count(*) FILTER (WHERE l = 'positive') - count(*) FILTER (WHERE l = 'negative')) / count(*), 6) AS balance FROM e GROUP BY ALL""")
def daily_metrics(spark, d):
    m = A.sentiment_metrics(_events(spark, d), ["day", "event_type"])
    return m.withColumns({c: F.round(c, 6) for c in ("negative_rate", "positive_rate", "balance")})


TREND = """
    WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day FROM events), t AS (SELECT max(day) AS today FROM e),
    s AS (SELECT event_type, count(*) FILTER (WHERE today - day >= 0 AND today - day < 7) AS recent, count(*) FILTER (WHERE today - day >= 7 AND today - day < 14) AS previous FROM e, t GROUP BY 1),
    k AS (SELECT *, recent / nullif(sum(recent) OVER (), 0) AS rs, coalesce(previous / nullif(sum(previous) OVER (), 0), 0) AS ps FROM s WHERE recent + previous > 0)
    SELECT event_type, recent, previous, round(rs, 6) AS recent_share, round(ps, 6) AS previous_share, round(rs / greatest(ps, 0.01), 6) AS share_lift, round(rs - ps, 6) AS share_delta, recent >= 5 AND rs / greatest(ps, 0.01) >= 1.01 AS is_growing FROM k"""


@register("trend_two_windows", TREND)
def trend_two_windows(spark, d):
    t = A.trend(_events(spark, d), ["event_type"], "day", 7, least=5, lift=1.01)
    return t.select("event_type", "recent", "previous", *[F.round(c, 6).alias(c) for c in ("recent_share", "previous_share", "share_lift", "share_delta")], "is_growing")


@register("burst_alerts", f"""
    WITH g AS ({TREND}), e AS (SELECT event_type, CAST(ts AS DATE) AS day, {LABEL} AS l FROM events), t AS (SELECT max(day) AS today FROM e)
    SELECT event_type, recent, round(nr, 6) AS negative_rate FROM g JOIN (SELECT event_type, count(*) FILTER (WHERE l = 'negative') / count(*) AS nr FROM e, t WHERE day > today - 7 GROUP BY 1) USING (event_type)
    WHERE is_growing AND nr >= 0.1""")
def burst_alerts(spark, d):
    _, alerts = X2.topic_alerts(_events(spark, d), ["event_type"], "day", 7, 5, 1.01, 0.1)
    return alerts.select("event_type", "recent", F.round("negative_rate", 6).alias("negative_rate"))


@register("quantile_cut", f"""
    SELECT CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(date_diff('day', DATE '1970-01-01', {DAYS}), 0.7)) AS INTEGER) AS DATE) AS q70,
           CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(date_diff('day', DATE '1970-01-01', {DAYS}), 0.85)) AS INTEGER) AS DATE) AS q85 FROM orders""")
def quantile_cut(spark, d):
    return A.quantile_dates(orders(spark, d), "day", [0.7, 0.85])


@register("calibration_bins", """
    WITH j AS (SELECT 1 - 1 / log2(n_chars + 4) AS p, quality FROM documents JOIN labels USING (doc_id)), c AS (SELECT quantile_cont(p, [0.2, 0.4, 0.6, 0.8]) AS c FROM j)
    SELECT CAST(len(list_filter(c, lambda x: x < p)) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(quality), 6) AS mean_y FROM j, c WHERE p IS NOT NULL GROUP BY 1""")
def calibration_bins(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").withColumn("p", 1 - 1 / F.log2(F.col("n_chars") + 4))
    return A.calibration(j, "p", "quality", 5).select("bin", "n", F.round("mean_p", 6).alias("mean_p"), F.round("mean_y", 6).alias("mean_y"))


@register("histogram", "SELECT p_brand, CAST(floor(p_size / 15) * 15 AS BIGINT) AS bucket, count(*) AS n FROM part GROUP BY ALL")
def histogram(spark, d):
    return R.histogram(table(spark, d, "part"), ["p_brand"], "p_size", 15)


@register("coverage", """
    SELECT event_type, count(*) AS n_rows, round(avg(CASE WHEN nullif(value, 0) > 20 THEN 1 ELSE 0 END), 4) AS v_rate FROM events GROUP BY 1""")
def coverage(spark, d):
    return A.coverage(table(spark, d, "events").withColumn("v", F.when(F.col("value") > 20, F.col("value"))), ["event_type"], ["v"])


@register("macro_trend", """
    WITH e AS (SELECT event_type, user_id % 3 AS src, CAST(ts AS DATE) AS day FROM events), t AS (SELECT max(day) AS today FROM e),
    s AS (SELECT src, event_type, count(*) FILTER (WHERE today - day BETWEEN 0 AND 6) AS r, count(*) FILTER (WHERE today - day BETWEEN 7 AND 13) AS p FROM e, t GROUP BY ALL),
    k AS (SELECT *, r / nullif(sum(r) OVER (PARTITION BY src), 0) AS rs, coalesce(p / nullif(sum(p) OVER (PARTITION BY src), 0), 0) AS ps FROM s WHERE r + p > 0)
    SELECT event_type, round(avg(rs), 6) AS recent_share, round(avg(ps), 6) AS previous_share FROM k GROUP BY 1""")
def macro_trend(spark, d):
    e = _events(spark, d).withColumn("src", F.col("user_id") % 3)
    m = A.macro_trend(A.trend(e, ["src", "event_type"], "day", 7, over=["src"]), ["event_type"])
    return m.withColumns({c: F.round(c, 6) for c in ("recent_share", "previous_share")})


@register("union_sides", """
    SELECT o_orderkey, 'h' AS side, o_custkey AS team, o_custkey % 7 AS opponent FROM orders UNION ALL SELECT o_orderkey, 'a', o_custkey % 7, o_custkey FROM orders""")
def union_sides(spark, d):
    c = F.col
    return R.two_sides(table(spark, d, "orders"), {"team": c("o_custkey"), "opponent": c("o_custkey") % 7}, {"team": c("o_custkey") % 7, "opponent": c("o_custkey")}, ["o_orderkey"])


@register("union_by_name", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name FROM supplier""")
def union_by_name(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return R.union_sources(a, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


def _two(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    b = li.filter("l_orderkey % 11 <> 0").withColumn("q", F.when(F.col("l_orderkey") % 13 == 0, F.col("q") + 1).otherwise(F.col("q")))
    return li, b


TWO = """WITH a AS (SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1),
    b AS (SELECT l_orderkey, n, CASE WHEN l_orderkey % 13 = 0 THEN q + 1 ELSE q END AS q FROM a WHERE l_orderkey % 11 <> 0)"""


@register("reconcile_sources", f"""
    {TWO} SELECT a.l_orderkey, 'missing' AS issue, '' AS "column", NULL::VARCHAR AS a_value, NULL::VARCHAR AS b_value FROM a WHERE l_orderkey NOT IN (SELECT l_orderkey FROM b)
    UNION ALL SELECT a.l_orderkey, 'mismatch', 'n', CAST(a.n AS VARCHAR), CAST(b.n AS VARCHAR) FROM a JOIN b USING (l_orderkey) WHERE a.n IS DISTINCT FROM b.n
    UNION ALL SELECT a.l_orderkey, 'mismatch', 'q', CAST(a.q AS VARCHAR), CAST(b.q AS VARCHAR) FROM a JOIN b USING (l_orderkey) WHERE a.q IS DISTINCT FROM b.q""")
def reconcile_sources(spark, d):
    return S.reconcile(*_two(spark, d), ["l_orderkey"], ["n", "q"])


@register("upsert_diff", f"""
    {TWO} SELECT a.l_orderkey, a.n, a.q, CASE WHEN b.l_orderkey IS NULL THEN 'insert' WHEN a.n = b.n AND a.q = b.q THEN 'unchanged' ELSE 'update' END AS action FROM a LEFT JOIN b USING (l_orderkey)""")
def upsert_diff(spark, d):
    a, b = _two(spark, d)
    return S.upsert_diff(b, a, ["l_orderkey"])


@register("upsert_applied", f"{TWO} SELECT * FROM a")
def upsert_applied(spark, d):
    a, b = _two(spark, d)
    return S.apply_upsert(b, S.upsert_diff(b, a, ["l_orderkey"]), ["l_orderkey"])


@register("orphans", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 2)
    AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_linenumber <= 2)""")
def orphans(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return S.orphans(li, li.filter("l_linenumber <= 2"), ["l_orderkey", "l_linenumber"], "l_orderkey")


@register("json_props", """
    SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k_double FROM events""")
def json_props(spark, d):
    e = table(spark, d, "events").withColumn("doc", F.try_parse_json("props"))
    return e.select("event_id", J.jget("doc", "$.k", "bigint").alias("k"), J.jget("doc", "$.missing").alias("missing"), J.jget("doc", "$.k", "double").alias("k_double"))


@register("explode_map", """
    SELECT event_id, key, json_extract_string(props, '$."' || key || '"') AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def explode_map(spark, d):
    e = table(spark, d, "events").withColumn("doc", F.try_parse_json("props"))
    return J.explode_map(e, "doc", keep=["event_id"]).select("event_id", "key", J.jget("value", "$").alias("value"))


@register("name_norm", """
    SELECT c_custkey, trim(regexp_replace(regexp_replace(strip_accents(lower(strip_accents(c_name || ' Çé-Ünï #' || c_mktsegment))), '[^a-z ]', ' ', 'g'), ' +', ' ', 'g')) AS norm FROM customer""")
def name_norm(spark, d):
    return table(spark, d, "customer").select("c_custkey", X.name_norm(F.concat(F.col("c_name"), F.lit(" Çé-Ünï #"), F.col("c_mktsegment"))).alias("norm"))


@register("word_stats", """
    SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS n_words, md5(lower(trim(coalesce(text, '')))) AS text_hash, length(text) AS n_code_points FROM documents""")
def word_stats(spark, d):
    return table(spark, d, "documents").select("doc_id", X.word_count("text").cast("long").alias("n_words"), F.md5(F.lower(F.trim(F.coalesce("text", F.lit(""))))).alias("text_hash"), F.length("text").cast("long").alias("n_code_points"))


@register("hash_dups", "SELECT md5(text) AS hash, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def hash_dups(spark, d):
    return A.dup_by_hash(table(spark, d, "documents").filter("text is not null"), "text", "doc_id")


@register("dictionary_mentions", """
    WITH a AS (SELECT DISTINCT lower(split_part(text, ' ', 1)) AS w, item_id FROM benchmark WHERE regexp_matches(lower(split_part(text, ' ', 1)), '^[a-z]{4,}$')),
    d AS (SELECT doc_id, unnest(regexp_split_to_array(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')) AS w FROM documents)
    SELECT doc_id, w AS alias, count(*) AS n_mentions FROM d JOIN (SELECT DISTINCT w FROM a) USING (w) GROUP BY ALL""")
def dictionary_mentions(spark, d):
    first = F.lower(F.split("text", " ")[0])
    a = table(spark, d, "benchmark").select(first.alias("alias")).filter(F.col("alias").rlike("^[a-z]{4,}$")).distinct().withColumn("entity", F.col("alias"))
    m = X2.word_mentions(table(spark, d, "documents"), a, "text", ["doc_id"], most_words=1)
    return m.select("doc_id", F.col("entity").alias("alias"), "n_mentions")


@register("alias_mentions", """
    WITH b AS (SELECT item_id, regexp_split_to_array(lower(text), '[^a-z]+') AS w FROM benchmark),
    a AS (SELECT DISTINCT 'e' || (item_id % 5) AS entity, array_to_string(w[x:x + n], ' ') AS alias FROM b, (VALUES (1), (2), (3)) v(x), (VALUES (0), (1)) z(n)),
    p AS (SELECT entity, '\\b(' || array_to_string(list(alias ORDER BY -length(alias), alias), '|') || ')\\b' AS pattern FROM a WHERE length(alias) >= 4 AND regexp_full_match(alias, '[a-z]+( [a-z]+)?') GROUP BY 1),
    h AS (SELECT doc_id, entity, len(regexp_extract_all(regexp_replace(lower(text), '[^ -~]', 'x', 'g'), pattern)) AS n FROM documents, p)
    SELECT doc_id, entity, CAST(n AS INTEGER) AS n_mentions FROM h WHERE n > 0""")
def alias_mentions(spark, d):
    """Words and word pairs from the benchmark's openings as aliases of five entities, in every document."""
    b = table(spark, d, "benchmark").select("item_id", F.split(F.lower("text"), "[^a-z]+").alias("w"))
    cut = [F.array_join(F.slice("w", x, n), " ") for x in (1, 2, 3) for n in (1, 2)]
    a = b.select(F.concat(F.lit("e"), F.col("item_id") % 5).alias("entity"), F.explode(F.array(*cut)).alias("alias")).filter(F.col("alias").rlike("^[a-z]+( [a-z]+)?$"))
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace(F.lower("text"), "[^ -~]", "x").alias("t"))
    return X2.mentions(docs, a, "t", ["doc_id"])


@register("contains_join", """
    WITH h AS (SELECT p_partkey, p_type, p_brand AS b, CASE WHEN p_name LIKE '%' || r_name || '%' OR p_type LIKE '%' || r_name || '%' THEN 1 END AS x, r_name FROM part, (SELECT DISTINCT left(p_type, 5) AS r_name FROM part))
    SELECT p_partkey, arg_min(r_name, (-length(r_name), r_name)) AS r_name FROM h WHERE x = 1 AND p_type LIKE '%' || r_name || '%' GROUP BY 1""")
def contains_join(spark, d):
    p = table(spark, d, "part")
    names = p.select(F.left("p_type", F.lit(5)).alias("r_name")).distinct()
    return X2.contains_mentions(p, names, "p_type", "r_name", ["p_partkey"])


@register("calendar", f"""
    SELECT o_orderkey, CAST(isodow({DAYS}) AS INTEGER) AS iso_dow, CAST(weekofyear({DAYS}) AS INTEGER) AS iso_week, CAST(quarter({DAYS}) AS INTEGER) AS quarter, dayname({DAYS}) AS day_name,
           CAST(CASE WHEN month({DAYS}) >= 7 THEN year({DAYS}) ELSE year({DAYS}) - 1 END AS INTEGER) AS season, last_day({DAYS}) AS month_end, CAST(dayofweek({DAYS}) AS INTEGER) AS dow0 FROM orders""")
def calendar(spark, d):
    return orders(spark, d).select("o_orderkey", X.iso_day_of_week("day").alias("iso_dow"), F.weekofyear("day").alias("iso_week"), F.quarter("day").alias("quarter"), F.date_format("day", "EEEE").alias("day_name"), X.season_of("day").alias("season"), X.month_end("day").alias("month_end"), X.day_of_week_sunday0("day").alias("dow0"))


@register("date_dim", """
    WITH r AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
    d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM r)
    SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(isodow(date) AS INTEGER) AS iso_dow, isodow(date) >= 6 AS is_weekend, season, season || '/' || right(CAST(season + 1 AS VARCHAR), 2) AS season_label
    FROM (SELECT date, CAST(CASE WHEN month(date) >= 7 THEN year(date) ELSE year(date) - 1 END AS INTEGER) AS season FROM d)""")
def date_dim_query(spark, d):
    r = orders(spark, d).agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    return date_dim(spark, r["a"], r["b"]).select("date", "year", "iso_dow", "is_weekend", "season", "season_label")


@register("tz_convert", """
    SELECT event_id, strftime(timezone('Europe/London', timezone('UTC', CAST(ts AS TIMESTAMP))), '%Y-%m-%d %H:%M:%S') AS london, strftime(date_trunc('hour', timezone('Asia/Tokyo', timezone('UTC', CAST(ts AS TIMESTAMP)))), '%Y-%m-%d %H:%M:%S') AS tokyo_hour FROM events""")
def tz_convert(spark, d):
    e = table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    f = "yyyy-MM-dd HH:mm:ss"
    return e.select("event_id", F.date_format(X.utc_to_local("t", "Europe/London"), f).alias("london"), F.date_format(F.date_trunc("hour", X.utc_to_local("t", "Asia/Tokyo")), f).alias("tokyo_hour"))


@register("implied_prob", """
    WITH p AS (SELECT p_partkey, 1 + p_retailprice / 1000 AS a, 1.5 + p_size / 20 AS b, 0.9 + p_partkey % 30 / 5 AS c FROM part)
    SELECT p_partkey, CASE WHEN a > 1 AND b > 1 AND c > 1 THEN round((1 / a) / (1 / a + 1 / b + 1 / c), 6) END AS p_home, round(1 / a + 1 / b + 1 / c - 1, 6) AS overround FROM p""")
def implied_prob(spark, d):
    p = table(spark, d, "part").select("p_partkey", (1 + F.col("p_retailprice") / 1000).alias("a"), (1.5 + F.col("p_size") / 20).alias("b"), (0.9 + F.col("p_partkey") % 30 / 5).alias("c"))
    return p.select("p_partkey", F.round(X.implied_prob(["a", "b", "c"], 0), 6).alias("p_home"), F.round(X.overround(["a", "b", "c"]), 6).alias("overround"))


@register("market_features", """
    WITH q AS (SELECT l_orderkey % 300 AS match_id, l_suppkey % 5 AS book, 1.2 + l_quantity / 20 AS a, 2 + l_discount * 10 AS b, 1.5 + l_tax * 20 AS c FROM lineitem),
    r AS (SELECT *, CASE WHEN a > 1 AND b > 1 AND c > 1 THEN 1 / (1 / a + 1 / b + 1 / c) END AS k FROM q)
    SELECT match_id, count(DISTINCT book) AS n_books, round(avg(1 / a + 1 / b + 1 / c - 1), 6) AS mean_overround, round(avg(k / a), 6) AS mkt_home, round(avg(k / b), 6) AS mkt_draw, round(max(k / c) FILTER (WHERE book = 3), 6) AS ref_away FROM r GROUP BY 1""")
def market_features(spark, d):
    q = table(spark, d, "lineitem").select((F.col("l_orderkey") % 300).alias("match_id"), (F.col("l_suppkey") % 5).alias("book"), (1.2 + F.col("l_quantity") / 20).alias("a"), (2 + F.col("l_discount") * 10).alias("b"), (1.5 + F.col("l_tax") * 20).alias("c"))
    m = A.market_features(q, ["match_id"], "book", ("a", "b", "c"), 3)
    return m.select("match_id", "n_books", *[F.round(c, 6).alias(c) for c in ("mean_overround", "mkt_home", "mkt_draw", "ref_away")])


@register("per_unit_rate", """
    SELECT l_partkey, l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN round(l_quantity * 90.0 / (l_tax * 1000), 3) END AS per90 FROM lineitem""")
def per_unit_rate(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", X.per_90("l_quantity", F.col("l_tax") * 1000).alias("per90"))


CDC_SQL = """WITH c AS (SELECT user_id AS key, event_id, value, CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN 'd' ELSE 'u' END AS op, event_id % 997 AS lsn FROM events)"""


def change_log(spark, d):
    """The events as a change log of users."""
    e = table(spark, d, "events")
    low = e.agg(F.min("event_type").alias("_low"))
    img = F.to_json(F.struct(F.col("user_id").alias("id"), F.col("event_id").alias("v")))
    gone = F.col("event_type") == F.col("_low")
    e = e.crossJoin(F.broadcast(low))
    return e.select(F.when(gone, "d").otherwise("u").alias("op"), F.when(gone, img).alias("before"), F.when(~gone, img).alias("after"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), (F.col("event_id") % 997).alias("lsn"), F.col("event_id").alias("offset"))


@register("cdc_current", f"""{CDC_SQL}
    SELECT CAST(key AS VARCHAR) AS key, event_id AS v, lsn FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY lsn DESC, event_id DESC) = 1) WHERE op <> 'd'""")
def cdc_current(spark, d):
    now = cdc.current_state(change_log(spark, d), "id")
    return now.select("key", J.jget(F.try_parse_json("after"), "$.v", "bigint").alias("v"), "lsn")


@register("running_state", """
    SELECT user_id, count(*) AS n_events, count(*) FILTER (WHERE value > 50) AS n_high, arg_max(event_type, (ts, event_id)) AS last_event_type FROM events GROUP BY 1""")
def running_state_query(spark, d):
    return running_state(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], {"n_high": F.col("value") > 50}, ["event_type"])


@register("calendar_split", f"""
    SELECT o_orderkey, CASE WHEN {DAYS} < DATE '1997-01-01' THEN 'train' WHEN {DAYS} < DATE '1998-01-01' THEN 'valid' ELSE 'test' END AS split FROM orders""")
def calendar_split(spark, d):
    return orders(spark, d).select("o_orderkey", T.calendar_split("day", "1997-01-01", "1998-01-01").alias("split"))


@register("season_split", f"""
    WITH o AS (SELECT o_orderkey, CASE WHEN month({DAYS}) >= 7 THEN year({DAYS}) ELSE year({DAYS}) - 1 END AS season FROM orders), s AS (SELECT season, row_number() OVER (ORDER BY season DESC) AS r FROM (SELECT DISTINCT season FROM o))
    SELECT o_orderkey, CASE WHEN r <= 1 THEN 'test' WHEN r <= 3 THEN 'valid' ELSE 'train' END AS split FROM o JOIN s USING (season)""")
def season_split(spark, d):
    o = orders(spark, d).select("o_orderkey", X.season_of("day").alias("season"))
    return T.season_split(o, "season", valid=2).select("o_orderkey", "split")


@register("fraction_split", f"""
    WITH q AS (SELECT quantile_cont(date_diff('day', DATE '1970-01-01', {DAYS}), 0.7) AS a, quantile_cont(date_diff('day', DATE '1970-01-01', {DAYS}), 0.85) AS b FROM orders)
    SELECT o_orderkey, CASE WHEN date_diff('day', DATE '1970-01-01', {DAYS}) <= a THEN 'train' WHEN date_diff('day', DATE '1970-01-01', {DAYS}) <= b THEN 'valid' ELSE 'test' END AS split FROM orders, q""")
def fraction_split(spark, d):
    return T.fraction_split(orders(spark, d).select("o_orderkey", "day"), "day").select("o_orderkey", "split")


@register("training_snapshot", f"""
    WITH w AS (SELECT max({DAYS}) AS as_of FROM orders),
    b AS (SELECT as_of, CAST(date_trunc('month', as_of) - INTERVAL 2 MONTH AS DATE) AS test_start FROM w),
    c AS (SELECT *, CAST(test_start - INTERVAL 3 MONTH AS DATE) AS valid_start FROM b)
    SELECT o_orderkey, CASE WHEN {DAYS} < valid_start THEN 'train' WHEN {DAYS} < test_start THEN 'valid' ELSE 'test' END AS split FROM orders, c
    WHERE {DAYS} <= as_of AND CAST({DAYS} AS TIMESTAMP) + INTERVAL 3 HOUR < CASE WHEN {DAYS} < valid_start THEN CAST(valid_start AS TIMESTAMP) WHEN {DAYS} < test_start THEN CAST(test_start AS TIMESTAMP) ELSE CAST(as_of + 1 AS TIMESTAMP) END""")
def training_snapshot(spark, d):
    o = orders(spark, d)
    as_of = o.agg(F.max("day").alias("m")).first()["m"]
    w = T.training_window(spark, str(as_of), 3, 3)
    return T.training_snapshot(o, w, "day", "o_totalprice", "day", 3).select("o_orderkey", "split")


@register("elo_by_group")
def elo_by_group(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("grp"), "event_id", F.year("ts").alias("season"), F.col("ts").cast("timestamp").alias("at"), (F.col("user_id") % 40).cast("string").alias("home"), (F.col("event_id") % 41 + 40).cast("string").alias("away"), (F.col("value") % 4).cast("int").alias("hg"), (F.col("event_id") % 3).cast("int").alias("ag"))
    return elo(e, "grp", "season", ["at"], "home", "away", "hg", "ag", "event_id")


@register("source_health", f"""
    WITH t AS (SELECT max({DAYS}) AS today FROM orders)
    SELECT o_orderpriority, count(*) AS n_rows, max({DAYS}) AS newest, count(DISTINCT {DAYS}) AS n_days, count(*) FILTER (WHERE {DAYS} > today - 30) AS n_recent, CAST(min(date_diff('day', {DAYS}, today)) AS INTEGER) AS days_behind FROM orders, t GROUP BY 1""")
def source_health(spark, d):
    return X2.source_health(orders(spark, d), "o_orderpriority", "day", 30)


@register("normalize_docs", """
    WITH u AS (SELECT 'documents' AS source_type, 'd' || doc_id AS doc_id, text, lang AS language FROM documents UNION ALL SELECT 'conversations', 'c' || conv_id || '-' || turn, text, NULL FROM conversations)
    SELECT doc_id, source_type, language, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS n FROM u WHERE text IS NOT NULL""")
def normalize_docs(spark, d):
    c = F.col
    docs = table(spark, d, "documents").select(F.concat(F.lit("d"), c("doc_id").cast("string")).alias("doc_id"), "text", "lang", F.lit("documents").alias("s"))
    conv = table(spark, d, "conversations").select(F.concat(F.lit("c"), c("conv_id").cast("string"), F.lit("-"), c("turn").cast("string")).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"), F.lit("conversations").alias("s"))
    u = docs.union(conv).filter("text is not null")
    return u.select("doc_id", c("s").alias("source_type"), c("lang").alias("language"), F.length(F.trim(F.regexp_replace("text", r"\s+", " "))).cast("long").alias("n"))


@register("topic_clusters")
def topic_clusters(spark, d):
    docs = table(spark, d, "documents").filter("text is not null")
    model, _ = X2.fit_topics(docs.select("doc_id", "text"), "text", [2, 3, 4])
    names = X2.topic_names(spark, model)
    return model.transform(docs).select("doc_id", "topic_id").join(F.broadcast(names), "topic_id")


@register("sentiment_model")
def sentiment_model(spark, d):
    """Character trigram classifier of the documents' language: every document with a text is scored whole.

    Fitted on whole texts of all labelled documents, or of about ``most_labelled`` (20,000) of them, evenly by language.
    """
    docs = table(spark, d, "documents").filter("text is not null")
    model = X2.fit_sentiment(docs, "doc_id", "text", "lang", most_labelled=20_000)
    return X2.score_sentiment(model, docs, ["doc_id"], "text")


@register("js_distance", """
    WITH a AS (SELECT lang, count(*) / sum(count(*)) OVER () AS p FROM documents WHERE doc_id % 2 = 0 GROUP BY 1), b AS (SELECT lang, count(*) / sum(count(*)) OVER () AS q FROM documents WHERE doc_id % 2 = 1 GROUP BY 1),
    j AS (SELECT coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM a FULL JOIN b USING (lang))
    SELECT round(sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END / 2 + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END / 2))), 6) AS js_distance FROM j""")
def js_distance(spark, d):
    docs = table(spark, d, "documents")
    return X2.js_distance(docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1"), "lang").withColumn("js_distance", F.round("js_distance", 6))


@register("score_rules", """
    WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity / 50 AS h, l_discount * 10 AS a FROM lineitem),
    s AS (SELECT *, exp(h - greatest(h, 0, a)) AS eh, exp(0 - greatest(h, 0, a)) AS ed, exp(a - greatest(h, 0, a)) AS ea FROM l),
    c AS (SELECT l_orderkey, l_linenumber, least(0.82, greatest(0.08, eh / (eh + ed + ea))) AS h, least(0.82, greatest(0.08, ed / (eh + ed + ea))) AS d, least(0.82, greatest(0.08, ea / (eh + ed + ea))) AS a FROM s)
    SELECT l_orderkey, l_linenumber, round(h / (h + d + a), 6) AS p_home, round(d / (h + d + a), 6) AS p_draw, CASE WHEN d / (h + d + a) >= 0.32 THEN 'D' WHEN h >= a THEN 'H' ELSE 'A' END AS predicted_result FROM c""")
def score_rules(spark, d):
    li = table(spark, d, "lineitem")
    s = M.with_decision(M.rule_scores(li, F.col("l_quantity") / 50, F.col("l_discount") * 10))
    return s.select("l_orderkey", "l_linenumber", F.round("p_home", 6).alias("p_home"), F.round("p_draw", 6).alias("p_draw"), "predicted_result")


@register("feature_selection", """
    WITH l AS (SELECT *, CASE WHEN l_orderkey % 4 = 0 THEN 'test' ELSE 'train' END AS split, CASE WHEN l_discount > 0.05 THEN l_discount END AS d FROM lineitem)
    SELECT 'd' AS feature, round(avg(CASE WHEN d IS NULL THEN 1 ELSE 0 END) FILTER (WHERE split = 'train'), 6) AS missing_train, count(DISTINCT d) FILTER (WHERE split = 'train') AS n_distinct_train FROM l
    UNION ALL SELECT 'l_quantity', 0.0, count(DISTINCT l_quantity) FILTER (WHERE split = 'train') FROM l""")
def feature_selection(spark, d):
    li = table(spark, d, "lineitem").withColumns({"split": F.when(F.col("l_orderkey") % 4 == 0, "test").otherwise("train"), "d": F.when(F.col("l_discount") > 0.05, F.col("l_discount"))})
    return M.feature_report(li, ["d", "l_quantity"]).select("feature", F.round("missing_train", 6).alias("missing_train"), "n_distinct_train")


@register("align_features", """
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity, CAST(CASE WHEN l_tax > 0 THEN l_quantity / l_tax END AS FLOAT) AS r, CAST(NULL AS FLOAT) AS absent FROM lineitem""")
def align_features(spark, d):
    li = table(spark, d, "lineitem").withColumn("r", F.when(F.col("l_tax") > 0, F.col("l_quantity") / F.col("l_tax")).otherwise(F.lit(float("inf"))))
    return M.align_features(li, ["l_quantity", "r", "absent"], ["l_orderkey", "l_linenumber"])


@register("fingerprint")
def fingerprint(spark, d):
    return Q.fingerprint(table(spark, d, "orders"))


PRED = "CASE WHEN n_chars % 5 < 3 THEN 'en' WHEN n_chars % 5 = 3 THEN 'de' ELSE 'fr' END"


def _pred(spark, d):
    p = F.when(F.col("n_chars") % 5 < 3, "en").when(F.col("n_chars") % 5 == 3, "de").otherwise("fr")
    return table(spark, d, "documents").select("lang", p.alias("pred")).filter("lang is not null and pred is not null")


@register("class_metrics", f"""
    WITH x AS (SELECT lang AS a, {PRED} AS p FROM documents WHERE lang IS NOT NULL), s AS (SELECT a AS class, count(*) AS support, count(*) FILTER (WHERE a = p) AS tp FROM x GROUP BY 1), t AS (SELECT p AS class, count(*) AS predicted_n FROM x GROUP BY 1)
    SELECT class, coalesce(support, 0) AS support, coalesce(predicted_n, 0) AS predicted_n, coalesce(tp, 0) AS tp, round(coalesce(tp / nullif(predicted_n, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(support, 0), 0), 6) AS recall FROM s FULL JOIN t USING (class)""")
def class_metrics(spark, d):
    m = M.class_metrics(_pred(spark, d), "lang", "pred")
    return m.select("class", "support", "predicted_n", "tp", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@register("overall_metrics", f"""
    WITH x AS (SELECT lang AS a, {PRED} AS p FROM documents WHERE lang IS NOT NULL), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE a = p) AS c FROM x),
    k AS (SELECT class, coalesce(support, 0) AS s, coalesce(predicted_n, 0) AS t, coalesce(tp, 0) AS tp FROM (SELECT a AS class, count(*) AS support, count(*) FILTER (WHERE a = p) AS tp FROM x GROUP BY 1) FULL JOIN (SELECT p AS class, count(*) AS predicted_n FROM x GROUP BY 1) USING (class)),
    z AS (SELECT sum(s * t) AS st, sum(s * s) AS ss, sum(t * t) AS tt, avg(tp / nullif(s, 0)) AS bal FROM k)
    SELECT n, round(c / n, 6) AS accuracy, round(bal, 6) AS balanced_accuracy, round((CAST(c AS DOUBLE) * n - st) / sqrt((CAST(n AS DOUBLE) * n - ss) * (CAST(n AS DOUBLE) * n - tt)), 6) AS mcc FROM n, z""")
def overall_metrics(spark, d):
    m = M.overall_metrics(_pred(spark, d), "lang", "pred")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("accuracy", "balanced_accuracy", "mcc")])


@register("importance_rank", """
    SELECT p_brand, v, CAST(row_number() OVER (ORDER BY abs(v) DESC, p_brand) AS INTEGER) AS rank, round(100 * abs(v) / sum(abs(v)) OVER (), 4) AS share_pct FROM (SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS v FROM part GROUP BY 1)""")
def importance_rank(spark, d):
    p = table(spark, d, "part").groupBy("p_brand").agg(F.sum("p_size").alias("v"))
    return M.importance_rank(p, "p_brand", "v").withColumn("share_pct", F.round("share_pct", 4))


@register("top_contributors", """
    WITH l AS (SELECT l_orderkey, 'f' || l_linenumber AS name, max(l_extendedprice - 40000) AS v FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, array_to_string(list(name ORDER BY v DESC, name DESC) FILTER (WHERE v > 0)[1:3], ',') AS drivers, array_to_string(list(name ORDER BY v, name) FILTER (WHERE v < 0)[1:1], ',') AS risks FROM l GROUP BY 1""".replace("list(name ORDER BY v DESC, name DESC) FILTER (WHERE v > 0)[1:3]", "(list(name ORDER BY v DESC, name DESC) FILTER (WHERE v > 0))[1:3]").replace("list(name ORDER BY v, name) FILTER (WHERE v < 0)[1:1]", "(list(name ORDER BY v, name) FILTER (WHERE v < 0))[1:1]").replace("array_to_string(", "coalesce(array_to_string(").replace(", ',') AS", ", ','), '') AS"))
def top_contributors(spark, d):
    long = table(spark, d, "lineitem").groupBy("l_orderkey", F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("name")).agg(F.max(F.col("l_extendedprice") - 40000).alias("v"))
    t = M.top_contributors(long, ["l_orderkey"], "name", "v")
    return t.select("l_orderkey", F.array_join("drivers", ",").alias("drivers"), F.array_join("risks", ",").alias("risks"))


@register("train_and_score")
def train_and_score(spark, d):
    """Multinomial model of the order's status from its lines, trained on three quarters, scored on all."""
    f = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("disc"), F.count("*").cast("double").alias("n"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(f, "o_orderkey", "left")
    model = M.train_multiclass(o.filter("o_orderkey % 4 <> 0"), ["q", "disc", "n"], "o_orderstatus", weights={"P": 1.5})
    return M.score(model, o, ["o_orderkey"], "o_orderstatus")


@register("dq_report", """
    SELECT 'unique(l_orderkey,l_linenumber)' AS rule, 'error' AS severity, count(*) AS n_violations FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'not_null(l_orderkey)', 'error', count(*) FROM lineitem WHERE l_orderkey IS NULL UNION ALL SELECT 'accepted_values(l_returnflag)', 'error', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'R')
    UNION ALL SELECT 'relationship(l_partkey)', 'error', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2) UNION ALL SELECT 'small', 'warn', count(*) FROM lineitem WHERE NOT l_quantity < 45""")
def dq_report(spark, d):
    rules = [Q.unique("l_orderkey", "l_linenumber"), Q.not_null("l_orderkey"), Q.accepted_values("l_returnflag", ["A", "R"]), Q.relationship("l_partkey", table(spark, d, "part").filter("p_size > 2"), "p_partkey"), Q.expression("small", F.col("l_quantity") < 45, "warn")]
    return Q.report(table(spark, d, "lineitem"), rules)


@register("layer_counts", """
    WITH a AS (SELECT l_returnflag AS k, count(*) AS staged FROM lineitem GROUP BY 1), b AS (SELECT l_returnflag AS k, count(*) AS kept FROM lineitem WHERE l_quantity > 0 AND (l_returnflag <> 'R' OR l_linenumber > 1) GROUP BY 1)
    SELECT k AS l_returnflag, coalesce(staged, 0) AS staged, coalesce(kept, 0) AS kept, coalesce(staged, 0) = coalesce(kept, 0) AS is_even FROM a FULL JOIN b USING (k)""")
def layer_counts(spark, d):
    li = table(spark, d, "lineitem")
    return Q.layer_counts({"staged": li, "kept": li.filter("l_quantity > 0 and (l_returnflag <> 'R' or l_linenumber > 1)")}, "l_returnflag")


@register("side_balance", """
    SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'O') AS n_O, count(*) FILTER (WHERE l_linestatus = 'F') AS n_F, count(*) AS n FROM lineitem GROUP BY 1
    HAVING count(*) FILTER (WHERE l_linestatus = 'O') <> 1 OR count(*) FILTER (WHERE l_linestatus = 'F') <> 1 OR count(*) <> 2""")
def side_balance(spark, d):
    return Q.side_balance(table(spark, d, "lineitem"), "l_orderkey", "l_linestatus", ("O", "F"))


@register("profile", """
    SELECT "column", n_rows, n_null, n_distinct FROM (SELECT 'o_orderkey' AS "column", count(*) AS n_rows, count(*) - count(o_orderkey) AS n_null, count(DISTINCT o_orderkey) AS n_distinct FROM orders
    UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), count(DISTINCT o_orderstatus) FROM orders UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority), count(DISTINCT o_orderpriority) FROM orders)""")
def profile(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return A.profile(o, approx=False).select("column", "n_rows", "n_null", "n_distinct")


@register("html_tables")
def html_tables(spark, d):
    """Tables of the stored pages, and their lists as one-column rows are left alone."""
    return extract_html_tables(table(spark, d, "pages"), "page_id", "html")


@register("csv_pairs", """
    SELECT p_partkey, a, b FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS a, unnest(string_split(p_type, ' ')) AS b FROM part)""")
def csv_pairs(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.replace("p_type", F.lit(" "), F.lit(",")).alias("a"), F.replace("p_type", F.lit(" "), F.lit(",")).alias("b"))
    return R.explode_csv_pairs(p, ["a", "b"], ["p_partkey"])


@register("anomaly_scores", """
    WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT event_type, median(n) AS m FROM e GROUP BY 1), x AS (SELECT e.*, m FROM e JOIN m USING (event_type)), k AS (SELECT event_type, median(abs(n - m)) AS k FROM x GROUP BY 1)
    SELECT event_type, day, n, round(coalesce(abs((n - m) / nullif(1.4826 * k, 0)), 0), 6) AS anomaly_score FROM x JOIN k USING (event_type)""")
def anomaly_scores(spark, d):
    e = _events(spark, d).groupBy("event_type", "day").agg(F.count("*").alias("n"))
    return X2.anomaly_scores(e, ["event_type"], ["n"]).select("event_type", "day", "n", F.round("anomaly_score", 6).alias("anomaly_score"))


@register("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25")
def top_n(spark, d):
    return A.top_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")], 25)


@register("rank_desc", """
    SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS INTEGER) AS rank FROM orders""")
def rank_desc(spark, d):
    return A.rank_desc(table(spark, d, "orders"), ["o_custkey"], "o_totalprice", ["o_orderkey"]).select("o_custkey", "o_orderkey", "rank")


@register("row_conflicts", """
    SELECT l_orderkey, l_linenumber, CAST(len(list_distinct(list_filter([l_returnflag, l_linestatus, CASE WHEN l_tax > 0.04 THEN 'A' END], lambda x: x IS NOT NULL))) AS INTEGER) AS n FROM lineitem""")
def row_conflicts(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.n_distinct_in_row("l_returnflag", "l_linestatus", F.when(F.col("l_tax") > 0.04, "A")).alias("n"))


@register("text_labels", """
    WITH t AS (SELECT doc_id, lower(regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]', 'x', 'g')) AS t FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(t, '\\b(the|of)\\b')) AS p, len(regexp_extract_all(t, '\\b(and|in)\\b')) AS n FROM t)
    SELECT doc_id, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label, round(CASE WHEN p + n > 0 THEN least(0.95, 0.5 + abs(p - n) / (2.0 * (p + n))) ELSE 0.5 END, 6) AS confidence FROM c""")
def text_labels(spark, d):
    label, conf = X.lexicon_sentiment(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x00-\x7F]", "x"), ["the", "of"], ["and", "in"])
    return table(spark, d, "documents").select("doc_id", label.alias("label"), F.round(conf, 6).alias("confidence"))
