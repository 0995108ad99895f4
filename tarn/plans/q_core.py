"""Queries of the snapshot, join, window and aggregation operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.operators import aggregates as A
from tarn.operators import reshape as R
from tarn.operators import resolve as E
from tarn.operators import snapshot as S
from tarn.operators import temporal as T
from tarn.plans.registry import register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))


def by_customer():
    return Window.partitionBy("o_custkey").orderBy("day", "o_orderkey")


DAYS = "CAST(o_orderdate AS DATE)"


@register("asof_rolling_features", f"""
    WITH o AS (SELECT *, {DAYS} AS day FROM orders),
    r AS (SELECT o_custkey, day, o_orderkey,
                 CASE WHEN count(o_totalprice) OVER w >= 3 THEN avg(o_totalprice) OVER w END AS roll3
          FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
    last_of_day AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey, day ORDER BY o_orderkey DESC) = 1)
    SELECT o.o_orderkey, o.o_custkey, round(r.roll3, 6) AS f_avg_price_3, round(o.o_totalprice / r.roll3, 6) AS price_ratio
    FROM o ASOF LEFT JOIN last_of_day r ON o.o_custkey = r.o_custkey AND o.day > r.day""")
def asof_rolling_features(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d)
    rolled = o.select("o_custkey", "day", "o_orderkey", T.roll_avg("o_totalprice", by_customer(), 3).alias("roll3"))
    j = T.asof_join(o.select("o_orderkey", "o_custkey", "o_totalprice", "day"), rolled, ["o_custkey"], "day", "day", ["roll3"], tie=["o_orderkey"])
    return j.select("o_orderkey", "o_custkey", F.round("roll3", 6).alias("f_avg_price_3"), F.round(F.col("o_totalprice") / F.col("roll3"), 6).alias("price_ratio"))


@register("latest_order_per_customer", f"""
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {DAYS} DESC NULLS LAST, o_orderkey DESC) = 1""")
def latest_order_per_customer(spark, d):
    return S.latest(orders(spark, d), ["o_custkey"], [F.desc_nulls_last("day"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@register("latest_order_by_max", f"""
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {DAYS} DESC, o_orderkey DESC) = 1""")
def latest_order_by_max(spark, d):
    return S.latest_by(orders(spark, d).select("o_custkey", "day", "o_orderkey", "o_totalprice"), ["o_custkey"], ["day", "o_orderkey"]).drop("day")


@register("latest_batch_per_type", """
    SELECT event_type, event_id, user_id FROM events
    QUALIFY dense_rank() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE) DESC NULLS LAST) = 1""")
def latest_batch_per_type(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return S.latest_batch(e, ["event_type"], F.col("day")).select("event_type", "event_id", "user_id")


@register("rolling_min_obs_avg", f"""
    SELECT o_orderkey,
           CASE WHEN count(o_totalprice) OVER w5 >= 5 THEN round(avg(o_totalprice) OVER w5, 6) END AS avg5,
           round(avg(o_totalprice) OVER wc, 6) AS avg_so_far, count(*) OVER wp AS n_prior
    FROM orders
    WINDOW w5 AS (PARTITION BY o_custkey ORDER BY {DAYS}, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           wc AS (PARTITION BY o_custkey ORDER BY {DAYS}, o_orderkey ROWS UNBOUNDED PRECEDING),
           wp AS (PARTITION BY o_custkey ORDER BY {DAYS}, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def rolling_min_obs_avg(spark, d):
    w = by_customer()
    return orders(spark, d).select("o_orderkey", F.round(T.roll_avg("o_totalprice", w, 5), 6).alias("avg5"), F.round(T.cum_avg("o_totalprice", w), 6).alias("avg_so_far"), T.n_prior(w).alias("n_prior"))


@register("prior_avg_and_gap", f"""
    SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY {DAYS}, o_orderkey ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS prior5,
           CAST(least(date_diff('day', lag({DAYS}) OVER w, {DAYS}), 30) AS INTEGER) AS gap_days
    FROM (SELECT * FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY {DAYS}, o_orderkey)
    """.replace("CAST(least(date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER w, CAST(o_orderdate AS DATE)), 30) AS INTEGER)", "CASE WHEN lag(CAST(o_orderdate AS DATE)) OVER w IS NOT NULL THEN CAST(least(date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER w, CAST(o_orderdate AS DATE)), 30) AS INTEGER) END"))
def prior_avg_and_gap(spark, d):
    w = by_customer()
    return orders(spark, d).select("o_orderkey", F.round(T.prior_avg("o_totalprice", w, 5), 6).alias("prior5"), T.gap_days("day", w, 30).alias("gap_days"))


@register("range_sum_before", """
    SELECT l_orderkey, l_linenumber, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS qty_before
    FROM lineitem""")
def range_sum_before(spark, d):
    li = table(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    return li.select("l_orderkey", "l_linenumber", T.sum_before("q", ["l_orderkey"], "l_linenumber").alias("qty_before"))


@register("rank_before_date", f"""
    WITH o AS (SELECT c_nationkey, c_mktsegment, year({DAYS}) AS yr, date_trunc('month', {DAYS})::DATE AS month, CAST(floor(o_totalprice) AS BIGINT) AS pts
               FROM orders JOIN customer ON o_custkey = c_custkey),
    grid AS (SELECT * FROM (SELECT DISTINCT c_nationkey, yr, month FROM o) JOIN (SELECT DISTINCT c_nationkey, yr, c_mktsegment FROM o) USING (c_nationkey, yr)),
    daily AS (SELECT c_nationkey, yr, c_mktsegment, month, sum(pts) AS pts, count(*) AS n FROM o GROUP BY ALL),
    s AS (SELECT g.c_nationkey, g.yr, g.c_mktsegment, g.month, coalesce(sum(pts) OVER w, 0) AS pts_before, coalesce(sum(n) OVER w, 0) AS n_before
          FROM grid g LEFT JOIN daily d USING (c_nationkey, yr, c_mktsegment, month)
          WINDOW w AS (PARTITION BY g.c_nationkey, g.yr, g.c_mktsegment ORDER BY g.month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT c_nationkey, CAST(yr AS INTEGER) AS yr, c_mktsegment, month, CAST(pts_before AS BIGINT) AS pts_before, CAST(n_before AS BIGINT) AS n_before,
           CAST(rank() OVER (PARTITION BY c_nationkey, yr, month ORDER BY pts_before DESC, n_before DESC) AS INTEGER) AS position,
           rank() OVER (PARTITION BY c_nationkey, yr, month ORDER BY pts_before DESC, n_before DESC) <= 2 AS is_top
    FROM s""")
def rank_before_date(spark, d):
    o = orders(spark, d).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.select("c_nationkey", "c_mktsegment", F.year("day").alias("yr"), F.trunc("day", "month").alias("month"), F.floor("o_totalprice").alias("pts"), F.lit(1).cast("long").alias("n"))
    return T.rank_before(o, ["c_nationkey", "yr"], "c_mktsegment", "month", "pts", ["n"], top=2)


@register("form_string", """
    SELECT event_id, array_to_string(list(upper(left(event_type, 1))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), '') AS form FROM events""")
def form_string(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", T.form_string(F.upper(F.left("event_type", F.lit(1))), w).alias("form"))


@register("daily_spikes", """
    WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL),
    r AS (SELECT *, count(n) OVER w AS c, avg(n) OVER w AS m, stddev_samp(n) OVER w AS s FROM e
          WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT event_type, day, n, round(CASE WHEN c >= 3 THEN m END, 6) AS base_mean,
           round(CASE WHEN c >= 3 AND s > 0 THEN (n - m) / s END, 6) AS z_score,
           coalesce(CASE WHEN c >= 3 AND s > 0 THEN (n - m) / s END >= 2.0, false) AS is_spike FROM r""")
def daily_spikes(spark, d):
    e = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    s = T.spikes(e, ["event_type"], "day", "n")
    return s.select("event_type", "day", "n", F.round("base_mean", 6).alias("base_mean"), F.round("z_score", 6).alias("z_score"), "is_spike")


@register("period_change", """
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_value, arg_max(event_id, (ts, event_id)) AS last_value,
           arg_max(event_id, (ts, event_id)) - arg_min(event_id, (ts, event_id)) AS change FROM events GROUP BY user_id""")
def period_change(spark, d):
    return T.period_change(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_id")


@register("alias_resolve", """
    WITH a AS (SELECT lower(n_name) AS alias, n_name AS k FROM nation WHERE n_nationkey % 2 = 0)
    SELECT c_custkey, coalesce(k, n_name) AS key_loose, k AS key_strict, k IS NOT NULL AS is_mapped
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN a ON lower(trim(n_name)) = alias""")
def alias_resolve(spark, d):
    n = table(spark, d, "nation")
    alias = n.filter("n_nationkey % 2 = 0").select(F.lower("n_name").alias("alias"), F.col("n_name").alias("team_key"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    c = E.resolve_alias(E.resolve_alias(c, "n_name", alias, "key_loose"), "n_name", alias, "key_strict", strict=True)
    return E.mapped_flag(c, "n_name", alias).drop("n_name")


@register("alias_by_source", """
    WITH a AS (SELECT CASE WHEN n_nationkey % 3 = 0 THEN 's' ELSE 'c' END AS source, lower(trim(n_name)) AS alias, 'K' || n_nationkey AS team_key FROM nation WHERE n_nationkey % 4 <> 0
               UNION ALL SELECT 'c', lower(trim(n_name)), 'C' || n_nationkey FROM nation WHERE n_nationkey % 5 = 0),
    own AS (SELECT source, alias, min(team_key) AS k FROM a GROUP BY ALL), any_ AS (SELECT alias, min(team_key) AS k FROM a GROUP BY ALL)
    SELECT s_suppkey, coalesce(own.k, any_.k, trim(n_name)) AS team_key FROM supplier JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN own ON own.source = 's' AND own.alias = lower(trim(n_name)) LEFT JOIN any_ ON any_.alias = lower(trim(n_name))""")
def alias_by_source(spark, d):
    n = table(spark, d, "nation")
    a = n.filter("n_nationkey % 4 <> 0").select(F.when(F.col("n_nationkey") % 3 == 0, "s").otherwise("c").alias("source"), F.col("n_name").alias("alias"), F.concat(F.lit("K"), F.col("n_nationkey").cast("string")).alias("team_key"))
    a = a.union(n.filter("n_nationkey % 5 = 0").select(F.lit("c"), "n_name", F.concat(F.lit("C"), F.col("n_nationkey").cast("string"))))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return E.resolve_by_source(s, "n_name", F.lit("s"), a, "team_key").drop("n_name")


@register("unmapped_report", """
    WITH names AS (SELECT 'customer' AS source, n_name AS raw_name FROM customer JOIN nation ON c_nationkey = n_nationkey
                   UNION ALL SELECT 'supplier', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT source, raw_name, count(*) AS n_rows FROM names
    WHERE lower(trim(raw_name)) NOT IN (SELECT lower(n_name) FROM nation WHERE n_nationkey % 2 = 0) GROUP BY ALL""")
def unmapped_report(spark, d):
    n = table(spark, d, "nation")
    alias = n.filter("n_nationkey % 2 = 0").select(F.lower("n_name").alias("alias"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.lit("customer").alias("source"), "n_name")
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.lit("supplier").alias("source"), "n_name")
    return E.unmapped_report(c.union(s), "n_name", "source", alias)


@register("link_unique", """
    WITH c AS (SELECT c_custkey, c_nationkey, CAST(floor(c_acctbal / 10) AS BIGINT) AS b, c_custkey % 97 AS m FROM customer),
    s AS (SELECT s_suppkey, s_nationkey, CAST(floor(s_acctbal / 10) AS BIGINT) AS b, s_suppkey % 97 AS m FROM supplier)
    SELECT c_custkey, min(s_suppkey) AS s_suppkey FROM (SELECT DISTINCT c_custkey, s_suppkey FROM c JOIN s ON c.b = s.b OR (c_nationkey = s_nationkey AND c.m = s.m))
    GROUP BY c_custkey HAVING count(*) = 1""")
def link_unique(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.floor(F.col("c_acctbal") / 10).alias("b"), (F.col("c_custkey") % 97).alias("m"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.floor(F.col("s_acctbal") / 10).alias("b"), (F.col("s_suppkey") % 97).alias("m"))
    return E.link_unique(c, s, "c_custkey", "s_suppkey", [(["b"], ["b"]), (["c_nationkey", "m"], ["s_nationkey", "m"])])


@register("asof_strict", f"""
    WITH o AS (SELECT o_orderkey, o_custkey, {DAYS} AS day, o_totalprice FROM orders),
    r AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, day ORDER BY o_orderkey DESC) = 1)
    SELECT o.o_orderkey, r.o_orderkey AS prev_o_orderkey, r.o_totalprice AS prev_o_totalprice
    FROM o ASOF LEFT JOIN r ON o.o_custkey = r.o_custkey AND o.day > r.day""")
def asof_strict(spark, d):
    o = orders(spark, d).select("o_orderkey", "o_custkey", "day", "o_totalprice")
    return T.asof_join(o, o, ["o_custkey"], "day", "day", ["o_orderkey", "o_totalprice"], tie=["o_orderkey"], prefix="prev_").drop("o_custkey", "day", "o_totalprice")


@register("asof_backward", f"""
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, max(event_id) AS event_id FROM events GROUP BY ALL)
    SELECT o.o_orderkey, e.event_id AS last_event FROM (SELECT o_orderkey, o_custkey, {DAYS} AS day FROM orders) o
    ASOF LEFT JOIN e ON o.o_custkey = e.user_id AND o.day >= e.day""")
def asof_backward(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("o_custkey"), F.to_date("ts").alias("day"), F.col("event_id").alias("last_event"))
    return T.asof_join(orders(spark, d).select("o_orderkey", "o_custkey", "day"), e, ["o_custkey"], "day", "day", ["last_event"], strict=False, tie=["last_event"]).select("o_orderkey", "last_event")


@register("lookback_counts", f"""
    WITH o AS (SELECT o_orderkey, o_custkey, {DAYS} AS day, o_totalprice FROM orders)
    SELECT a.o_orderkey, nullif(count(b.o_orderkey), 0) AS n_before, CASE WHEN count(b.o_orderkey) > 0 THEN count(CASE WHEN b.o_totalprice > 100000 THEN 1 END) END AS n_large
    FROM o a LEFT JOIN o b ON a.o_custkey = b.o_custkey AND b.day < a.day AND b.day >= a.day - 120 GROUP BY a.o_orderkey""")
def lookback_counts(spark, d):
    o = orders(spark, d).select("o_orderkey", "o_custkey", "day")
    r = orders(spark, d).select("o_custkey", F.col("day").alias("r_day"), F.col("o_totalprice"))
    return T.range_agg(o, r, ["o_custkey"], ["o_orderkey"], "day", "r_day", 120, [F.count("*").alias("n_before"), A.count_if(F.col("o_totalprice") > 100000).alias("n_large")]).drop("o_custkey", "day")


BAND = f"""
    WITH o AS (SELECT o_orderkey, o_orderkey % 500 AS k, {DAYS} AS day FROM orders),
    l AS (SELECT l_orderkey * 10 + l_linenumber AS line, l_orderkey % 500 AS k, CAST(l_shipdate AS DATE) AS ship FROM lineitem)
    SELECT o_orderkey, line, CAST(abs(date_diff('day', day, ship)) AS INTEGER) AS day_gap FROM o JOIN l ON o.k = l.k AND abs(date_diff('day', day, ship)) <= 1"""


def _band(spark, d):
    o = orders(spark, d).select("o_orderkey", (F.col("o_orderkey") % 500).alias("k"), "day")
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), (F.col("l_orderkey") % 500).alias("k"), F.to_date("l_shipdate").alias("ship"))
    return o, li


@register("band_all", BAND)
def band_all(spark, d):
    return T.band_join(*_band(spark, d), ["k"], "day", "ship").select("o_orderkey", "line", "day_gap")


@register("band_nearest", f"SELECT * FROM ({BAND}) QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY day_gap, line) = 1")
def band_nearest(spark, d):
    return T.band_nearest(*_band(spark, d), ["k"], ["o_orderkey"], "day", "ship", ["line"]).select("o_orderkey", "line", "day_gap")


@register("pair_history_last5", """
    WITH l AS (SELECT *, l_suppkey % 50 AS a, l_partkey % 50 AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, count(*) OVER w AS h2h_n, round(avg(l_quantity) OVER w, 6) AS h2h_avg FROM l
    WINDOW w AS (PARTITION BY least(a, b), greatest(a, b) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""")
def pair_history_last5(spark, d):
    li = table(spark, d, "lineitem").withColumns({"a": F.col("l_suppkey") % 50, "b": F.col("l_partkey") % 50})
    return T.pair_history(li, "a", "b", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_quantity").select("l_orderkey", "l_linenumber", "h2h_n", F.round("h2h_avg", 6).alias("h2h_avg"))


@register("full_outer_presence", """
    WITH a AS (SELECT c_nationkey AS k, count(*) AS n_cust FROM customer WHERE c_nationkey < 18 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n_supp FROM supplier WHERE s_nationkey > 5 GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, n_cust, n_supp, a.k IS NOT NULL AS in_customer, b.k IS NOT NULL AS in_supplier FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_presence(spark, d):
    a = table(spark, d, "customer").filter("c_nationkey < 18").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_cust"))
    b = table(spark, d, "supplier").filter("s_nationkey > 5").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_supp"))
    return a.join(b, "k", "outer").withColumns({"in_customer": F.col("n_cust").isNotNull(), "in_supplier": F.col("n_supp").isNotNull()})


@register("star_join", """
    SELECT o_orderkey, n_lines, late_qty, n_lines IS NOT NULL AS has_lines, late_qty IS NOT NULL AS has_late FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem WHERE l_linenumber > 2 GROUP BY 1) a ON o_orderkey = a.l_orderkey
    LEFT JOIN (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS late_qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON o_orderkey = b.l_orderkey""")
def star_join(spark, d):
    li = table(spark, d, "lineitem")
    a = li.filter("l_linenumber > 2").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    b = li.filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_quantity").cast("long")).alias("late_qty"))
    o = table(spark, d, "orders").select("o_orderkey")
    return o.join(a, "o_orderkey", "left").join(b, "o_orderkey", "left").withColumns({"has_lines": F.col("n_lines").isNotNull(), "has_late": F.col("late_qty").isNotNull()})


@register("param_cross", f"""
    WITH p AS (SELECT max({DAYS}) AS as_of FROM orders)
    SELECT o_orderpriority, count(*) AS n, CAST(min(date_diff('day', {DAYS}, as_of)) AS INTEGER) AS youngest FROM orders, p WHERE {DAYS} > as_of - 365 GROUP BY 1""")
def param_cross(spark, d):
    o = orders(spark, d)
    p = o.agg(F.max("day").alias("as_of"))
    j = o.crossJoin(F.broadcast(p)).filter(F.col("day") > F.date_sub("as_of", 365))
    return j.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min(F.datediff("as_of", "day")).alias("youngest"))


@register("dense_grid", f"""
    SELECT yr, o_orderpriority, c_mktsegment, n FROM (SELECT DISTINCT CAST(year({DAYS}) AS INTEGER) AS yr, o_orderpriority FROM orders)
    JOIN (SELECT DISTINCT CAST(year({DAYS}) AS INTEGER) AS yr, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey) USING (yr)
    LEFT JOIN (SELECT CAST(year({DAYS}) AS INTEGER) AS yr, o_orderpriority, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) USING (yr, o_orderpriority, c_mktsegment)""")
def dense_grid(spark, d):
    o = orders(spark, d).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.year("day").alias("yr"), "o_orderpriority", "c_mktsegment")
    return T.dense_grid(o, ["yr"], "o_orderpriority", "c_mktsegment").join(o.groupBy("yr", "o_orderpriority", "c_mktsegment").agg(F.count("*").alias("n")), ["yr", "o_orderpriority", "c_mktsegment"], "left")


@register("pair_distance", """
    WITH p AS (SELECT n_nationkey, (n_nationkey * 37) % 170 - 85.0 AS lat, (n_nationkey * 53) % 360 - 180.0 AS lon FROM nation)
    SELECT a.n_nationkey AS n_nationkey_a, b.n_nationkey AS n_nationkey_b,
           round(6371.0 * acos(least(1.0, greatest(-1.0, sin(radians(a.lat)) * sin(radians(b.lat)) + cos(radians(a.lat)) * cos(radians(b.lat)) * cos(radians(b.lon) - radians(a.lon))))), 4) AS km
    FROM p a JOIN p b ON a.n_nationkey < b.n_nationkey ORDER BY km, 1, 2 LIMIT 10""")
def pair_distance(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", ((F.col("n_nationkey") * 37) % 170 - 85.0).alias("lat"), ((F.col("n_nationkey") * 53) % 360 - 180.0).alias("lon"))
    return A.pairwise_nearest(n, "n_nationkey", "lat", "lon").withColumn("km", F.round("km", 4))


@register("nearest_customers", """
    WITH p AS (SELECT c_custkey, (c_custkey * 7919) % 170000 / 1000.0 - 85.0 AS lat, (c_custkey * 104729) % 359000 / 1000.0 - 180.0 AS lon FROM customer)
    SELECT a.c_custkey AS c_custkey_a, b.c_custkey AS c_custkey_b,
           round(6371.0 * acos(least(1.0, greatest(-1.0, sin(radians(a.lat)) * sin(radians(b.lat)) + cos(radians(a.lat)) * cos(radians(b.lat)) * cos(radians(b.lon) - radians(a.lon))))), 4) AS km
    FROM p a JOIN p b ON a.c_custkey < b.c_custkey ORDER BY km, 1, 2 LIMIT 25""")
def nearest_customers(spark, d):
    key = F.col("c_custkey")
    c = table(spark, d, "customer").select("c_custkey", ((key * 7919) % 170000 / 1000.0 - 85.0).alias("lat"), ((key * 104729) % 359000 / 1000.0 - 180.0).alias("lon"))
    return A.pairwise_nearest(c, "c_custkey", "lat", "lon", 25).withColumn("km", F.round("km", 4))


@register("haversine", """
    WITH p AS (SELECT s_suppkey, (s_suppkey * 37) % 170 - 85.0 AS lat, (s_suppkey * 53) % 360 - 180.0 AS lon FROM supplier)
    SELECT s_suppkey, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(48.2) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(48.2)) * pow(sin((radians(16.4) - radians(lon)) / 2), 2)))), 4) AS km FROM p""")
def haversine(spark, d):
    p = table(spark, d, "supplier").select("s_suppkey", ((F.col("s_suppkey") * 37) % 170 - 85.0).alias("lat"), ((F.col("s_suppkey") * 53) % 360 - 180.0).alias("lon"))
    return p.select("s_suppkey", F.round(X.haversine_km("lat", "lon", F.lit(48.2), F.lit(16.4)), 4).alias("km"))


@register("lag_by_year", f"""
    WITH y AS (SELECT o_custkey, CAST(year({DAYS}) AS INTEGER) AS yr, count(*) AS n FROM orders GROUP BY ALL)
    SELECT y.o_custkey, y.yr, y.n, p1.n AS prev1_n, p2.n AS prev2_n FROM y LEFT JOIN y p1 ON y.o_custkey = p1.o_custkey AND p1.yr = y.yr - 1 LEFT JOIN y p2 ON y.o_custkey = p2.o_custkey AND p2.yr = y.yr - 2""")
def lag_by_year(spark, d):
    y = orders(spark, d).groupBy("o_custkey", F.year("day").alias("yr")).agg(F.count("*").alias("n"))
    return T.lag_by_key(T.lag_by_key(y, ["o_custkey"], "yr", ["n"], 1), ["o_custkey"], "yr", ["n"], 2)


@register("two_sided_dim", """
    SELECT o_orderkey, l_linenumber, cn.n_name AS home_name, sn.n_name AS away_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""")
def two_sided_dim(spark, d):
    n = table(spark, d, "nation")
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    home, away = (E.small(n.select(F.col("n_nationkey").alias(f"_{s}"), F.col("n_name").alias(f"{s}_name"))) for s in ("home", "away"))
    return j.join(home, F.col("c_nationkey") == F.col("_home"), "left").join(away, F.col("s_nationkey") == F.col("_away"), "left").select("o_orderkey", "l_linenumber", "home_name", "away_name")


@register("count_known_before", f"""
    WITH o AS (SELECT o_orderkey, o_custkey, {DAYS} AS day FROM orders)
    SELECT a.o_orderkey, count(b.o_orderkey) AS n_known FROM o a LEFT JOIN o b ON a.o_custkey = b.o_custkey AND b.day < a.day GROUP BY a.o_orderkey""")
def count_known_before(spark, d):
    o = orders(spark, d).select("o_orderkey", "o_custkey", "day")
    return T.count_known_before(o, o.select("o_custkey", "day"), ["o_custkey"], "day", "day").select("o_orderkey", F.col("n_known").cast("long").alias("n_known"))


@register("filtered_aggs", """
    SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS n_disc, round(sum(l_extendedprice) FILTER (WHERE l_quantity < 10), 2) AS small_price,
           count(DISTINCT l_suppkey) FILTER (WHERE l_tax > 0.02) AS n_supp, bool_or(l_quantity > 49) AS any_full, round(min(l_discount), 4) AS lo, round(max(l_discount), 4) AS hi
    FROM lineitem GROUP BY 1""")
def filtered_aggs(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), A.count_if(F.col("l_discount") > 0.05).alias("n_disc"), F.round(A.sum_if(F.col("l_quantity") < 10, "l_extendedprice"), 2).alias("small_price"),
        F.count_distinct(F.when(F.col("l_tax") > 0.02, F.col("l_suppkey"))).alias("n_supp"), F.bool_or(F.col("l_quantity") > 49).alias("any_full"), F.round(F.min("l_discount"), 4).alias("lo"), F.round(F.max("l_discount"), 4).alias("hi"))


@register("survivorship", """
    WITH s AS (SELECT l_partkey AS k, l_linenumber AS prio, CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey END AS supp, CASE WHEN l_quantity > 20 THEN l_returnflag END AS flag FROM lineitem)
    SELECT k, min((prio, supp)) FILTER (WHERE supp IS NOT NULL)[2] AS supp, min((prio, flag)) FILTER (WHERE flag IS NOT NULL)[2] AS flag FROM s GROUP BY k""".replace("min((prio, supp)) FILTER (WHERE supp IS NOT NULL)[2]", "arg_min(supp, (prio, supp)) FILTER (WHERE supp IS NOT NULL)").replace("min((prio, flag)) FILTER (WHERE flag IS NOT NULL)[2]", "arg_min(flag, (prio, flag)) FILTER (WHERE flag IS NOT NULL)"))
def survivorship(spark, d):
    s = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_linenumber").alias("prio"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("supp"), F.when(F.col("l_quantity") > 20, F.col("l_returnflag")).alias("flag"))
    return E.survive(s, ["k"], "prio", ["supp", "flag"])


@register("source_ids", """
    SELECT l_partkey, max(l_suppkey) FILTER (WHERE l_returnflag = 'A') AS A_id, max(l_suppkey) FILTER (WHERE l_returnflag = 'R') AS R_id FROM lineitem GROUP BY 1""")
def source_ids(spark, d):
    return E.source_ids(table(spark, d, "lineitem"), ["l_partkey"], "l_returnflag", "l_suppkey", ["A", "R"])


@register("ratio_of_sums", """
    SELECT l_suppkey, round(sum(l_quantity) FILTER (WHERE l_discount > 0) / nullif(sum(l_extendedprice) FILTER (WHERE l_discount > 0), 0) * 1000, 6) AS qty_per_price, count(CASE WHEN l_discount > 0 THEN 1 END) AS n_pairs FROM lineitem GROUP BY 1""")
def ratio_of_sums(spark, d):
    li = table(spark, d, "lineitem").withColumn("p", F.when(F.col("l_discount") > 0, F.col("l_extendedprice")))
    return li.groupBy("l_suppkey").agg(F.round(A.ratio_of_sums("l_quantity", "p") * 1000, 6).alias("qty_per_price"), F.count("p").alias("n_pairs"))


@register("sides_rollup", """
    SELECT l_suppkey, count(*) AS total_rows, CAST(sum(q) AS BIGINT) AS total_q, count(*) FILTER (WHERE l_linestatus = 'O') AS open_rows, CAST(sum(q) FILTER (WHERE l_linestatus = 'O') AS BIGINT) AS open_q,
           count(*) FILTER (WHERE l_linestatus = 'F') AS done_rows, CAST(sum(q) FILTER (WHERE l_linestatus = 'F') AS BIGINT) AS done_q FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY 1""")
def sides_rollup(spark, d):
    return A.rollup_sides(table(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("long")), ["l_suppkey"], "l_linestatus", ["q"], {"O": "open", "F": "done"})


@register("pivot_status", """
    SELECT o_custkey, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS F, max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS O, max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def pivot_status(spark, d):
    return R.pivot_kind(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus", ["F", "O", "P"], ["o_totalprice"])


@register("pivot_stats", """
    SELECT user_id, max(v) FILTER (WHERE event_type = (SELECT min(event_type) FROM events)) AS first_type_value, count(DISTINCT event_type) AS n_types FROM (SELECT *, round(value, 4) AS v FROM events) GROUP BY 1""")
def pivot_stats(spark, d):
    e = table(spark, d, "events")
    lowest = e.agg(F.min("event_type").alias("m"))
    j = e.crossJoin(F.broadcast(lowest))
    return j.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == F.col("m"), F.round("value", 4))).alias("first_type_value"), F.count_distinct("event_type").alias("n_types"))


@register("unpivot_prices", """
    SELECT p_partkey, source, amount FROM (SELECT p_partkey, 'retail' AS source, p_retailprice AS amount FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS DOUBLE) FROM part) WHERE amount IS NOT NULL""")
def unpivot_prices(spark, d):
    p = table(spark, d, "part").withColumn("size_d", F.col("p_size").cast("double"))
    return R.unpivot_groups(p, ["p_partkey"], {"retail": {"amount": "p_retailprice"}, "size": {"amount": "size_d"}})


@register("pivot_outcomes", """
    SELECT l_orderkey, max(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS home, max(l_extendedprice) FILTER (WHERE l_returnflag = 'N') AS draw, max(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS away FROM lineitem GROUP BY 1""")
def pivot_outcomes(spark, d):
    return R.pivot_outcomes(table(spark, d, "lineitem"), ["l_orderkey"], X.lookup("l_returnflag", {"A": "home", "N": "draw", "R": "away"}), "l_extendedprice")


@register("ordered_list", """
    SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_size)), ',') AS sizes FROM part GROUP BY 1""")
def ordered_list(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.array_join(R.ordered_list("p_size").cast("array<string>"), ",").alias("sizes"))


@register("league_table", """
    WITH m AS (SELECT o_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_suppkey % 20 END) AS h, max(CASE WHEN l_linenumber = 2 THEN l_suppkey % 20 END) AS a,
                      max(CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) % 5 END) AS hg, max(CASE WHEN l_linenumber = 2 THEN CAST(l_quantity AS BIGINT) % 5 END) AS ag, o_orderpriority
               FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderpriority),
    s AS (SELECT o_orderpriority AS league, h AS team, hg AS gf, ag AS ga FROM m UNION ALL SELECT o_orderpriority, a, ag, hg FROM m)
    SELECT league, team, count(*) AS played, count(*) FILTER (WHERE gf > ga) AS won, count(*) FILTER (WHERE gf = ga) AS drawn, count(*) FILTER (WHERE gf < ga) AS lost,
           CAST(sum(gf) AS BIGINT) AS goals_for, CAST(sum(ga) AS BIGINT) AS goals_against, CAST(sum(gf - ga) AS BIGINT) AS goal_difference, CAST(sum(CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END) AS BIGINT) AS points
    FROM s WHERE gf IS NOT NULL AND ga IS NOT NULL GROUP BY ALL""")
def league_table(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    pick = lambda n, c: F.max(F.when(F.col("l_linenumber") == n, c))
    team, goals = F.col("l_suppkey") % 20, F.col("l_quantity").cast("long") % 5
    m = j.groupBy("o_orderkey", F.col("o_orderpriority").alias("league")).agg(pick(1, team).alias("h"), pick(2, team).alias("a"), pick(1, goals).alias("hg"), pick(2, goals).alias("ag"))
    c = F.col
    s = R.two_sides(m, {"team": c("h"), "goals_for": c("hg"), "goals_against": c("ag")}, {"team": c("a"), "goals_for": c("ag"), "goals_against": c("hg")}, ["league"])
    return A.league_table(s, ["league"], "team")
