import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.operators import aggregates as A
from tarn.operators import mlops as M
from tarn.operators import quality as Q
from tarn.operators import resolve as E
from tarn.operators import snapshot as S
from tarn.operators import temporal as T
from tarn.operators import text as TX
from tarn.plans import features

DAY = dt.date(2026, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_names_dates_and_numbers(spark):
    assert one(spark, X.name_norm(F.lit("  Søren Müller-Đoković 3")), X.name_norm(F.lit("Søren"), ascii_only=True)) == ("s ren muller okovic", "sren")
    assert one(spark, X.season_label(X.season_of(F.lit("2026-07-01").cast("date"))), X.season_code(X.season_of(F.lit("2026-06-30").cast("date")))) == ("2026/27", "2526")
    assert one(spark, X.parse_day_first(F.lit("03/02/26")).cast("string"), X.parse_day_first(F.lit("x")), X.parse_compact(F.lit("2026020300")).cast("string")) == ("2026-02-03", None, "2026-02-03")
    assert str(one(spark, X.parse_rfc822(F.lit("Mon, 3 Feb 2026 01:02:03 +0000")))[0]) == "2026-02-03 01:02:03"
    assert one(spark, X.to_number(F.lit("45 %")), X.to_number(F.lit("180cm")), X.to_number(F.lit("a"))) == (45.0, 180.0, None)
    assert one(spark, X.form_points_rate(F.lit("WDL")), X.form_points_rate(F.lit(""))) == (pytest.approx(4 / 9), None)
    assert one(spark, X.clean_text(F.lit("<b>a</b>  &amp; http://x.y/z b"))) == ("a & b",)
    assert one(spark, X.guess_language(F.lit("der Ball und das Tor"), {"fr": "ç"}, {"de": ["der", "und", "das"]})) == ("de",)
    assert one(spark, *[c for c in X.softmax(F.lit(0.0), F.lit(0.0))]) == (0.5, 0.5)
    assert one(spark, X.timeline_bucket(F.lit("2026-01-09").cast("date"), F.lit("2026-01-01").cast("date")), X.prob_summary(F.lit(0.5), F.lit(0.3), F.lit(0.2))) == ("later", "H 50.0% | D 30.0% | A 20.0%")
    assert one(spark, X.great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))[0] == pytest.approx(20015.08, 0.01)
    assert one(spark, X.n_distinct_in_row(F.lit("a"), F.lit(None).cast("string"), F.lit("b")), X.implied_prob([F.lit(2.0), F.lit(1.0), F.lit(3.0)], 0)) == (2, None)


def brute_asof(left, right, strict):
    out = {}
    for i, k, t in left:
        seen = [(rt, v) for rk, rt, v in right if rk == k and k is not None and rt is not None and t is not None and (rt < t if strict else rt <= t)]
        out[i] = max(seen)[1] if seen else None
    return out


def test_asof_on_a_hot_key_cuts_its_line(spark):
    """Half of all rows have one key and a tenth one instant; no window partition may hold a large share."""
    n = 20_000
    hot = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    when = F.when(F.col("id") % 10 == 0, F.lit(777_000)).otherwise(F.pmod(F.xxhash64("id"), F.lit(3_000_000)))
    base = spark.range(n).select("id", hot.alias("k"), F.timestamp_seconds(when).alias("t"), F.col("id").cast("string").alias("k2"))
    left, right = base.filter("id % 3 = 0"), base.filter("id % 3 <> 0").select("k", F.col("t").alias("rt"), F.col("id").alias("v"))
    how = {"by": ["k"], "left_ts": "t", "right_ts": "rt", "values": ["v"], "strict": True, "tie": ["v"]}
    assert sorted(T.asof_join(left, right, **how, cut=True).collect()) == sorted(T.asof_join(left, right, **how, cut=False).collect())
    line = T.cut_lines(left, right, **how, backward=True, width=None)
    assert line.groupBy("k", "_range").count().agg(F.max("count")).first()[0] < n / 40
    assert line.filter("k = 'hot'").count() > n / 3
    answered = T.asof_join(left, right, **how, cut=True)
    assert answered.filter("v is not null").count() > n / 4
    with pytest.raises(ValueError):
        T.asof_join(left.withColumn("t", F.lit(1)), right.withColumn("rt", F.lit(1)), **how, cut=True)
    dates = [x.select("*", F.to_date(c).alias("d")) for x, c in ((left, "t"), (right, "rt"))]
    both = [T.asof_join(*dates, ["k"], "d", "d", ["v"], tie=["v"], cut=c).select("id", "v").collect() for c in (True, False)]
    assert sorted(map(str, both[0])) == sorted(map(str, both[1]))


@pytest.mark.parametrize("strict", [True, False])
def test_asof_by_brute_force(spark, strict):
    rng = random.Random(4)
    left = [(i, rng.choice(["a", "b", None]), rng.choice([*range(10), None])) for i in range(80)]
    right = [(rng.choice(["a", "b", None]), rng.choice([*range(10), None]), v) for v in range(60)]
    a, b = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, t int, v int")
    got = {r.i: r.v for r in T.asof_join(a, b, ["k"], "t", "t", ["v"], strict=strict, tie=["v"]).collect()}
    assert got == brute_asof(left, right, strict)
    for width in (1, 3, 100):
        cut = T.asof_join(a, b, ["k"], "t", "t", ["v"], strict=strict, tie=["v"], cut=True, width=width)
        assert cut.columns == ["i", "k", "t", "v"] and {r.i: r.v for r in cut.collect()} == got
    ahead = [T.asof_join(a, b, ["k"], "t", "t", ["v"], strict=strict, tie=["v"], direction="forward", prefix="n_", cut=c, width=2).collect() for c in (True, False)]
    assert sorted(map(str, ahead[0])) == sorted(map(str, ahead[1]))
    later = b.union(spark.createDataFrame([("a", 100, 999)], b.schema))
    assert {r.i: r.v for r in T.asof_join(a, later, ["k"], "t", "t", ["v"], strict=strict, tie=["v"]).collect()} == got


def most_rows(df):
    """The most rows that any node of the executed plan puts out."""
    df.collect()
    nodes, most = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        n = nodes.pop()
        kind, m, kids = n.getClass().getSimpleName(), n.metrics().get("numOutputRows"), n.children()
        most = max(most, m.get().value()) if m.isDefined() else most
        nodes += [n.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [n.plan()] if kind.endswith("QueryStageExec") else [kids.apply(i) for i in range(kids.size())]
    return most


def matches_of(spark, n, teams, days, seed):
    rng = random.Random(seed)
    rows = [(i, day(rng.randrange(days)), *(rng.choice(teams) for _ in range(2))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "match_id int, match_date date, home string, away string")


def test_injuries_by_brute_force(spark):
    """Gaps, repeated rows and days, unknown players, teams, days and values."""
    rng = random.Random(11)
    rows, m = matches_of(spark, 150, ["a", "b", "c", None], 90, 12)
    hurt = [(rng.choice(["a", "b", None]), rng.choice([*range(6), None]), rng.choice([day(rng.randrange(90)), day(30), None]), rng.choice([0.25, 0.5, None])) for _ in range(120)]
    got = {r.match_id: (r.home_injured, r.home_missing_xg, r.away_injured, r.away_missing_xg) for r in features.injury_load(m, spark.createDataFrame(hurt, "team string, player int, day date, xg double")).collect()}
    for i, d, *teams in rows:
        want = []
        for t in teams:
            near = {x for x in hurt if t and x[0] == t and x[2] and 0 < (d - x[2]).days <= 14}
            xg = [x[3] for x in near if x[3] is not None]
            want += [len({x[1] for x in near} - {None}), sum(xg) if xg else None]
        assert got[i] == tuple(want)


def test_injuries_of_a_team_do_not_meet_each_match(spark):
    _, m = matches_of(spark, 500, ["a"], 40, 13)
    hurt = spark.range(3000).select(F.lit("a").alias("team"), (F.col("id") % 700).alias("player"), F.date_add(F.lit(DAY), (F.col("id") % 40).cast("int")).alias("day"), F.lit(0.5).alias("xg"))
    assert most_rows(features.injury_load(m, hurt)) <= 3 * 3000


def test_comments_are_summed_by_day(spark):
    """As by brute force; a team's comments do not meet each of its matches."""
    rng = random.Random(14)
    rows, m = matches_of(spark, 300, ["a", "b", None], 40, 15)
    said = [(rng.choice("aaab"), day(rng.randrange(30)), rng.choice(["a good win", "a bad day", "good or bad", None])) for _ in range(2000)]
    f = features.comment_sentiment(m, spark.createDataFrame(said, "team string, day date, text string"), ["good", "win"], ["bad"])
    got = {r.match_id: (r.home_sentiment, r.home_comments, r.away_sentiment, r.away_comments) for r in f.collect()}
    score = {"a good win": 1, "a bad day": -1, "good or bad": 0, None: 0}
    for i, d, *teams in rows:
        near = [[score[x] for t, e, x in said if t == team and 0 < (d - e).days <= 7] for team in teams]
        assert got[i] == tuple(v for s in near for v in ((sum(s) / len(s), len(s)) if s else (None, None)))
    assert most_rows(f) <= 2000


@pytest.mark.parametrize(("extra", "tol"), [(False, 1), (True, 2)])
def test_nearest_of_a_band_by_brute_force(spark, extra, tol):
    """Ties, unknown keys, days and tie values, ids that repeat; no row meets all rows of its days."""
    rng = random.Random(16)
    left = [(rng.randrange(380), rng.choice(["a", "a", "b", None]), rng.choice([day(rng.randrange(20)), None])) for _ in range(400)]
    right = [(rng.choice(["a", "a", "c", None]), rng.choice([day(2 * rng.randrange(10)), None]), rng.choice([rng.randrange(900), None]), str(i)) for i in range(2000)]
    right += [("b", day(5), None, "x"), ("b", day(9), None, "y"), ("b", day(9), 3, "z")]
    b = spark.createDataFrame(right, "k string, e date, v int, s string")
    f = T.band_nearest(spark.createDataFrame(left, "i int, k string, d date"), b if extra else b.drop("s"), ["k"], ["i"], "d", "e", ["v", "s"] if extra else ["v"], tol)
    want = {}
    for i, k, d in left:
        for q, e, v, s in right:
            if k and k == q and d and e and abs((d - e).days) <= tol:
                hit = (abs((d - e).days), v is None, v or 0, s if extra else "")
                want[i] = min(want.get(i, hit), hit)
    got = {r.i: (r.day_gap, r.v is None, r.v or 0, r.s if extra else "") for r in f.collect()}
    assert got == want and f.columns == ["k", "i", "d", "e", "v", *(["s"] if extra else []), "day_gap"]
    assert f.count() == len(want) and most_rows(f) <= len(right)


def test_range_and_band_by_brute_force(spark):
    rng = random.Random(5)
    left, right = [(i, rng.choice("ab"), day(rng.randrange(60))) for i in range(40)], [(rng.choice("ab"), day(rng.randrange(60)), rng.randrange(9)) for _ in range(120)]
    a, b = spark.createDataFrame(left, "i int, k string, d date"), spark.createDataFrame(right, "k string, e date, v int")
    got = {r.i: r.s for r in T.range_agg(a, b, ["k"], ["i"], "d", "e", 7, [F.sum("v").alias("s")]).collect()}
    for i, k, d in left:
        vs = [v for q, e, v in right if q == k and 0 < (d - e).days <= 7]
        assert got[i] == (sum(vs) if vs else None)
    pairs = T.band_join(a, b, ["k"], "d", "e", 1).count()
    assert pairs == sum(k == q and abs((d - e).days) <= 1 for _, k, d in left for q, e, _ in right)


def test_training_window_and_violations(spark):
    w = T.training_window(spark, "2026-06-30", 2, 2).first()
    assert [str(w[c]) for c in ("training_train_end", "training_valid_start", "training_valid_end", "training_test_start")] == ["2026-02-28", "2026-03-01", "2026-04-30", "2026-05-01"]
    rows = [(i, day(i * 3), i % 3) for i in range(60)]
    f = spark.createDataFrame(rows, "k int, d date, y int")
    snap = T.training_snapshot(f, T.training_window(spark, "2026-06-30", 2, 2), "d", "y", "d", 23)
    assert {r.split for r in snap.select("split").distinct().collect()} == {"train", "valid", "test"}
    assert Q.snapshot_violations(snap, "k", "d", "y").count() == 0
    bad = lambda df: {r.violation for r in Q.snapshot_violations(df, "k", "d", "y").collect()}
    assert bad(snap.withColumn("split", F.lit("train"))) >= {"wrong_split", "empty_split"}
    assert bad(snap.union(snap.limit(1))) == {"duplicate_key"} and bad(snap.filter("split <> 'train' or y > 0")) == {"class_missing_in_train"}
    assert bad(snap.withColumn("training_label_known_ts", F.col("training_label_cutoff_ts"))) == {"late_label"}


def test_resolution(spark):
    seed = spark.createDataFrame([("s", " Foo FC ", "Foo"), ("s", "none", "N/A"), ("s", "x", "Bar"), ("t", "x", "Baz")], "source string, alias string, team_key string")
    a = E.alias_dictionary(seed, ["N/A"])
    assert {tuple(r) for r in a.collect()} == {("foo fc", "Foo"), ("foo", "Foo"), ("x", "Bar"), ("x", "Baz"), ("bar", "Bar"), ("baz", "Baz")}
    assert [r.alias for r in E.ambiguous_aliases(a).collect()] == ["x"]
    s = spark.createDataFrame([("k", 1, None), ("k", 2, "two"), ("k", 3, "three")], "k string, p int, v string")
    assert E.survive(s, ["k"], "p", ["v"]).first().v == "two"
    u = spark.createDataFrame([("u1", "n", "l", "t"), ("u2", "z", "l2", "t2"), ("u3", "q", "q", "q")], "id string, n string, l string, t string")
    r = spark.createDataFrame([("p1", "n", "x", "x"), ("p2", "y", "l2", "t2"), ("p3", "y", "l2", "t2")], "pid string, n string, l string, t string")
    assert [tuple(x) for x in E.link_unique(u, r, "id", "pid", [(["n"], ["n"]), (["l", "t"], ["l", "t"])]).collect()] == [("u1", "p1")]


def test_upserts_and_orphans(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "id int, v string, seen int")
    s = spark.createDataFrame([(1, "a", 2), (2, "B", 2), (4, None, 2)], "id int, v string, seen int")
    d = S.upsert_diff(t, s, ["id"], ["seen"])
    assert {r.id: r.action for r in d.collect()} == {1: "unchanged", 2: "update", 4: "insert"}
    after = S.apply_upsert(t, d, ["id"])
    assert {r.id: r.v for r in after.collect()} == {1: "a", 2: "B", 3: "c", 4: None}
    assert S.upsert_diff(after, s, ["id"], ["seen"]).filter("action <> 'unchanged'").count() == 0
    assert {r.id for r in S.orphans(t, s, ["id"], full=True).collect()} == {3} and S.orphans(t, s.filter("false"), ["id"], full=True).count() == 0


def test_trend_alerts(spark):
    rows = [(f"{n}-{i}", day(n), "news", int(i % 12 not in range(9 if n >= 7 else 2)), "negative" if i % 12 in range(9 if n >= 7 else 2) else "neutral") for n in range(14) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id string, event_date date, source_type string, topic_id int, sentiment_label string")
    assert df.count() == 168
    _, alerts = TX.topic_alerts(df, ["topic_id"], "event_date", 7, 5, 1.25, 0.4)
    assert [r.topic_id for r in alerts.collect()] == [0]


def test_entities_and_documents(spark):
    alias = spark.createDataFrame([("Real", "R"), ("Real Madrid", "R"), ("C.F. X", "X"), ("ab", "A")], "alias string, team_key string")
    d = spark.createDataFrame([(1, "Real Madrid beat C.F. X; real!"), (2, "surreal ab")], "i int, t string")
    assert {(r.i, r.entity, r.n_mentions) for r in TX.mentions(d, alias, "t", ["i"], key="team_key").collect()} == {(1, "R", 2), (1, "X", 1)}
    src = spark.createDataFrame([("a", "T", "<b>B</b>", dt.datetime(2026, 1, 1)), ("a", "T2", "C", dt.datetime(2026, 1, 2)), (None, "x", "y", dt.datetime(2026, 1, 1))], "id string, t string, b string, p timestamp")
    n = TX.normalise({"news": (src, {"doc_id": F.col("id"), "title": F.col("t"), "body": F.col("b"), "published_at": F.col("p")})})
    (r,) = TX.drop_invalid(n).collect()
    assert (r.title, r.text_clean, r.source_type) == ("T2", "T2 C", "news")


def test_rules_and_grain(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "k int, v string")
    r = {x.rule: x.n_violations for x in Q.report(df, [Q.unique("k"), Q.not_null("v"), Q.accepted_values("v", ["a"]), Q.expression("e", F.col("v") == "a")]).collect()}
    assert r == {"unique(k)": 1, "not_null(v)": 1, "accepted_values(v)": 1, "e": 1}
    with pytest.raises(ValueError):
        Q.enforce(df, [Q.unique("k")])
    assert Q.enforce(df, [Q.expression("w", F.col("k") < 2, "warn")]) == ["w"]
    with pytest.raises(ValueError):
        Q.assert_grain(df, ["k"])
    h = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), ("2", "c")], "s string, c string")
    assert {tuple(x) for x in Q.schema_drift(h, "s", "c").select("s", "c", "change").collect()} == {("2", "c", "added"), ("2", "b", "removed")}
    assert Q.fingerprint(df).first() == Q.fingerprint(df.orderBy(F.desc("k")).repartition(3)).first()
    assert A.corr_tripwire(spark.range(600).select(F.col("id").alias("x"), (F.col("id") * 2).alias("y"), F.lit(1).alias("c")), ["x", "c"], "y").collect()[0].feature == "x"


def test_models_and_metrics(spark):
    rng = random.Random(2)
    rows = [(i, float(c * 2 + rng.random()), rng.random(), "ADH"[c]) for i in range(240) for c in [i % 3]]
    df = spark.createDataFrame(rows, "match_key int, a double, b double, y string")
    m = M.train_multiclass(df, ["a", "b"], "y", weights={"D": 1.5})
    p = M.with_decision(M.score(m, df, ["match_key", "y"], "y").withColumnsRenamed({"p_H": "p_home", "p_D": "p_draw", "p_A": "p_away"}), "y")
    assert p.agg(F.avg("is_correct")).first()[0] > 0.8
    o = M.overall_metrics(p, "y", "predicted_result").first()
    assert o.accuracy == pytest.approx(p.agg(F.avg("is_correct")).first()[0]) and 0 < o.mcc <= 1
    c = M.contributions(m, df, ["a", "b"], ["match_key"], "y", "H")
    assert M.top_contributors(c, ["match_key"], "feature_name", "impact").count() == 240
    assert M.log_loss(p, "y", {"H": "p_home", "D": "p_draw", "A": "p_away"}).first()[0] < 1
    r = M.rule_scores(spark.range(1), F.lit(9.0), F.lit(-9.0)).first()
    assert r.p_home + r.p_draw + r.p_away == pytest.approx(1) and r.p_draw == pytest.approx(0.08 / 0.98)
    f = df.withColumns({"split": F.lit("train"), "n": F.lit(None).cast("double"), "k": F.lit(1.0)})
    assert M.select_features(f, ["a", "n", "k"]) == ["a"]


def test_sentiment_model_reads_whole_texts(spark):
    opening = "0123456789 " * 60  # 660 characters that say nothing
    good, bad = "lovely splendid wonderful ", "dreadful horrible rotten "
    rows = [(i, opening + (good if i % 2 else bad) * 3, "good" if i % 2 else "bad") for i in range(80)]
    df = spark.createDataFrame([*rows, (100, opening + good, None), (101, opening + bad, None), (102, "", None)], "doc_id long, text string, label string")
    for most in (1000, 40):
        model = TX.fit_sentiment(df, "doc_id", "text", "label", most_labelled=most)
        got = {r.doc_id: r.prediction for r in TX.score_sentiment(model, df, ["doc_id"], "text").collect()}
        assert len(got) == 83 and all(got[i] == i % 2 for i in range(80)) and got[100] == 1 and got[101] == 0
    assert TX.trigram_counts("Naïve👍", 1 << 14).sum() == 4 and TX.trigram_counts("ab", 64).sum() == 0


def plain_mentions(docs, alias, least=4):
    """Every entity's regular expression over every document."""
    by = {}
    for a, e in alias:
        if a and e and len(a.strip()) >= least:
            by.setdefault(e, set()).add(a.strip().lower())
    out = []
    for i, t in docs:
        for e, names in by.items():
            n = len(re.findall(r"(?<!\w)(?:" + "|".join(re.escape(a) for a in sorted(names, key=lambda a: (-len(a), a))) + r")(?!\w)", (t or "").lower()))
            out += [(i, e, n)] if n else []
    return sorted(out)


def test_automaton_finds_what_the_patterns_find(spark):
    rng = random.Random(5)
    parts = ["real", "real madrid", "madrid", "c.f. x", "é", "atlético", "_", " ", " ", "-", "X", "a+b(c)", "inter", "inter milan", "milan ac", "", "\n"]
    docs = [(i // 2, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(300)] + [(7, None), (8, ""), (9, "real " * 4000), (9, "real " * 4000)]
    alias = [(a, e) for a in [*parts, " Real Madrid ", "real madrid c.f. x", "ab", None, "tico", "x-real"] for e in ("R", "S", "T", None) if rng.random() < 0.6] + [("inter", "R"), ("inter milan", "R"), ("milan ac", "R")]
    d, a = spark.createDataFrame(docs, "i int, t string"), spark.createDataFrame(alias, "alias string, entity string")
    want = plain_mentions(docs, alias)
    assert len(want) > 100
    for shard_names in (1_000_000, 4):
        assert sorted(map(tuple, TX.mentions(d, a, "t", ["i"], shard_names=shard_names).collect())) == want
    longest = sorted((i, min(((-len(n), n) for n in {x for x, _ in alias if x} if n in (t or "")), default=None)) for i, t in dict(docs).items())
    unique = spark.createDataFrame([(i, t) for i, t in dict(docs).items()], "i int, t string")
    for shard_names in (1_000_000, 4):
        got = TX.contains_mentions(unique, a, "t", "alias", ["i"], shard_names=shard_names).collect()
        assert sorted((r.i, r.alias) for r in got) == [(i, b[1]) for i, b in longest if b]
    assert TX.mentions(d, a.limit(0), "t", ["i"]).count() == TX.mentions(d.limit(0), a, "t", ["i"]).count() == 0


def test_a_hundred_thousand_aliases(spark):
    a = spark.range(100_000).select(F.concat(F.lit("name "), "id").alias("alias"), (F.col("id") % 1000).cast("string").alias("entity"))
    d = spark.createDataFrame([(1, "Name 7, name 1007 and name 99999x, name 77777"), (2, "name 100000")], "i int, t string")
    assert sorted(map(tuple, TX.mentions(d, a, "t", ["i"]).collect())) == [(1, "7", 2), (1, "777", 1)]


def plain_nearest(rows, n):
    rad = [(i, math.radians(a), math.radians(b)) for i, a, b in rows if None not in (i, a, b)]
    km = lambda p, q: 6371.0 * math.acos(max(-1.0, min(1.0, math.sin(p[1]) * math.sin(q[1]) + math.cos(p[1]) * math.cos(q[1]) * math.cos(q[2] - p[2]))))
    return sorted((km(p, q), p[0], q[0]) for p in rad for q in rad if p[0] < q[0])[:n]


@pytest.mark.parametrize("kind", ["spread", "cluster", "copies", "few", "poles"])
def test_nearest_pairs_are_exact(spark, kind):
    rng = random.Random(kind)
    wide = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(250)]
    rows = {
        "spread": wide,
        "cluster": wide[:50] + [(1000 + i, 48 + rng.random() * 1e-3, 16 + rng.random() * 1e-3) for i in range(250)],
        "copies": wide + [(1000 + i, 10.0, 20.0) for i in range(60)] + [(2000 + i, 10.0, 20.001) for i in range(60)] + [(None, 1.0, 1.0), (1, None, 1.0)],
        "few": [(1, 0.0, 0.0), (2, 0.0, 180.0), (3, 90.0, 0.0)],
        "poles": [(i, rng.choice([-1, 1]) * (90 - rng.random() * 0.01), rng.uniform(-180, 180)) for i in range(150)] + [(500 + i, rng.uniform(-1, 1), rng.choice([-180, 180]) * (1 - rng.random() * 1e-4)) for i in range(100)],
    }[kind]
    df = spark.createDataFrame(rows, "id int, la double, lo double")
    for n in (1, 20):
        got, want = A.pairwise_nearest(df, "id", "la", "lo", n).collect(), plain_nearest(rows, n)
        assert [r.km for r in got] == pytest.approx([w[0] for w in want], abs=1e-6)
        if kind != "poles":  # there distances of close points tie within the arc cosine's precision
            assert [(r.id_a, r.id_b) for r in got] == [w[1:] for w in want]


def test_nearest_pairs_of_a_dense_place(spark):
    """A third of all places lie in a ten-thousandth of the area."""
    third = F.when(F.col("id") % 3 == 0, F.lit(0.001)).otherwise(F.lit(1.0))
    df = spark.range(20_000).select("id", (third * F.rand(1) * 80).alias("la"), (third * F.rand(2) * 170).alias("lo"))
    got = A.pairwise_nearest(df, "id", "la", "lo", 10)
    rows = {r.id: (r.la, r.lo) for r in df.collect()}
    cells = {}
    for i, (la, lo) in rows.items():  # any two within 20 m share or touch such a cell
        cells.setdefault((int(la / 0.0002), int(lo / 0.0002)), []).append((i, la, lo))
    near = [x for (a, b), c in cells.items() for x in plain_nearest(c + [p for da, db in ((0, 1), (1, -1), (1, 0), (1, 1)) for p in cells.get((a + da, b + db), [])], 10)]
    assert [r.km for r in got.collect()] == pytest.approx([k for k, _, _ in sorted(set(near))[:10]], abs=1e-6)


def test_positions_by_a_sweep_equal_the_grid(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["g", "h", None]), rng.choice("abcdefgh"), day(rng.randint(0, 40)), rng.randint(0, 3), rng.randint(-4, 4), "x") for _ in range(500)] + [("g", None, day(1), 3, 1, "x"), ("g", "a", None, 3, 1, "x"), ("g", "z", day(3), None, None, "x")]
    df = spark.createDataFrame(rows, "grp string, team string, d date, pts int, gd int, position string")
    whole = df.filter("grp is not null and team is not null and d is not null")
    grid = {tuple(r) for r in T.rank_before(whole, ["grp"], "team", "d", "pts", ["gd"], 3).select("grp", "team", "d", "pts_before", "gd_before", "position", "is_top").collect()}
    every = T.dense_grid(whole, ["grp"], "d", "team")
    pick = ["grp", "team", "d", "pts_before", "gd_before", "position", "is_top"]
    assert {tuple(r) for r in T.rank_before(df, ["grp"], "team", "d", "pts", ["gd"], 3, asked=every).select(*pick).collect()} == grid
    some = every.filter("day(d) % 3 = 0 and team < 'd'")
    wanted = {g for g in grid if g[2].day % 3 == 0 and g[1] < "d"}
    assert {tuple(r) for r in T.rank_before(df, ["grp"], "team", "d", "pts", ["gd"], 3, asked=some.union(some)).select(*pick).collect()} == wanted
    new = spark.createDataFrame([("g", "newcomer", day(100))], "grp string, team string, d date")
    assert T.rank_before(df, ["grp"], "team", "d", "pts", ["gd"], 3, asked=new).first()["pts_before"] == 0
    assert T.rank_before(df.limit(0), ["grp"], "team", "d", "pts", ["gd"], 3, asked=new.limit(0)).count() == 0


def test_quantiles_by_refined_ranges_are_exact(spark):
    rng = np.random.default_rng(2)
    kinds = {"a": rng.lognormal(0, 4, 3000), "b": rng.integers(0, 3, 2000) * 1.0, "c": np.full(900, 7.5), "d": np.r_[rng.normal(0, 1e-9, 500), 1e15, -1e300], "e": [1.0], None: rng.random(400)}
    rows = [(k, float(x)) for k, v in kinds.items() for x in v] + [("a", None), ("a", float("nan")), ("f", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    at = [0.0, 0.1, 0.5, 0.93, 1.0]
    for options in ({}, {"enough": 100, "bins": 512}):
        got = {r.k: list(r[1:]) for r in A.exact_quantiles(df, ["k"], "v", at, **options).collect()}
        assert got.keys() == kinds.keys()
        for k, v in kinds.items():
            assert got[k] == pytest.approx(np.quantile(np.array(v), at).tolist(), rel=1e-9, abs=1e-20)
    whole = [x for v in kinds.values() for x in v]
    assert list(A.exact_quantiles(df, [], "v", at, enough=500, bins=512).first()) == pytest.approx(np.quantile(whole, at).tolist(), rel=1e-9)
    assert A.exact_quantiles(df.limit(0), ["k"], "v", at).count() == 0
    daily = df.filter("k in ('a', 'b')").withColumn("w", F.col("v") * 2)
    few, many = (sorted(map(str, TX.anomaly_scores(daily, ["k"], ["v", "w"], enough=e).select("k", "v", F.round("anomaly_score", 9)).collect())) for e in (1_000_000, 100))
    assert few == many


def test_topics_read_each_text_twice(spark):
    """Three planted topics are found, and the number of candidates does not multiply the passes over the texts."""
    rng, n = random.Random(18), 120
    words = ["goal match team ball".split(), "bank rate stock fund".split(), "rain wind snow sun".split()]
    rows = [(i, " ".join(rng.choices(words[i % 3], k=12))) for i in range(n)]
    reads = spark.sparkContext.accumulator(0)

    def seen(t):
        reads.add(1)
        return t

    df = spark.createDataFrame(rows, "doc_id int, raw string").select("doc_id", F.udf(seen)("raw").alias("text"))
    model, k = TX.fit_topics(df, "text", [2, 3, 4])
    assert k == 3 and reads.value <= 2 * n
    topics = [{r.topic_id for r in model.transform(df).collect() if r.doc_id % 3 == t} for t in range(3)]
    assert all(len(t) == 1 for t in topics) and len(set.union(*topics)) == 3
    assert {x for r in TX.topic_names(spark, model, 4).collect() for x in r.topic_name.split(" / ")} == set(sum(words, []))
