import base64
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tarn.streaming import cdc
from tarn.streaming.state import elo, elo_step, elo_stream, meeting_groups, running_state, windowed_counts

MSG = "topic string, partition int, offset long, value string"


def event(op, before, after, lsn, envelope=True):
    e = {"op": op, "before": before, "after": after, "ts_ms": 1, "source": {"lsn": lsn, "txId": 2, "snapshot": "false"}}
    return json.dumps({"schema": {}, "payload": e} if envelope else e)


def log(spark):
    row = lambda i, v: {"id": i, "v": v}
    m = [
        ("s.matches", 0, 0, event("c", None, row(1, "a"), 1)), ("s.matches", 0, 1, event("u", row(1, "a"), row(1, "b"), 5, False)), ("s.matches", 0, 2, event("u", row(1, "a"), row(1, "late"), 3)),
        ("s.matches", 0, 3, event("c", None, row(2, "x"), 2)), ("s.matches", 0, 4, event("d", row(2, "x"), None, 6)), ("s.matches", 0, 5, event("d", row(3, "y"), None, 4)), ("s.matches", 0, 6, event("c", None, row(3, "z"), 7)),
        ("s.matches", 0, 7, event("c", None, row(4, "p"), 8)), ("s.matches", 0, 8, event("u", None, row(4, "q"), 8)), ("s.matches", 0, 9, None), ("s.matches", 0, 10, "{bad"), ("s.goals", 1, 0, event("c", None, {"id": None}, 1)), ("s.goals", 1, 1, '{"after": {}}'),
    ]
    return spark.createDataFrame(m, MSG)


WANT = {"1": "b", "3": "z", "4": "q"}


def state(df):
    return {r.key: json.loads(r.after)["v"] for r in df.collect()}


def test_parse_and_current_state_in_any_order_and_with_replays(spark):
    p = cdc.parse_events(log(spark))
    assert {r.status: r["count"] for r in p.groupBy("status").count().collect()} == {"ok": 10, "tombstone": 1, "bad": 2}
    e = p.filter("status = 'ok' and table = 'matches'")
    assert state(cdc.current_state(e, "id")) == WANT
    assert state(cdc.current_state(e.union(e).orderBy(F.desc("offset")), "id")) == WANT
    assert cdc.current_state(p.filter("table = 'goals' and status = 'ok'"), "id").count() == 0


def test_bronze_is_idempotent_and_dead_letters_are_kept(spark, tmp_path):
    msgs = log(spark).withColumn("raw", F.col("value").cast("binary"))
    for _ in range(2):
        cdc.write_batches(msgs, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 10
    dead = spark.read.parquet(str(tmp_path / "dead_letter")).collect()
    assert "{bad" in [base64.b64decode(r.payload).decode() for r in dead] and len(dead) == 2


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    log(spark).filter("partition = 0").coalesce(1).write.parquet(str(src))
    s = cdc.cdc_stream(spark, "parquet", MSG, str(src))
    cdc.run_bronze(s, str(tmp_path / "lake"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "lake/bronze")).count() == 9
    e = cdc.parse_events(cdc.cdc_stream(spark, "parquet", MSG, str(src))).filter("status = 'ok'")
    q = cdc.state_changes(e, "id").writeStream.format("memory").queryName("cdc_state").outputMode("update").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    rows = spark.table("cdc_state").collect()
    best = {k: max(g, key=lambda r: (r.lsn, r.offset)) for k, g in itertools.groupby(sorted(rows, key=lambda r: r.key), key=lambda r: r.key)}
    assert {k: json.loads(r.after)["v"] for k, r in best.items() if r.op != "d"} == WANT


def test_merge_by_micro_batches(spark):
    p = cdc.parse_events(log(spark)).filter("status = 'ok' and table = 'matches'")
    t = spark.createDataFrame([], "key string, op string, after string, ts_ms long, lsn long, offset long")
    for lo, hi in ((4, 9), (0, 4), (4, 9)):
        t = cdc.merge_state(t, p.filter(f"offset >= {lo} and offset < {hi}"), "id")
    assert state(t.filter("op <> 'd'")) == WANT


def test_running_state_and_windows(spark, tmp_path):
    e = spark.createDataFrame([(1, "2026-01-01 00:00:00", "goal", 1), (1, "2026-01-01 00:12:00", "card", 2), (2, "2026-01-01 00:01:00", "goal", 3)], "k int, ts string, kind string, id int").withColumn("ts", F.to_timestamp("ts"))
    got = {r.k: (r.n_events, r.goals, r.last_kind) for r in running_state(e, ["k"], ["ts", "id"], {"goals": F.col("kind") == "goal"}, ["kind"]).collect()}
    assert got == {1: (2, 1, "card"), 2: (1, 1, "goal")}
    assert windowed_counts(e, "ts", ["kind"]).count() == 2


def test_elo_order_and_stream(spark, tmp_path):
    rows = [("EPL", i, 2025 + i // 4, i, "A" if i % 2 else "B", "C" if i % 3 else "D", i % 4, 1) for i in range(8)]
    m = spark.createDataFrame(rows, "grp string, match_id long, season int, ord long, home string, away string, hg int, ag int")
    a = sorted(elo(m, "grp", "season", ["ord"], "home", "away", "hg", "ag", "match_id").collect())
    b = sorted(elo(m.orderBy(F.desc("ord")), "grp", "season", ["ord"], "home", "away", "hg", "ag", "match_id").collect())
    assert a == b and a[0].home_elo_before == 1500
    extra = m.union(spark.createDataFrame([("EPL", 99, 2026, 99, "A", "C", 5, 0)], m.schema))
    c = {r.match_id: r for r in elo(extra, "grp", "season", ["ord"], "home", "away", "hg", "ag", "match_id").collect()}
    assert all(c[r.match_id] == r for r in a)
    one = m.filter("season = 2025")
    one.coalesce(1).write.parquet(str(tmp_path / "m"))
    q = elo_stream(spark.readStream.schema(m.schema).parquet(str(tmp_path / "m"))).writeStream.format("memory").queryName("elo").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    s = {r.match_id: round(r.home_elo_before, 6) for r in spark.table("elo").collect()}
    assert s == {r.match_id: round(r.home_elo_before, 6) for r in elo(one, "grp", "season", ["ord"], "home", "away", "hg", "ag", "match_id").collect()}


def test_elo_holds_no_group_whole(spark):
    rows = [(g, i, 2025 + i // 20, i, f"t{i % 3}", f"t{3 + i % 4}", i % 4, i % 3 if i % 7 else None) for g in (1, 2, None) for i in range(40)]
    m = spark.createDataFrame(rows, "grp long, match_id long, season int, ord long, home string, away string, hg int, ag int")
    args = ("grp", "season", ["ord"], "home", "away", "hg", "ag", "match_id")
    whole = sorted(elo(m, *args).collect(), key=str)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = elo(m.orderBy(F.desc("ord")), *args)
        assert sorted(df.collect(), key=str) == whole and len(whole) == 120
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroupsInPandas" not in df._jdf.queryExecution().toString()
    by = {g: {r.match_id: r[2:] for r in whole if r.grp == g} for g in (1, 2, None)}
    assert by[1] == by[2] == by[None] and by[1][39][0] != 1500


def test_elo_over_competitions_equals_a_plain_fold(spark):
    rng = random.Random(8)
    leagues = {"north": "abcd", "south": "efgh", "cup": "ah", "west": "wxyz", "far": "uv"}
    rows = []
    for n in range(240):
        home, away = rng.sample(leagues[league := rng.choice([*leagues])], 2)
        rows.append((league, 2000 + n // 100, n, home, away, rng.randint(0, 4), None if n % 17 == 0 else rng.randint(0, 4), n))
    chain = [(f"c{i}", 2001, 300 + i, f"m{i}", f"m{i + 1}", 1, 0, 300 + i) for i in range(20)]
    m = spark.createDataFrame(rows + chain, "grp string, season int, ord int, home string, away string, hg int, ag int, match_id long")
    groups = {r.entity: r.component for r in meeting_groups(m, "home", "away").collect()}
    linked = {**dict.fromkeys("abcdefgh", "a"), **dict.fromkeys("wxyz", "w"), "u": "u", "v": "u"}
    assert groups == linked | {f"m{i}": "m0" for i in range(21)}
    want = {}
    for part in sorted(set(groups.values())):
        rating, now = {}, None
        for _, season, _, home, away, hg, ag, ident in sorted((r for r in rows + chain if groups[r[3]] == part), key=lambda r: r[2]):
            if now is not None and season != now:
                rating = {t: 1500 + 0.75 * (v - 1500) for t, v in rating.items()}
            now = season
            h, a = rating.setdefault(home, 1500.0), rating.setdefault(away, 1500.0)
            want[ident] = (h, a)
            if ag is not None:
                delta, _ = elo_step(h, a, hg, ag, 20, 60)
                rating[home], rating[away] = h + delta, a - delta
    got = elo(m, None, "season", ["ord"], "home", "away", "hg", "ag", "match_id").collect()
    assert {r.match_id: (r.home_elo_before, r.away_elo_before) for r in got} == {k: pytest.approx(v) for k, v in want.items()}
    assert meeting_groups(m.limit(0), "home", "away").count() == 0
