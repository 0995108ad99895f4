import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from tarn.functions import json as J
from tarn.operators import quality
from tarn.plans import staging
from tarn.sources import readers, sinks


def put(root, path, doc, lines=False):
    p = root / path
    p.parent.mkdir(parents=True, exist_ok=True)
    text = "\n".join(json.dumps(d) for d in doc) if lines else doc if isinstance(doc, str) else json.dumps(doc)
    p.write_bytes(gzip.compress(text.encode()) if path.endswith(".gz") else text.encode())


def fixture(i, goals, **more):
    return {"fixture": {"id": i, "date": "2026-01-02T15:00:00+00:00", "venue": {"id": "bad"}, "status": {"short": "FT"}}, "league": {"id": 39, "season": 2025}, "teams": {"home": {"id": 1, "name": "A"}, "away": {"id": 2, "name": "B"}}, "goals": {"home": goals, "away": 0}, **more}


def test_fixtures_newest_snapshot_bad_cells_and_missing_arrays(spark, tmp_path):
    base = "raw/api_football/fixtures"
    put(tmp_path, f"{base}/ingest_date=2026-01-03T13/a.json.gz", {"response": [fixture(1, 1), fixture(2, 5)]})
    put(tmp_path, f"{base}/ingest_date=2026-01-04/b.json.gz", {"response": [fixture(1, 3), {"fixture": {}}]})
    put(tmp_path, f"{base}/ingest_date=2026-01-05/c.json.gz", {"errors": []})
    put(tmp_path, f"{base}/ingest_date=2026-01-05/d.json.gz", "{not json")
    rows = {r.fixture_id: r for r in staging.stage(spark, str(tmp_path), "stg_fixtures").collect()}
    assert set(rows) == {1, 2} and rows[1].home_goals == 3 and rows[2].home_goals == 5
    assert str(rows[2].ingest_date) == "2026-01-03" and rows[1].venue_id is None and str(rows[1].fixture_date) == "2026-01-02 15:00:00"


@pytest.mark.parametrize("name", staging.NAMES)
def test_every_model_is_empty_but_typed_without_files(spark, tmp_path, name):
    df = staging.stage(spark, str(tmp_path), name)
    assert df.columns and df.count() == 0


def test_nested_models(spark, tmp_path):
    put(tmp_path, "raw/api_football/standings/ingest_date=2026-01-01/a.json.gz", {"response": [{"league": {"id": 1, "season": 2025, "standings": [[{"rank": 1, "group": "A", "team": {"id": 7}, "all": {"goals": {"for": 9}}}], [{"rank": 1, "group": "B", "team": {"id": 8}}]]}}]})
    rows = staging.stage(spark, str(tmp_path), "stg_api_football_standings").orderBy("team_id").collect()
    assert [(r.league_id, r.group_name, r.team_id, r.goals_for) for r in rows] == [(1, "A", 7, 9), (1, "B", 8, None)]
    put(tmp_path, "raw/understat/teams/league=EPL/season=2025/ingest_date=2026-01-01/a.json.gz", {"71": {"id": "71", "title": "X", "history": [{"date": "2025-08-01 15:00:00", "h_a": "h", "xG": "1.5", "ppda": {"att": 3, "def": 2}}]}, "72": {"id": "72", "title": "Y", "history": []}})
    assert staging.stage(spark, str(tmp_path), "stg_understat_teams").count() == 2
    (r,) = staging.stage(spark, str(tmp_path), "stg_understat_team_matches").collect()
    assert (r.team_id, r.season, r.xg, r.ppda_att, str(r.match_date)) == (71, 2025, 1.5, 3.0, "2025-08-01 15:00:00")
    shot = {"id": "1", "match_id": "5", "minute": "3", "X": "0.9", "h_team": "X", "a_team": "Y"}
    put(tmp_path, "raw/understat/shots/league=EPL/season=2025/a.json.gz", {"h": [shot], "a": [{**shot, "id": "2"}]})
    assert sorted((r.shot_id, r.side, r.team_name) for r in staging.stage(spark, str(tmp_path), "stg_understat_shots").collect()) == [("1", "h", "X"), ("2", "a", "Y")]
    put(tmp_path, "raw/open_meteo/historical/venue=Park/ingest_date=2026-01-01/a.json.gz", {"timezone": "Europe/London", "hourly": {"time": ["2026-01-01T00:00", "2026-01-01T01:00"], "temperature_2m": [1.5]}})
    w = staging.stage(spark, str(tmp_path), "stg_open_meteo").orderBy("weather_time").collect()
    assert [(r.venue_name, r.temperature_c) for r in w] == [("Park", 1.5), ("Park", None)]
    put(tmp_path, "raw/physioroom/injury_table/ingest_date=2026-01-01/tables_raw.json.gz", [[{"c": 1}], [{"p": 2}, {"p": 3}], [], [{"f": 1}]])
    p = staging.stage(spark, str(tmp_path), "stg_physioroom").groupBy("table_name").count().collect()
    assert {r.table_name: r["count"] for r in p} == {"club_injury_totals": 1, "player_injuries": 2, "injury_type_frequency": 1}


def test_odds_news_wiki_and_lines(spark, tmp_path):
    quote = lambda t, p: {"key": "bk", "title": "BK", "markets": [{"key": "h2h", "last_update": t, "outcomes": [{"name": "A", "price": p}, {"name": "Draw", "price": 3.0}]}]}
    game = {"id": "m1", "home_team": "A", "away_team": "B", "commence_time": "2026-01-02T15:00:00Z"}
    put(tmp_path, "raw/odds/ingest_date=2026-01-01/a.json.gz", [{**game, "bookmakers": [quote("2026-01-01T10:00:00Z", 2.0)]}, {**game, "bookmakers": [quote("2026-01-02T10:00:00Z", 2.5), quote("2026-01-02T16:00:00Z", 9.9)]}])
    h = {r.outcome_type: r.price for r in staging.stage(spark, str(tmp_path), "stg_odds_h2h").collect()}
    assert h == {"home": 2.5, "draw": 3.0}
    put(tmp_path, "raw/football_news/ingest_date=2026-01-01/a.json.gz", {"articles": [{"url": "u1", "title": "t", "source": {"name": "S"}}]})
    put(tmp_path, "raw/football_news/ingest_date=2026-01-02/b.json.gz", {"url": "u2", "source": "plain"})
    assert {r.url: r.source_name for r in staging.stage(spark, str(tmp_path), "stg_football_news").collect()} == {"u1": "S", "u2": "plain"}
    put(tmp_path, "raw/rss/google_news/ingest_date=2026-01-01/a.jsonl.gz", [{"guid": "g", "published": "Tue, 03 Feb 2026 10:11:12 GMT", "query": "q", "lang": "en"}, {"title": "no id"}], lines=True)
    (g,) = staging.stage(spark, str(tmp_path), "stg_google_news").collect()
    assert str(g.published_at) == "2026-02-03 10:11:12"
    bind = lambda q, n: {"venue": {"type": "uri", "value": f"http://e/{q}"}, "venueLabel": {"value": n}, "coord": {"value": "Point(-0.1 51.5)"}, "capacity": {"value": "100"}}
    put(tmp_path, "raw/wikidata/sparql/query=pl_stadiums/ingest_date=2026-01-01/a.json.gz", {"results": {"bindings": [bind("Q1", "Old")]}})
    put(tmp_path, "raw/wikidata/sparql/query=pl_stadiums/ingest_date=2026-01-02/a.json.gz", {"results": {"bindings": [bind("Q2", "N"), bind("Q2", "N")]}})
    assert [(r.venue_qid, r.lat, r.lon, r.capacity) for r in staging.stage(spark, str(tmp_path), "stg_wikidata_stadiums").collect()] == [("Q2", 51.5, -0.1, 100)]


def test_csv_union_encodings_and_seed(spark, tmp_path):
    put(tmp_path, "raw/football_data_couk/season=2425/E0.csv", "Div,Date,Time,HomeTeam,AwayTeam,FTHG,FTAG\nE0,01/02/2025,15:00,A,B,2,x\n,,,,,,\n")
    put(tmp_path, "raw/football_data_couk/season=9900/E0.csv", "Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,B365H\nE0,01/02/99,A,C,1,0,2.5\n")
    rows = sorted(staging.stage(spark, str(tmp_path), "stg_football_data_co_uk").collect(), key=lambda r: r.away_team)
    assert [(r.away_team, str(r.match_date), r.match_time, r.home_goals, r.away_goals, r.b365_home, r.season_code) for r in rows] == [("B", "2025-02-01", "15:00", 2, None, None, "2425"), ("C", "2099-02-01" if str(rows[1].match_date).startswith("20") else "1999-02-01", None, 1, 0, 2.5, "9900")]
    (tmp_path / "x.csv").write_bytes("a, b\nÉé,2\n".encode("latin-1"))
    (r,) = readers.csv_of_lines(readers.read_lines(spark, str(tmp_path / "x.csv")), ["b", "a", "c"]).collect()
    assert (r.a, r.b, r.c) == ("Éé", "2", None)
    (tmp_path / "seed.csv").write_text("source, alias ,team_key\n# note\nx, Foo FC , Foo\n,,\n")
    assert [tuple(r) for r in readers.read_alias_seed(spark, [str(tmp_path / "seed.csv"), str(tmp_path / "none.csv")]).collect()] == [("x", "Foo FC", "Foo")]
    assert readers.read_alias_seed(spark, [str(tmp_path / "none")]).count() == 0


def test_many_small_csv_files_of_a_few_headers(spark, tmp_path):
    heads = ["a,b", "b,c,a", "\ufeff c , a"]
    for i in range(300):
        h = heads[i % 3]
        cells = {"a": f"a{i}", "b": f'"b,""{i}"""', "c": ""}
        names = [n.strip().lstrip("\ufeff") for n in h.split(",")]
        put(tmp_path, f"csv/d{i % 10}/{i}.csv", h + "\r\n" + ",".join(cells[n.strip()] for n in names) + "\n" + ",".join("x" for _ in range(len(names) + 1)) + "\n" + h.lstrip("\ufeff") + "\n\n" + "," * (len(names) - 1) + "\n")
    got = readers.read_csv_union(spark, str(tmp_path / "csv"), ["b", "a", "none"])
    assert got.columns == ["path", "b", "a", "none"]
    assert sorted((r.a, r.b, r.none) for r in got.collect()) == sorted((f"a{i}", f'b,"{i}"' if i % 3 < 2 else None, None) for i in range(300))
    assert all(r.path.endswith(f"/{r.a[1:]}.csv") for r in got.collect())
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2  # the lines and the headers, not a scan a header
    names = readers.header_names(spark, str(tmp_path / "csv")).withColumn("season", F.regexp_extract("path", "/d([0-9])/", 1))
    assert {(r.name, r.n) for r in names.groupBy("name").agg(F.count("*").alias("n")).collect()} == {("a", 300), ("b", 200), ("c", 200)}
    first = names.filter("season < '2'").withColumn("grp", F.when(F.expr("path like '%/d0/%'"), "2024").otherwise("2025"))
    small = first.filter("grp = '2024' or name <> 'b'")
    assert [tuple(r) for r in quality.schema_drift(small, "grp", "name").select("grp", "name", "change").collect()] == [("2025", "b", "removed")]
    assert readers.read_csv_union(spark, str(tmp_path / "none"), ["a"]).count() == readers.header_names(spark, str(tmp_path / "none")).count() == 0


def test_xml_html_and_bindings(spark):
    df = spark.createDataFrame([(1, "<goal><value><elapsed>3</elapsed><team>9</team></value><value><elapsed>80</elapsed></value></goal>"), (2, None), (3, "nope")], "id int, xml string")
    rows = readers.parse_xml_events(df, "xml", "value", "elapsed INT, team INT", ["id"]).collect()
    assert [(r.id, r.elapsed, r.team) for r in rows] == [(1, 3, 9), (1, 80, None)]
    page = "<table><tr><th>A<td>b &amp; c</tr><tr><td><table><tr><td>in</table>x</td></tr></table><p>y</p>"
    h = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    assert [(r.table_no, r.row_no, r.cells) for r in readers.extract_html_tables(h, "id", "html").collect()] == [(0, 0, ["A", "b & c"]), (0, 1, ["x"]), (1, 0, ["in"])]
    assert readers.extract_html_tables(h, "id", "html", expected=5).count() == 0
    docs = spark.createDataFrame([('{"results":{"bindings":[{"x":{"value":"http://e/Q5"}}]}}',)], "t string").select(F.parse_json("t").alias("doc"))
    assert [tuple(r) for r in J.flatten_bindings(docs, "doc", ["x"]).collect()] == [("http://e/Q5", "Q5")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, k string, v int")
    root = str(tmp_path / "lake")
    sinks.write_model(df, root, "core", "t", ["k"])
    sinks.write_model(df.filter("k = 'a'").withColumn("v", F.lit(7)), root, "core", "t", ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(f"{root}/core/t").collect()} == {("a", 7), ("b", 6)}
    m = sinks.publish_batch({"x": df, "y": df.filter("false")}, str(tmp_path / "pub"), "b1")
    assert {(r.table, r.n_rows) for r in m.collect()} == {("x", 2), ("y", 0)}
    assert sinks.register_views(spark, str(tmp_path / "pub" / "x"), ["latest", "none"], "v_") == ["v_latest"] and spark.table("v_latest").count() == 2
    sinks.compact(df.repartition(2), str(tmp_path / "c"), "k", ["id"])
    assert len(list((tmp_path / "c").rglob("*.parquet"))) == 2
    assert {r.layer: r.n_files for r in sinks.lake_metrics(spark, str(tmp_path / "pub")).collect()}["manifest"] >= 1
    out, before, after = sinks.clean_range(df, F.col("v") > 5)
    assert out.count() == 1 and before.get["n"] == 2 and after.get["n"] == 1
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    assert readers.read_prefix(spark, root + "/core").select("source_key").distinct().count() >= 1


def test_html_tables_are_read_once(spark):
    """Pages of another number of tables go, pages without id stay, and no page is parsed a second time."""
    two = "<table><tr><td>a &amp; b</table><TABLE class='x'><tr><th>c</th></tr></TABLE>"
    h = spark.createDataFrame([(1, two), (None, two), (2, "<table><tr><td>d</table>"), (3, None)], "id int, html string")
    got = readers.extract_html_tables(h, "id", "html", expected=2)
    assert {(r.id, r.table_no, r.row_no, *r.cells) for r in got.collect()} == {(i, k, 0, c) for i in (1, None) for k, c in ((0, "a & b"), (1, "c"))}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapIn") == 1


def test_html_tables_by_a_split_equal_the_parser():
    """Random pages of plain and odd tags; nearly all pages of plain tags only are read by the split."""
    def parsed(page):
        p = readers._Tables()
        p.feed(page)
        return [t["rows"] for t in p.tables()]

    rng = random.Random(17)
    plain = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</TD>", "<TD class='p'>", '<table border=1 id="a b">', "<b>", "x", "a b", " ", "&lt;td&gt;", "AT&T \n", "\n"]
    odd = ["<td/>", "<br/>", "&am", "p;", "<!-- <td> -->", "<", ">", "<script>", "</script>", "<title>", "</title>", "<td a=b'c>", "<td a='x>y'>", "</td x=1>", "'", '"', "<td\n>", "<td:x>", "</ td>", "<td\x1f>", "\x00", "<td a=>", "<?x>", "\u0130"]
    for pool in (plain, plain + odd, odd):
        pages = ["".join(rng.choices(pool, k=rng.choice([3, 10, 30]))) for _ in range(3000)]
        for page in pages:
            assert readers.page_tables(page) == parsed(page), page
        assert pool is not plain or sum(readers._plain_tables(p) is not None for p in pages) > 2500
