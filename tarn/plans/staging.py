"""Staging models: typed rows out of raw documents, one per natural key, newest snapshot first.

A model is a declarative specification; ``build`` reads its files, explodes, projects with casts that
give null for bad cells, requires the key, and keeps the latest row per key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.functions import json as J
from tarn.operators.snapshot import latest, latest_batch
from tarn.sources.readers import read_csv_union, read_json_docs, read_jsonl
from tarn.streaming.cdc import current_state


@dataclass(frozen=True)
class Model:
    """glob below the lake; explode: array paths, each starting at the element before; fields: lines of
    ``name type path``, where path starts at the last element, at an outer one (``@0``, ``@1``), or is
    ``path:key`` for a part of the file path; keys of the latest row."""

    glob: str
    fields: str
    keys: tuple[str, ...]
    require: str
    explode: tuple[str, ...] = ()
    lines: bool = False
    top: bool = False
    order: tuple[str, ...] = ("ingest_date",)


def _field(kind: str, path: str, levels: list[str]) -> Column:
    if path.startswith("path:"):
        key = path[5:]
        return J.path_date(key) if kind == "date" else J.path_part(key).try_cast(kind)
    at = levels[-1]
    if path.startswith("@"):
        at, path = levels[int(path[1])], path[2:]
    return J.jts(at, path) if kind == "ts" else J.jget(at, path, kind)


def explode_levels(docs: DataFrame, paths: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """The documents with their nested arrays exploded one after the other; the names of all levels."""
    levels, df = ["doc"], docs
    for i, p in enumerate(paths):
        if p == "*":
            df = df.select("path", *levels, F.explode(F.try_variant_get(levels[-1], "$", "map<string,variant>")).alias("_k", f"e{i}")).drop("_k")
        else:
            df = df.select("path", *levels, F.explode(F.try_variant_get(levels[-1], p, "array<variant>")).alias(f"e{i}"))
        levels.append(f"e{i}")
    return df, levels


def project(df: DataFrame, levels: list[str], m: Model) -> DataFrame:
    cols = [_field(kind, path, levels).alias(name) for name, kind, path in (x.split() for x in m.fields.strip().splitlines())]
    out = df.select("path", *cols)
    out = out.filter(F.col(m.require).isNotNull())
    keys = [F.coalesce(F.col(k), F.lit("")).alias(f"_k{i}") if out.schema[k].dataType.simpleString() == "string" else F.col(k).alias(f"_k{i}") for i, k in enumerate(m.keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    out = out.select("*", *keys)
    order = [F.desc_nulls_last(o) for o in m.order if o in out.columns]
    return latest(out, names, [*order, F.desc("path")]).drop(*names, "path")


def build(spark: SparkSession, lake: str, name: str) -> DataFrame:
    m = MODELS[name]
    glob = f"{lake.rstrip('/')}/{m.glob}"
    docs = read_jsonl(spark, glob) if m.lines else read_json_docs(spark, glob, m.top)
    return project(*explode_levels(docs, m.explode), m)


INGEST = "ingest_date date path:ingest_date"
# Where the sources keep what the models need.
MODELS: dict[str, Model] = {
    "stg_fixtures": Model("raw/api_football/fixtures", f"""
        fixture_id int $.fixture.id
        fixture_date ts $.fixture.date
        referee string $.fixture.referee
        venue_id int $.fixture.venue.id
        venue_name string $.fixture.venue.name
        status_long string $.fixture.status.long
        status_short string $.fixture.status.short
        elapsed_minutes int $.fixture.status.elapsed
        league_id int $.league.id
        season int $.league.season
        round string $.league.round
        home_team_id int $.teams.home.id
        home_team_name string $.teams.home.name
        away_team_id int $.teams.away.id
        away_team_name string $.teams.away.name
        home_goals int $.goals.home
        away_goals int $.goals.away
        ht_home_goals int $.score.halftime.home
        ht_away_goals int $.score.halftime.away
        pen_home_goals int $.score.penalty.home
        pen_away_goals int $.score.penalty.away
        {INGEST}""", ("fixture_id",), "fixture_id", ("$.response",)),
    "stg_teams": Model("raw/api_football/teams", """
        team_id int $.team.id
        name string $.team.name
        code string $.team.code
        country string $.team.country
        founded int $.team.founded
        is_national boolean $.team.national
        logo_url string $.team.logo
        venue_id int $.venue.id
        venue_name string $.venue.name
        venue_city string $.venue.city
        venue_capacity int $.venue.capacity
        league_id int path:league
        season int path:season""", ("team_id", "season"), "team_id", ("$.response",), order=("league_id",)),
    "stg_players": Model("raw/api_football/players_summary", f"""
        player_id int $.player.id
        name string $.player.name
        firstname string $.player.firstname
        lastname string $.player.lastname
        age int $.player.age
        birth_date date $.player.birth.date
        birth_country string $.player.birth.country
        nationality string $.player.nationality
        height string $.player.height
        weight string $.player.weight
        is_injured boolean $.player.injured
        photo_url string $.player.photo
        team_id int $.statistics[0].team.id
        team_name string $.statistics[0].team.name
        position string $.statistics[0].games.position
        league_id int $.statistics[0].league.id
        season int $.statistics[0].league.season
        {INGEST}""", ("player_id", "season"), "player_id", ("$.response",)),
    "stg_api_football_standings": Model("raw/api_football/standings", f"""
        league_id int @1$.league.id
        season int @1$.league.season
        group_name string $.group
        rank int $.rank
        team_id int $.team.id
        team string $.team.name
        points int $.points
        goal_diff int $.goalsDiff
        form string $.form
        trend string $.status
        description string $.description
        played int $.all.played
        win int $.all.win
        draw int $.all.draw
        lose int $.all.lose
        goals_for int $.all.goals.for
        goals_against int $.all.goals.against
        {INGEST}""", ("league_id", "season", "group_name", "team_id"), "team_id", ("$.response", "$.league.standings", "$")),
    "stg_football_data_org_competitions": Model("raw/football_data_org/competitions", f"""
        competition_id int $.id
        code string $.code
        name string $.name
        area string $.area.name
        type string $.type
        current_season_id int $.currentSeason.id
        current_season_start date $.currentSeason.startDate
        current_season_end date $.currentSeason.endDate
        current_matchday int $.currentSeason.currentMatchday
        {INGEST}""", ("competition_id",), "competition_id", ("$.competitions",)),
    "stg_football_data_org_matches": Model("raw/football_data_org/matches", f"""
        match_id int $.id
        competition_code string path:comp
        season_id int $.season.id
        matchday int $.matchday
        stage string $.stage
        group_name string $.group
        utc_date ts $.utcDate
        status string $.status
        last_updated ts $.lastUpdated
        home_team_id int $.homeTeam.id
        home_team string $.homeTeam.name
        home_tla string $.homeTeam.tla
        away_team_id int $.awayTeam.id
        away_team string $.awayTeam.name
        away_tla string $.awayTeam.tla
        home_goals int $.score.fullTime.home
        away_goals int $.score.fullTime.away
        ht_home_goals int $.score.halfTime.home
        ht_away_goals int $.score.halfTime.away
        winner string $.score.winner
        duration string $.score.duration
        referee string $.referees[0].name
        {INGEST}""", ("match_id", "competition_code"), "match_id", ("$.matches",)),
    "stg_football_data_org_players": Model("raw/football_data_org/teams", f"""
        player_id int $.id
        name string $.name
        position string $.position
        date_of_birth date $.dateOfBirth
        nationality string $.nationality
        team_id int @1$.id
        team_name string @1$.name
        {INGEST}""", ("player_id", "team_id"), "player_id", ("$.teams", "$.squad")),
    "stg_football_data_org_standings": Model("raw/football_data_org/standings", f"""
        body_comp string @0$.competition.code
        path_comp string path:comp
        season_id int @0$.season.id
        stage string @1$.stage
        table_type string @1$.type
        rank int $.position
        team_id int $.team.id
        team string $.team.name
        played int $.playedGames
        won int $.won
        draw int $.draw
        lost int $.lost
        points int $.points
        goals_for int $.goalsFor
        goals_against int $.goalsAgainst
        goal_diff int $.goalDifference
        form string $.form
        {INGEST}""", ("path_comp", "body_comp", "season_id", "stage", "table_type", "team_id"), "team_id", ("$.standings", "$.table")),
    "stg_football_data_org_teams": Model("raw/football_data_org/teams", f"""
        team_id int $.id
        body_comp string @0$.competition.code
        path_comp string path:comp
        name string $.name
        short_name string $.shortName
        tla string $.tla
        founded int $.founded
        venue string $.venue
        club_colors string $.clubColors
        area string $.area.name
        coach_name string $.coach.name
        coach_nationality string $.coach.nationality
        {INGEST}""", ("team_id", "path_comp", "body_comp"), "team_id", ("$.teams",)),
    "stg_google_news": Model("raw/rss/google_news", f"""
        news_id string $.guid
        title string $.title
        summary string $.summary
        url string $.link
        publisher string $.source
        published_raw string $.published
        search_query string $.query
        language string $.lang
        source_type string $.feed
        {INGEST}""", ("news_id", "search_query", "language"), "news_id", lines=True),
    "stg_thesportsdb_former_teams": Model("raw/thesportsdb/metadata/entity=former_teams", f"""
        player_id string $.idPlayer
        former_team string $.strFormerTeam
        start_year string $.strJoined
        end_year string $.strDeparted
        {INGEST}""", ("player_id", "former_team", "start_year"), "player_id", ("$.formerteams",)),
    "stg_thesportsdb_honors": Model("raw/thesportsdb/metadata/entity=honors", f"""
        player_id string $.idPlayer
        honor string $.strHonour
        season string $.strSeason
        {INGEST}""", ("player_id", "honor", "season"), "player_id", ("$.honors",)),
    "stg_thesportsdb_players": Model("raw/thesportsdb/metadata/entity=players", f"""
        player_id string $.idPlayer
        team_id string $.idTeam
        player_name string $.strPlayer
        nationality string $.strNationality
        birth_date date $.dateBorn
        wage string $.strWage
        date_signed date $.dateSigned
        signing_fee string $.strSigning
        outfitter string $.strOutfitter
        agent string $.strAgent
        position string $.strPosition
        height string $.strHeight
        weight string $.strWeight
        wikidata_id string $.idWikidata
        transfermarkt_id string $.idTransferMkt
        espn_id string $.idESPN
        {INGEST}""", ("player_id",), "player_id", ("$.player",)),
    "stg_thesportsdb_teams": Model("raw/thesportsdb/teams", f"""
        team_id string $.idTeam
        team_name string $.strTeam
        team_short string $.strTeamShort
        alternate_names string $.strTeamAlternate
        formed_year int $.intFormedYear
        league_id string $.idLeague
        league string $.strLeague
        league_slug string path:league
        country string $.strCountry
        stadium string $.strStadium
        stadium_capacity int $.intStadiumCapacity
        stadium_location string $.strLocation
        website string $.strWebsite
        badge_url string $.strBadge
        description_en string $.strDescriptionEN
        {INGEST}""", ("team_id",), "team_id", ("$.teams",)),
    "stg_understat_matches": Model("raw/understat/matches", f"""
        match_id int $.id
        league string path:league
        season int path:season
        is_result boolean $.isResult
        home_team_id int $.h.id
        home_team_name string $.h.title
        away_team_id int $.a.id
        away_team_name string $.a.title
        home_goals int $.goals.h
        away_goals int $.goals.a
        home_xg double $.xG.h
        away_xg double $.xG.a
        forecast_home_win double $.forecast.w
        forecast_draw double $.forecast.d
        forecast_away_win double $.forecast.l
        match_date ts $.datetime
        {INGEST}""", ("match_id", "league", "season"), "match_id", top=True),
    "stg_understat_players": Model("raw/understat/players", f"""
        player_id int $.id
        league string path:league
        season int path:season
        player_name string $.player_name
        games int $.games
        minutes_played int $.time
        goals int $.goals
        xg double $.xG
        assists int $.assists
        xa double $.xA
        shots int $.shots
        key_passes int $.key_passes
        yellow_cards int $.yellow_cards
        red_cards int $.red_cards
        position string $.position
        team_name string $.team_title
        non_penalty_goals int $.npg
        non_penalty_xg double $.npxG
        xg_chain double $.xGChain
        xg_buildup double $.xGBuildup
        {INGEST}""", ("player_id", "league", "season"), "player_id", top=True),
    "stg_understat_team_matches": Model("raw/understat/teams", f"""
        team_id int @1$.id
        team_name string @1$.title
        league string path:league
        season int path:season
        match_date ts $.date
        home_away string $.h_a
        result string $.result
        scored int $.scored
        missed int $.missed
        xg double $.xG
        xga double $.xGA
        npxg double $.npxG
        npxga double $.npxGA
        npxgd double $.npxGD
        deep int $.deep
        deep_allowed int $.deep_allowed
        ppda_att double $.ppda.att
        ppda_def double $.ppda.def
        ppda_allowed_att double $.ppda_allowed.att
        ppda_allowed_def double $.ppda_allowed.def
        xpts double $.xpts
        pts int $.pts
        {INGEST}""", ("team_id", "league", "season", "match_date"), "team_id", ("*", "$.history")),
    "stg_understat_teams": Model("raw/understat/teams", f"""
        team_id int $.id
        team_name string $.title
        league string path:league
        season int path:season
        {INGEST}""", ("team_id", "league", "season"), "team_id", ("*",)),
    "stg_wikimedia_pageviews": Model("raw/wikimedia_pageviews/per_article", f"""
        entity_type string path:entity
        lang string path:lang
        article string path:article
        timestamp_raw string $.timestamp
        views int $.views
        {INGEST}""", ("entity_type", "lang", "article", "timestamp_raw"), "timestamp_raw", ("$.items",)),
    "stg_wikimedia_top_daily": Model("raw/wikimedia_pageviews/top_daily", """
        lang string path:lang
        view_date date path:date
        article string $.article
        views int $.views
        rank int $.rank""", ("lang", "view_date", "article"), "article", ("$.items", "$.articles"), order=()),
    "stg_wikipedia": Model("raw/wikipedia_articles", """
        page_id string $.page_id
        title string $.title
        body_category string $.entity_type
        path_category string path:entity
        body_language string $.lang
        path_language string path:lang
        content string $.extract
        word_count int $.word_count
        fetched_date date path:fetched_date""", ("page_id", "body_language", "path_language", "body_category", "path_category"), "page_id", order=("fetched_date",)),
    "stg_youtube_comments": Model("raw/youtube/comments", f"""
        comment_id string $.comment_id
        video_id string $.video_id
        author string $.author
        text string $.text
        like_count int $.like_count
        published_at ts $.published_at
        {INGEST}""", ("comment_id",), "comment_id", lines=True),
    "stg_youtube_videos": Model("raw/youtube/videos", f"""
        video_id string $.video_id
        search_query string $.query
        published_at ts $.published_at
        channel_id string $.channel_id
        title string $.title
        description string $.description
        channel_title string $.channel_title
        {INGEST}""", ("video_id", "search_query"), "video_id", lines=True),
}


def _merge(df: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """Each name as the first of two columns that is there."""
    return df.withColumns({n: F.coalesce(*pair) for n, pair in names.items()}).drop(*[c for pair in names.values() for c in pair])


def stage(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """A staging model by name, with what its specification alone cannot say."""
    if name in SPECIAL:
        return SPECIAL[name](spark, lake)
    df = build(spark, lake, name)
    comp = {"competition_code": ("path_comp", "body_comp")}
    if name == "stg_football_data_org_standings":
        return _merge(df.filter("table_type = 'TOTAL'").drop("table_type"), comp)
    if name == "stg_football_data_org_teams":
        return _merge(df, comp)
    if name == "stg_google_news":
        when = F.coalesce(X.parse_rfc822("published_raw"), F.col("published_raw").try_cast("timestamp_ntz"))
        return df.withColumn("published_at", when).drop("published_raw")
    if name == "stg_thesportsdb_teams":
        return df.withColumn("description_en", F.left("description_en", F.lit(2000)))
    if name == "stg_wikimedia_pageviews":
        return df.withColumn("view_date", X.parse_compact("timestamp_raw"))
    if name == "stg_wikipedia":
        return _merge(df, {"category": ("body_category", "path_category"), "language": ("body_language", "path_language")})
    if name == "stg_youtube_comments":
        return df.withColumn("author_hash", F.md5("author"))
    return df


COUK = {"home_goals": "FTHG", "away_goals": "FTAG", "ht_home_goals": "HTHG", "ht_away_goals": "HTAG", "home_shots": "HS", "away_shots": "AS", "home_shots_target": "HST", "away_shots_target": "AST", "home_corners": "HC", "away_corners": "AC", "home_fouls": "HF", "away_fouls": "AF", "home_yellows": "HY", "away_yellows": "AY", "home_reds": "HR", "away_reds": "AR"}
COUK_ODDS = {"b365_home": "B365H", "b365_draw": "B365D", "b365_away": "B365A", "avg_home": "AvgH", "avg_draw": "AvgD", "avg_away": "AvgA", "max_home": "MaxH", "max_draw": "MaxD", "max_away": "MaxA"}
COUK_TEXT = {"division": "Div", "match_date_raw": "Date", "match_time": "Time", "match_result": "FTR", "ht_result": "HTR", "referee": "Referee", "home_team": "HomeTeam", "away_team": "AwayTeam"}


def stg_football_data_co_uk(spark: SparkSession, lake: str) -> DataFrame:
    cols = [*COUK_TEXT.values(), *COUK.values(), *COUK_ODDS.values()]
    raw = read_csv_union(spark, f"{lake.rstrip('/')}/raw/football_data_couk", cols)
    code = J.path_part("season")
    df = raw.select(
        "path", *[X.blank_to_null(c).alias(n) for n, c in COUK_TEXT.items()], *[F.col(c).try_cast("int").alias(n) for n, c in COUK.items()], *[F.col(c).try_cast("double").alias(n) for n, c in COUK_ODDS.items()],
        code.alias("season_code"), (2000 + F.left(code, F.lit(2)).try_cast("int")).alias("season_start_year"), X.parse_day_first("Date").alias("match_date"),
    ).filter("home_team is not null")
    return latest(df, ["division", "season_code", "match_date", "home_team", "away_team"], [F.asc("path")]).drop("path")


def stg_football_news(spark: SparkSession, lake: str) -> DataFrame:
    docs = read_json_docs(spark, f"{lake.rstrip('/')}/raw/football_news")
    a = J.array_or_self(docs, "doc", "$.articles", "a", ["path"])
    g = lambda p: J.jget("a", p)
    df = a.select("path", g("$.title").alias("title"), g("$.url").alias("url"), F.coalesce(g("$.image"), g("$.urlToImage")).alias("image_url"), F.coalesce(g("$.source.name"), g("$.source")).alias("source_name"), J.jts("a", "$.publishedAt").alias("published_at"), J.path_date().alias("ingest_date"))
    return latest(df.filter("url is not null"), ["url"], [F.desc_nulls_last("ingest_date"), F.desc("path")]).drop("path")


def stg_odds_base(spark: SparkSession, lake: str) -> DataFrame:
    """Every quote of every snapshot, not deduplicated."""
    docs = read_json_docs(spark, f"{lake.rstrip('/')}/raw/odds", explode_top=True)
    df, (d, b, m, o) = explode_levels(docs, ("$.bookmakers", "$.markets", "$.outcomes"))
    return df.select(
        *[J.jget(d, f"$.{p}").alias(n) for n, p in (("match_id", "id"), ("sport_key", "sport_key"), ("home_team", "home_team"), ("away_team", "away_team"))], J.jts(d, "$.commence_time").alias("commence_time"),
        J.jget(b, "$.key").alias("bookmaker_key"), J.jget(b, "$.title").alias("bookmaker"), F.coalesce(J.jts(m, "$.last_update"), J.jts(b, "$.last_update")).alias("last_update"), J.jget(m, "$.key").alias("market_key"),
        J.jget(o, "$.name").alias("outcome_name"), J.jget(o, "$.point", "double").alias("point"), J.jget(o, "$.price", "double").alias("price"), J.path_date().alias("snapshot_date"),
    ).filter("match_id is not null")


def odds_market(base: DataFrame, market: str) -> DataFrame:
    """The newest quote before the event per match, bookmaker and outcome of one market."""
    df = base.filter((F.col("market_key") == market) & (F.col("last_update") <= F.col("commence_time")))
    out = latest(df, ["match_id", "bookmaker_key", "outcome_name"], [F.desc("last_update"), F.desc_nulls_last("snapshot_date")])
    if market == "h2h":
        kind = F.when(F.col("outcome_name") == F.col("home_team"), "home").when(F.col("outcome_name") == F.col("away_team"), "away").when(F.lower("outcome_name") == "draw", "draw")
        return out.withColumn("outcome_type", kind).drop("point", "market_key")
    if market == "spreads":
        return out.withColumnsRenamed({"outcome_name": "team_name", "point": "handicap_point"}).drop("market_key")
    return out.withColumnRenamed("point", "target_point").drop("market_key")


WEATHER = {"weather_time": ("$.hourly.time", "string"), "temperature_c": ("$.hourly.temperature_2m", "double"), "precipitation_mm": ("$.hourly.precipitation", "double"), "windspeed_kmh": ("$.hourly.windspeed_10m", "double"), "humidity_pct": ("$.hourly.relative_humidity_2m", "double"), "weather_code": ("$.hourly.weathercode", "int")}


def stg_open_meteo(spark: SparkSession, lake: str, kind: str = "historical", dated: str = "ingest_date") -> DataFrame:
    docs = read_json_docs(spark, f"{lake.rstrip('/')}/raw/open_meteo/{kind}")
    at = docs.select("doc", J.path_part("venue").alias("venue_name"), J.path_date().alias(dated), J.jget("doc", "$.latitude", "double").alias("latitude"), J.jget("doc", "$.longitude", "double").alias("longitude"), J.jget("doc", "$.timezone").alias("timezone"))
    df = J.explode_parallel(at, "doc", WEATHER).withColumn("weather_time", F.col("weather_time").try_cast("timestamp_ntz")).filter("weather_time is not null")
    return latest(df, ["venue_name", "weather_time"], [F.desc_nulls_last(dated)])


def stg_physioroom(spark: SparkSession, lake: str) -> DataFrame:
    docs = read_json_docs(spark, f"{lake.rstrip('/')}/raw/physioroom/injury_table")
    names = ["club_injury_totals", "player_injuries", "injury_types_by_club", "injury_type_frequency"]
    t = J.explode_named(docs, "doc", "$", names, "tbl", ["path"])
    rows = J.explode_array(t, "tbl", "$", "row", ["path", "pos", "table_name"])
    return rows.select(J.path_date().alias("snapshot_date"), F.col("pos").alias("table_idx"), "table_name", F.to_json("row").alias("row_json"))


def stg_understat_shots(spark: SparkSession, lake: str) -> DataFrame:
    docs = read_json_docs(spark, f"{lake.rstrip('/')}/raw/understat/shots")
    s = J.explode_sides(docs, "doc", {"h": "$.h", "a": "$.a"}, "s", ["path"])
    g = lambda p, t="string": J.jget("s", p, t)
    df = s.select(
        "path", g("$.id").alias("shot_id"), g("$.match_id", "int").alias("match_id"), J.path_part("league").alias("league"), J.path_part("season").try_cast("int").alias("season"), "side",
        F.when(F.col("side") == "h", g("$.h_team")).otherwise(g("$.a_team")).alias("team_name"), g("$.minute", "int").alias("minute"), g("$.X", "double").alias("x_coord"), g("$.Y", "double").alias("y_coord"), g("$.xG", "double").alias("xg"),
        g("$.result").alias("result"), g("$.player").alias("player_name"), g("$.player_id", "int").alias("player_id"), g("$.player_assisted").alias("assisted_by"), g("$.lastAction").alias("last_action"), g("$.situation").alias("situation"), g("$.shotType").alias("shot_type"),
    )
    return latest(df.filter("shot_id is not null"), ["shot_id"], [F.desc("path")]).drop("path")


def stg_wikidata(spark: SparkSession, lake: str) -> DataFrame:
    """All bindings of the newest batch of each query."""
    docs = read_json_docs(spark, f"{lake.rstrip('/')}/raw/wikidata/sparql")
    rows = J.explode_array(docs, "doc", "$.results.bindings", "binding_obj", ["path"])
    df = rows.select(J.path_part("query").alias("sparql_query_name"), J.path_date().alias("ingest_date"), "binding_obj")
    return latest_batch(df, ["sparql_query_name"], F.col("ingest_date"))


def _wikidata(query: str, cols: dict[str, tuple[str, str]]):
    def read(spark: SparkSession, lake: str) -> DataFrame:
        kinds = {"qid": J.rdf_qid, "text": J.rdf_value, "date": J.rdf_date, "lat": lambda b, n: J.rdf_point(b, n, "lat"), "lon": lambda b, n: J.rdf_point(b, n, "lon"), "int": lambda b, n: J.rdf_value(b, n).try_cast("int"), "double": lambda b, n: J.rdf_value(b, n).try_cast("double")}
        rows = stg_wikidata(spark, lake).filter(F.col("sparql_query_name") == query)
        return rows.select(*[kinds[k]("binding_obj", n).alias(c) for c, (k, n) in cols.items()], "ingest_date").distinct()

    return read


def _cdc(table: str, pk: str, fields: str):
    """A source table's current rows out of its change log."""

    def read(spark: SparkSession, lake: str) -> DataFrame:
        docs = read_json_docs(spark, f"{lake.rstrip('/')}/raw/openliga/{table}")
        e = J.explode_array(docs, "doc", "$.events", "e", [])
        events = e.select(J.jget("e", "$.op").alias("op"), F.to_json(F.try_variant_get("e", "$.before", "variant")).alias("before"), F.to_json(F.try_variant_get("e", "$.after", "variant")).alias("after"), J.jget("e", "$.ts_ms", "bigint").alias("ts_ms"), J.jget("e", "$.lsn", "bigint").alias("lsn"), J.jget("e", "$.kafka_offset", "bigint").alias("offset"))
        now = current_state(events, pk).select(F.try_parse_json("after").alias("a"))
        cols = [x.split() for x in fields.strip().splitlines()]
        cast = lambda n, k, p: J.cdc_ts("a", f"$.{p}") if k == "cdc" else F.coalesce(J.jget("a", f"$.{p}", "boolean"), F.lit(False)) if k == "flag" else J.jget("a", f"$.{p}", k)
        return now.select(*[cast(n, k, p).alias(n) for n, k, p in ((c + [c[0]])[:3] for c in cols)])

    return read


OPENLIGA = {
    "goals": ("goal_id", "goal_id int\nmatch_id int\nminute int\nscorer_id int\nscorer_name string\nscoring_team_id int\nscore_team1 int\nscore_team2 int\nis_penalty flag\nis_own_goal flag\nis_overtime flag\ncomment string"),
    "groups": ("group_id", "group_id int\nleague_id int\ngroup_order int\ngroup_name string"),
    "leagues": ("league_id", "league_id int\nleague_shortcut string shortcut\nseason int\nleague_name string name\nsport_id int"),
    "locations": ("location_id", "location_id int\ncity string\nstadium string"),
    "match_results": ("result_id", "result_id int\nmatch_id int\nresult_name string\nresult_order int\nresult_type_id int\nresult_type_kind string\npoints_team1 int\npoints_team2 int"),
    "teams": ("team_id", "team_id int\nteam_name string\nshort_name string\nicon_url string"),
    "matches": ("match_id", "match_id int\nleague_id int\ngroup_id int\nteam1_id int\nteam2_id int\nlocation_id int\nmatch_time_utc cdc\nmatch_time_local cdc\ntime_zone_id string\nis_finished flag\nviewers int\napi_updated_at cdc"),
}
KINDS = {"HalfTime": "ht_", "After90Minutes": "", "AfterExtraTime": "et_", "AfterPenalties": "pen_"}


def openliga_table(spark: SparkSession, lake: str, table: str) -> DataFrame:
    return _cdc(table, *OPENLIGA[table])(spark, lake)


def stg_openliga_matches(spark: SparkSession, lake: str, min_season: int = 2024) -> DataFrame:
    t = {n: openliga_table(spark, lake, n) for n in OPENLIGA if n != "goals"}
    res = t["match_results"].groupBy("match_id").agg(*[F.max(F.when(F.col("result_type_kind") == k, F.col(f"points_team{i}"))).alias(f"{p}{s}_goals") for k, p in KINDS.items() for i, s in ((1, "home"), (2, "away"))])
    side = {s: t["teams"].select(F.col("team_id").alias(f"{s}_team_id"), F.col("team_name").alias(f"{s}_team"), F.col("short_name").alias(f"{s}_short")) for s in ("home", "away")}
    m = t["matches"].withColumnsRenamed({"team1_id": "home_team_id", "team2_id": "away_team_id"})
    out = m.join(t["leagues"].filter(F.col("season") >= min_season), "league_id").join(t["groups"].drop("league_id"), "group_id", "left").join(side["home"], "home_team_id", "left").join(side["away"], "away_team_id", "left")
    out = out.join(t["locations"].select("location_id", F.col("stadium").alias("venue_name"), F.col("city").alias("venue_city")), "location_id", "left").join(res, "match_id", "left")
    return out.withColumn("status", F.when(F.col("is_finished"), "FINISHED").otherwise("SCHEDULED")).drop("location_id")


def stg_openliga_goals(spark: SparkSession, lake: str) -> DataFrame:
    return openliga_table(spark, lake, "goals").join(stg_openliga_matches(spark, lake).select("match_id"), "match_id", "left_semi")


def stg_players_of_teams(spark: SparkSession, lake: str) -> DataFrame:
    """Squads with the competition of the path, else of the body."""
    m = MODELS["stg_football_data_org_players"]
    fields = m.fields + "\n        body_comp string @0$.competition.code\n        path_comp string path:comp"
    docs = read_json_docs(spark, f"{lake.rstrip('/')}/{m.glob}")
    df = project(*explode_levels(docs, m.explode), Model(m.glob, fields, m.keys, m.require, m.explode))
    return _merge(df, {"competition_code": ("path_comp", "body_comp")})


SPECIAL = {
    "stg_football_data_co_uk": stg_football_data_co_uk,
    "stg_football_data_org_players": stg_players_of_teams,
    "stg_football_news": stg_football_news,
    "stg_odds_base": stg_odds_base,
    **{f"stg_odds_{m}": (lambda s, lake, m=m: odds_market(stg_odds_base(s, lake), m)) for m in ("h2h", "spreads", "totals")},
    "stg_open_meteo": stg_open_meteo,
    "stg_open_meteo_forecast": lambda s, lake: stg_open_meteo(s, lake, "forecast", "forecast_issued_date").drop("latitude", "longitude"),
    "stg_physioroom": stg_physioroom,
    "stg_understat_shots": stg_understat_shots,
    "stg_wikidata": stg_wikidata,
    "stg_wikidata_clubs": _wikidata("pl_clubs", {"club_qid": ("qid", "club"), "club_name": ("text", "clubLabel"), "inception_date": ("date", "inception"), "venue_qid": ("qid", "venue"), "venue_name": ("text", "venueLabel"), "venue_capacity": ("int", "capacity"), "venue_lat": ("lat", "coord"), "venue_lon": ("lon", "coord"), "coach_name": ("text", "coachLabel"), "website_url": ("text", "websiteURL")}),
    "stg_wikidata_managers": _wikidata("pl_managers", {"club_qid": ("qid", "club"), "club_name": ("text", "clubLabel"), "coach_qid": ("qid", "coach"), "coach_name": ("text", "coachLabel"), "coach_date_of_birth": ("date", "coachDob"), "coach_country": ("text", "coachCountryLabel")}),
    "stg_wikidata_players": _wikidata("pl_players", {"player_qid": ("qid", "player"), "player_name": ("text", "playerLabel"), "club_name": ("text", "clubLabel"), "date_of_birth": ("date", "dob"), "height_cm": ("double", "height"), "country": ("text", "countryLabel"), "position": ("text", "positionLabel"), "sex": ("text", "sexLabel")}),
    "stg_wikidata_stadiums": _wikidata("pl_stadiums", {"venue_qid": ("qid", "venue"), "venue_name": ("text", "venueLabel"), "capacity": ("int", "capacity"), "lat": ("lat", "coord"), "lon": ("lon", "coord"), "opened_date": ("date", "opened"), "city": ("text", "cityLabel"), "country": ("text", "countryLabel")}),
    **{f"stg_openliga_{t}": (lambda s, lake, t=t: openliga_table(s, lake, t)) for t in ("groups", "leagues", "locations", "match_results", "teams")},
    "stg_openliga_matches": stg_openliga_matches,
    "stg_openliga_goals": stg_openliga_goals,
}
NAMES = sorted({*MODELS, *SPECIAL})
