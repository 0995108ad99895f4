"""Conformed core: aliases, sightings, dimensions, one row per real match, and its perspectives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions import exprs as X
from tarn.operators import reshape as R
from tarn.operators.resolve import alias_dictionary, link_unique, mapped_flag, resolve_alias, small, source_ids, survive, unmapped_report
from tarn.operators.snapshot import latest

# The codes by which each source names a competition.
COMPETITIONS = [
    ("EPL", "Premier League", "England", 1, "PL", "E0", "EPL", 39, "soccer_epl", "EPL", None),
    ("CHAMPIONSHIP", "EFL Championship", "England", 2, "ELC", "E1", None, 40, None, "Championship", None),
    ("LALIGA", "La Liga", "Spain", 1, "PD", "SP1", "La_Liga", 140, "soccer_spain_la_liga", "LaLiga", None),
    ("BUNDESLIGA", "Bundesliga", "Germany", 1, "BL1", "D1", "Bundesliga", 78, "soccer_germany_bundesliga", "Bundesliga", "bl1"),
    ("SERIEA", "Serie A", "Italy", 1, "SA", "I1", "Serie_A", 135, "soccer_italy_serie_a", None, None),
    ("LIGUE1", "Ligue 1", "France", 1, "FL1", "F1", "Ligue_1", 61, "soccer_france_ligue_one", None, None),
    ("UCL", "UEFA Champions League", "Europe", 0, "CL", None, None, 2, None, None, None),
    ("RFPL", "Russian Premier League", "Russia", 1, None, None, "RFPL", 235, None, None, None),
]
COMPETITION_SCHEMA = "competition_key string, competition_name string, country string, tier int, fdo_code string, couk_division string, understat_league string, api_football_league_id int, odds_sport_key string, thesportsdb_slug string, openliga_shortcut string"
# Shortcuts of test leagues in the source, which are left out.
TEST_LEAGUES = ["test-del", "goalunited23", "bulimo", "klb", "essl", "blclaude", "tst1"]


def dim_competition(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(COMPETITIONS, COMPETITION_SCHEMA))


def with_competition(df: DataFrame, code: str, comp: DataFrame, comp_code: str, upper: bool = False) -> DataFrame:
    """Adds competition_key from a source's code; an unknown code stays itself."""
    c = comp.select(F.col(comp_code).alias("_code"), F.col("competition_key").alias("_ck")).filter("_code is not null")
    own = F.col(code).cast("string")
    return df.join(F.broadcast(c), F.col(code) == F.col("_code"), "left").withColumn("competition_key", F.coalesce("_ck", F.upper(own) if upper else own)).drop("_code", "_ck")


def plausible_matches(df: DataFrame, sport: int = 1, since: str = "2000-01-01") -> DataFrame:
    """Two different sides, the right sport, a time that is no placeholder, no test league."""
    return df.filter(
        (F.col("sport_id") == sport) & F.col("home_team_id").isNotNull() & F.col("away_team_id").isNotNull() & (F.col("home_team_id") != F.col("away_team_id"))
        & (F.trim("home_team") != F.trim("away_team")) & (F.col("match_time_utc") >= F.lit(since).cast("timestamp_ntz")) & ~F.lower("league_shortcut").isin(TEST_LEAGUES)
    )


SIGHTING = ["source", "prio", "source_team_id", "raw_name", "short_name", "tla", "founded", "country", "venue_name", "venue_city", "venue_capacity", "logo_url", "badge_url", "website", "club_colors", "coach_name"]
PLAYER_SIGHTING = ["source", "prio", "source_player_id", "player_name", "last_name_hint", "dob", "nationality", "position", "team_name_raw", "height_cm", "photo_url", "season", "league"]
_KIND = {"prio": "int", "founded": "int", "venue_capacity": "int", "dob": "date", "height_cm": "int", "season": "int"}


def sightings(schema: list[str], parts: list[tuple[str, int, DataFrame, dict[str, Column | str]]], name: str) -> DataFrame:
    """(source, prio, ...) of all parts in one schema; attributes that a source lacks are null."""
    out = None
    for source, prio, df, cols in parts:
        fixed = {"source": F.lit(source), "prio": F.lit(prio)}
        one = df.select(*[(fixed.get(c) if c in fixed else X.col(cols[c]) if c in cols else F.lit(None)).cast(_KIND.get(c, "string")).alias(c) for c in schema])
        out = one if out is None else out.unionByName(one)
    return out.filter(F.trim(name) != "")


def team_sightings(t: dict[str, DataFrame], alias: DataFrame) -> DataFrame:
    """Nine occurrences of teams in seven sources, by priority, with their key."""
    def both(df: DataFrame, ident: str | None, name: str, code: str | None = None) -> DataFrame:
        c = F.col
        none = F.lit(None).cast("string")
        pick = lambda s: {"id": c(ident.format(s)).cast("string") if ident else none, "n": c(name.format(s)), "t": c(code.format(s)) if code else none}
        return R.two_sides(df, pick("home"), pick("away"), []).select("id", "n", "t").distinct()

    parts = [
        ("fdo", 1, t["stg_football_data_org_teams"], {"source_team_id": "team_id", "raw_name": "name", "short_name": "short_name", "tla": "tla", "founded": "founded", "country": "area", "venue_name": "venue", "club_colors": "club_colors", "coach_name": "coach_name"}),
        ("fdo", 1, both(t["stg_football_data_org_matches"], "{}_team_id", "{}_team", "{}_tla"), {"source_team_id": "id", "raw_name": "n", "tla": "t"}),
        ("api_football", 2, t["stg_teams"], {"source_team_id": "team_id", "raw_name": "name", "tla": "code", "founded": "founded", "country": "country", "venue_name": "venue_name", "venue_city": "venue_city", "venue_capacity": "venue_capacity", "logo_url": "logo_url"}),
        ("api_football", 2, both(t["stg_fixtures"], "{}_team_id", "{}_team_name"), {"source_team_id": "id", "raw_name": "n"}),
        ("thesportsdb", 3, t["stg_thesportsdb_teams"], {"source_team_id": "team_id", "raw_name": "team_name", "short_name": "team_short", "founded": "formed_year", "country": "country", "venue_name": "stadium", "venue_city": "stadium_location", "venue_capacity": "stadium_capacity", "badge_url": "badge_url", "website": "website"}),
        ("wikidata", 4, t["stg_wikidata_clubs"], {"source_team_id": "club_qid", "raw_name": "club_name", "founded": F.year("inception_date"), "venue_name": "venue_name", "venue_capacity": "venue_capacity", "website": "website_url", "coach_name": "coach_name"}),
        ("understat", 5, t["stg_understat_teams"].select("team_id", "team_name").distinct(), {"source_team_id": "team_id", "raw_name": "team_name"}),
        ("football_data_co_uk", 6, both(t["stg_football_data_co_uk"], None, "{}_team"), {"raw_name": "n"}),
        ("openliga", 7, t["stg_openliga_teams"], {"source_team_id": "team_id", "raw_name": "team_name", "short_name": "short_name", "logo_url": "icon_url"}),
    ]
    parts = [p for p in parts if p[2] is not None]
    s = sightings(SIGHTING, parts, "raw_name")
    return mapped_flag(resolve_alias(s, "raw_name", alias, "team_key"), "raw_name", alias)


def dim_venue(stadiums: DataFrame, alias: DataFrame) -> DataFrame:
    v = stadiums.filter("venue_qid is not null").groupBy("venue_qid").agg(F.min("venue_name").alias("venue_name"), F.max("capacity").alias("capacity"), F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.min("opened_date").alias("opened_date"), F.min("city").alias("city"), F.min("country").alias("country"))
    return resolve_alias(v, "venue_name", alias, "team_key", strict=True).withColumn("openmeteo_venue_key", F.regexp_replace("venue_name", "[ /]", "_"))


def dim_team(seen: DataFrame, venues: DataFrame) -> DataFrame:
    s = seen.filter("team_key is not null").withColumnsRenamed({"venue_name": "stadium_name", "venue_city": "stadium_city", "venue_capacity": "stadium_capacity"})
    attrs = ["short_name", "tla", "country", "founded", "stadium_name", "stadium_city", "stadium_capacity", "logo_url", "badge_url", "website", "club_colors", "coach_name"]
    ids = source_ids(s, ["team_key"], "source", "source_team_id", ["fdo", "api_football", "thesportsdb", "understat", "wikidata"])
    more = s.groupBy("team_key").agg(F.bool_or("is_mapped").alias("in_alias_seed"), F.count_distinct("source").alias("n_sources"))
    home = latest(venues.filter("team_key is not null"), ["team_key"], [F.desc_nulls_last("capacity"), F.asc("venue_qid")])
    home = home.select("team_key", "venue_qid", F.col("lat").alias("venue_lat"), F.col("lon").alias("venue_lon"), "openmeteo_venue_key")
    return survive(s, ["team_key"], "prio", attrs).join(ids, "team_key").join(more, "team_key").join(home, "team_key", "left").withColumn("team_name", F.col("team_key"))


def player_sightings(t: dict[str, DataFrame], alias: DataFrame) -> DataFrame:
    full = F.coalesce(X.blank_to_null(F.concat_ws(" ", "firstname", "lastname")), F.col("name"))
    cm = F.when(F.col("height_cm") < 3, F.col("height_cm") * 100).otherwise(F.col("height_cm"))
    last_team = F.element_at(F.split("team_name", ","), -1)
    parts = [
        ("fdo", 1, t["stg_football_data_org_players"], {"source_player_id": "player_id", "player_name": "name", "dob": "date_of_birth", "nationality": "nationality", "position": "position", "team_name_raw": "team_name"}),
        ("api_football", 2, t["stg_players"], {"source_player_id": "player_id", "player_name": full, "last_name_hint": "lastname", "dob": "birth_date", "nationality": "nationality", "position": "position", "team_name_raw": "team_name", "height_cm": F.regexp_extract("height", r"(\d+)", 1).try_cast("int"), "photo_url": "photo_url", "season": "season"}),
        ("wikidata", 3, t["stg_wikidata_players"], {"source_player_id": "player_qid", "player_name": "player_name", "dob": "date_of_birth", "nationality": "country", "position": "position", "team_name_raw": "club_name", "height_cm": cm}),
        ("thesportsdb", 4, t["stg_thesportsdb_players"], {"source_player_id": "player_id", "player_name": "player_name", "dob": "birth_date", "nationality": "nationality", "position": "position"}),
        ("understat", 5, t["stg_understat_players"], {"source_player_id": "player_id", "player_name": "player_name", "position": "position", "team_name_raw": last_team, "season": "season", "league": "league"}),
    ]
    s = sightings(PLAYER_SIGHTING, [p for p in parts if p[2] is not None], "player_name")
    s = s.withColumns({"name_norm": X.name_norm("player_name"), "last_norm": X.last_word(X.name_norm(F.coalesce("last_name_hint", "player_name")))})
    return resolve_alias(s, "team_name_raw", alias, "team_key")


def player_keys(s: DataFrame, undated: str = "understat") -> DataFrame:
    """Adds player_key: by birth date and last name; undated sightings link to the only dated player of
    their name, or of their last name and team; others get a key of their source."""
    s = s.withColumn("key_dob", F.when(F.col("dob").isNotNull(), F.concat(F.lit("p_"), F.left(F.md5(F.concat_ws("|", F.col("dob").cast("string"), "last_norm")), F.lit(16)))))
    dated = s.filter("key_dob is not null").select("key_dob", "name_norm", "last_norm", "team_key").distinct()
    asks = s.filter(F.col("source") == undated).select("source_player_id", "name_norm", "last_norm", "team_key").distinct()
    link = link_unique(asks, dated, "source_player_id", "key_dob", [(["name_norm"], ["name_norm"]), (["last_norm", "team_key"], ["last_norm", "team_key"])])
    link = link.select(F.lit(undated).alias("source"), "source_player_id", F.col("key_dob").alias("_linked"))
    out = s.join(link, ["source", "source_player_id"], "left")
    return out.withColumns({"player_key": F.coalesce("key_dob", "_linked", F.concat_ws("_", "source", "source_player_id")), "matched_by_name": F.col("key_dob").isNull() & F.col("_linked").isNotNull()}).drop("_linked")


def dim_player(keys: DataFrame) -> DataFrame:
    s = keys.withColumnsRenamed({"dob": "date_of_birth", "team_key": "current_team_key"})
    attrs = ["player_name", "name_norm", "date_of_birth", "nationality", "position", "current_team_key", "height_cm", "photo_url"]
    ids = source_ids(s, ["player_key"], "source", "source_player_id", ["fdo", "api_football", "wikidata", "thesportsdb", "understat"])
    ids = ids.withColumnsRenamed({"fdo_id": "fdo_player_id", "api_football_id": "api_football_player_id", "wikidata_id": "wikidata_qid", "thesportsdb_id": "thesportsdb_player_id", "understat_id": "understat_player_id"})
    n = s.groupBy("player_key").agg(F.count_distinct("source").alias("n_sources")).withColumn("is_matched_across_sources", F.col("n_sources") > 1)
    return survive(s, ["player_key"], "prio", attrs).join(ids, "player_key").join(n, "player_key")


def _keyed(df: DataFrame, alias: DataFrame, home: str, away: str, order: str) -> DataFrame:
    """Home, away and match keys, the score as text, and one row per match."""
    df = resolve_alias(resolve_alias(df, home, alias, "home_key"), away, alias, "away_key")
    df = df.withColumn("match_key", X.key_of("home_key", "away_key", "match_date")).withColumn("score_str", F.concat(F.col("home_goals").cast("string"), F.lit("-"), F.col("away_goals").cast("string")))
    return latest(df, ["match_key"], [F.asc_nulls_last(order)])


GOALS = ["home_goals", "away_goals"]
HALF = ["ht_home_goals", "ht_away_goals"]
STATS = [f"{s}_{m}" for m in ("shots", "shots_target", "corners", "fouls", "yellows", "reds") for s in ("home", "away")]


def match_sources(t: dict[str, DataFrame], alias: DataFrame, comp: DataFrame) -> dict[str, DataFrame]:
    """The five sources of matches in their priority, with common names, one row per match each."""
    out: dict[str, DataFrame] = {}
    if t.get("stg_football_data_org_matches") is not None:
        m = with_competition(t["stg_football_data_org_matches"].filter("utc_date is not null"), "competition_code", comp, "fdo_code", True)
        m = m.withColumns({"match_date": F.to_date("utc_date"), "kickoff_utc": F.col("utc_date"), "fdo_match_id": F.col("match_id").cast("string"), "done": F.col("status") == "FINISHED"})
        out["fdo"] = _keyed(m, alias, "home_team", "away_team", "kickoff_utc")
    if t.get("stg_football_data_co_uk") is not None:
        m = with_competition(t["stg_football_data_co_uk"].filter("match_date is not null"), "division", comp, "couk_division")
        local = F.to_timestamp_ntz(F.concat_ws(" ", F.col("match_date").cast("string"), F.col("match_time")), F.lit("yyyy-MM-dd HH:mm"))
        kick = F.when(F.col("match_time").rlike(r"^\d{2}:\d{2}$"), F.convert_timezone(F.lit("Europe/London"), F.lit("UTC"), local))
        m = m.withColumns({"kickoff_utc": kick, "done": F.col("home_goals").isNotNull()})
        out["couk"] = _keyed(m, alias, "home_team", "away_team", "match_date")
    if t.get("stg_understat_matches") is not None:
        m = with_competition(t["stg_understat_matches"].filter("match_date is not null"), "league", comp, "understat_league")
        m = m.withColumns({"match_date": F.to_date("match_date"), "understat_match_id": F.col("match_id").cast("string"), "done": F.coalesce("is_result", F.lit(False))})
        out["understat"] = _keyed(m, alias, "home_team_name", "away_team_name", "match_date")
    if t.get("stg_fixtures") is not None:
        m = with_competition(t["stg_fixtures"].filter("fixture_date is not null"), "league_id", comp, "api_football_league_id")
        m = m.withColumns({"match_date": F.to_date("fixture_date"), "kickoff_utc": F.col("fixture_date"), "af_fixture_id": F.col("fixture_id").cast("string"), "af_round": F.col("round"), "done": F.coalesce(F.col("status_short").isin("FT", "AET", "PEN"), F.lit(False))}).drop(*HALF)
        out["api_football"] = _keyed(m, alias, "home_team_name", "away_team_name", "kickoff_utc")
    if t.get("stg_openliga_matches") is not None:
        m = with_competition(plausible_matches(t["stg_openliga_matches"]), "league_shortcut", comp, "openliga_shortcut", True)
        m = m.withColumns({"match_date": F.to_date("match_time_utc"), "kickoff_utc": F.col("match_time_utc"), "openliga_match_id": F.col("match_id").cast("string"), "matchday": F.col("group_order"), "done": F.col("is_finished") & F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()})
        out["openliga"] = _keyed(m, alias, "home_team", "away_team", "kickoff_utc")
    return out


# Which sources give an attribute, in order of priority.
GIVEN = {
    "competition_key": ("fdo", "couk", "understat", "api_football", "openliga"), "kickoff_utc": ("fdo", "couk", "api_football", "openliga"), "status": ("fdo", "openliga"), "stage": ("fdo",), "matchday": ("fdo", "openliga"),
    "af_round": ("api_football",), "referee": ("fdo", "couk", "api_football"), "venue_name": ("api_football", "openliga"), **dict.fromkeys(GOALS, ("fdo", "couk", "understat", "api_football", "openliga")), **dict.fromkeys(HALF, ("fdo", "couk", "openliga")),
    **dict.fromkeys(STATS, ("couk",)), **{f"{b}_{s}": ("couk",) for b in ("b365", "avg", "max") for s in ("home", "draw", "away")}, **dict.fromkeys(("home_xg", "away_xg", "forecast_home_win", "forecast_draw", "forecast_away_win"), ("understat",)),
    "fdo_match_id": ("fdo",), "understat_match_id": ("understat",), "af_fixture_id": ("api_football",), "openliga_match_id": ("openliga",),
}
TYPES = {"kickoff_utc": "timestamp_ntz", **dict.fromkeys([*GOALS, *HALF, *STATS, "matchday"], "int"), **{k: "double" for k in GIVEN if k.startswith(("b365", "avg", "max", "forecast")) or k.endswith("_xg")}}


def consolidate(sources: dict[str, DataFrame], quotes: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """One row per real match: the union of all keys, attributes by source priority, conflict flag.

    All joins are on the same key, so its one partitioning serves them all.
    """
    names = order or list(sources)
    spine = None
    for n in names:
        one = sources[n].select("match_key", "match_date", "home_key", "away_key")
        spine = one if spine is None else spine.unionByName(one)
    out = spine.filter("home_key <> away_key").groupBy("match_key").agg(F.min("match_date").alias("match_date"), F.min("home_key").alias("home_key"), F.min("away_key").alias("away_key"))
    for n in names:
        cols = [c for c, given in GIVEN.items() if n in given and c in sources[n].columns]
        s = sources[n].select("match_key", *[F.col(c).cast(TYPES.get(c, "string")).alias(f"{n}__{c}") for c in cols], F.col("score_str").alias(f"{n}__score"), F.col("done").alias(f"{n}__done"), F.lit(True).alias(f"in_{n}"))
        out = out.join(s, "match_key", "left")
    have = set(out.columns)
    picked = []
    for c, given in GIVEN.items():
        found = [F.col(f"{n}__{c}") for n in given if f"{n}__{c}" in have]
        picked.append((F.coalesce(*found) if found else F.lit(None).cast(TYPES.get(c, "string"))).alias(c))
    done = F.lit(False)
    for n in names:
        done = done | F.coalesce(f"{n}__done", F.lit(False))
    flags = [(F.coalesce(f"in_{n}", F.lit(False)) if n in names else F.lit(False)).alias(f"in_{n}") for n in ("fdo", "couk", "understat", "api_football", "openliga")]
    out = out.select("match_key", "match_date", "home_key", "away_key", *picked, done.alias("is_finished"), X.n_distinct_in_row(*[f"{n}__score" for n in names]).alias("_scores"), *flags)
    h, a, fin = F.col("home_goals"), F.col("away_goals"), F.col("is_finished")
    result = F.when(fin & h.isNotNull(), F.when(h > a, "H").when(h == a, "D").otherwise("A"))
    out = out.withColumns({"result": result, "total_goals": F.when(fin, h + a), "goals_conflict": F.col("_scores") > 1, "season": X.season_of("match_date")})
    out = out.withColumns({c: F.when(fin, F.col(c)) for c in GOALS}).drop("_scores").withColumnsRenamed({f"{b}_{s}": f"mkt_{b}_{s}" for b in ("avg", "max") for s in ("home", "draw", "away")})
    if quotes is not None:
        out = out.join(quotes, "match_key", "left").withColumn("in_odds_api", F.col("odds_api_n_bookmakers").isNotNull())
    return out


def odds_by_match(h2h: DataFrame, alias: DataFrame) -> DataFrame:
    q = resolve_alias(resolve_alias(h2h.withColumn("match_date", F.to_date("commence_time")), "home_team", alias, "home_key"), "away_team", alias, "away_key")
    avg = {s: F.avg(F.when(F.col("outcome_type") == s, F.col("price"))).alias(f"odds_api_{s}") for s in ("home", "draw", "away")}
    return q.groupBy(X.key_of("home_key", "away_key", "match_date").alias("match_key")).agg(*avg.values(), F.count_distinct("bookmaker_key").alias("odds_api_n_bookmakers"), F.max("last_update").alias("odds_api_updated_at"))


def with_weather(matches: DataFrame, teams: DataFrame, weather: DataFrame) -> DataFrame:
    """The weather at the home ground in the local hour of kick-off."""
    zones = weather.groupBy("venue_name").agg(F.min("timezone").alias("_tz"))
    ground = teams.select(F.col("team_key").alias("home_key"), "openmeteo_venue_key").join(zones, F.col("openmeteo_venue_key") == zones["venue_name"]).select("home_key", "openmeteo_venue_key", "_tz")
    hour = F.date_trunc("hour", F.convert_timezone(F.lit("UTC"), F.col("_tz"), F.col("kickoff_utc"))).cast("timestamp_ntz")
    m = matches.join(small(ground), "home_key", "left").withColumn("_hour", hour)
    w = weather.select(F.col("venue_name").alias("openmeteo_venue_key"), F.col("weather_time").alias("_hour"), F.col("temperature_c").alias("weather_temp_c"), F.col("precipitation_mm").alias("weather_precip_mm"), F.col("windspeed_kmh").alias("weather_wind_kmh"), F.col("humidity_pct").alias("weather_humidity_pct"), "weather_code", F.lit(True).alias("_w"))
    return m.join(w, ["openmeteo_venue_key", "_hour"], "left").withColumn("has_weather", F.col("_w").isNotNull()).drop("_w", "_hour", "_tz")


SIDE = {"goals": ("goals_for", "goals_against"), "xg": ("xg_for", "xg_against")}


def fact_team_match(matches: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Two rows per match out of one scan, with points and the advanced statistics of team, day and side."""
    def view(own: str, other: str) -> dict[str, Column]:
        c = F.col
        return {"team_key": c(f"{own}_key"), "opponent_key": c(f"{other}_key"), "goals_for": c(f"{own}_goals"), "goals_against": c(f"{other}_goals"), "xg_for": c(f"{own}_xg"), "xg_against": c(f"{other}_xg"), **{m: c(f"{own}_{m}") for m in ("shots", "shots_target", "corners", "fouls", "yellows", "reds")}}

    s = R.two_sides(matches, view("home", "away"), view("away", "home"), ["match_key", "competition_key", "season", "match_date", "kickoff_utc", "is_finished"])
    gf, ga = F.col("goals_for"), F.col("goals_against")
    s = s.withColumns({"team_match_key": F.concat_ws("|", "match_key", "side"), "points": F.when(F.col("is_finished") & gf.isNotNull(), F.when(gf > ga, 3).when(gf == ga, 1).otherwise(0))})
    extra = ["ppda_att", "ppda_def", "deep", "deep_allowed", "xpts", "npxg", "npxga"]
    if history is None:
        return s.withColumns({c: F.lit(None).cast("double") for c in extra})
    h = latest(history.withColumns({"side": F.col("home_away"), "_at": F.col("match_date"), "match_date": F.to_date("match_date")}), ["team_key", "match_date", "side"], [F.asc("_at")])
    return s.join(h.select("team_key", "match_date", "side", *extra), ["team_key", "match_date", "side"], "left")


def fact_goal(goals: DataFrame, ol_matches: DataFrame, matches: DataFrame, teams: DataFrame, alias: DataFrame) -> DataFrame:
    m = ol_matches.select("match_id", "home_team_id", "away_team_id")
    fm = matches.select(F.col("openliga_match_id").alias("_oid"), "match_key", "competition_key", "season", "match_date")
    g = goals.join(m, "match_id").join(fm, F.col("match_id").cast("string") == F.col("_oid")).join(teams.select(F.col("team_id").alias("scoring_team_id"), "team_name"), "scoring_team_id", "left")
    g = resolve_alias(g, "team_name", alias, "scoring_team_key")
    side = F.when(F.col("scoring_team_id") == F.col("home_team_id"), "home").when(F.col("scoring_team_id") == F.col("away_team_id"), "away")
    return g.select("goal_id", "match_key", "competition_key", "season", "match_date", "minute", "scorer_id", "scorer_name", "scoring_team_key", side.alias("scoring_side"), "is_penalty", "is_own_goal", "is_overtime", F.col("score_team1").alias("home_score_after"), F.col("score_team2").alias("away_score_after"))


def fact_player_season(stats: DataFrame, keys: DataFrame, alias: DataFrame, comp: DataFrame) -> DataFrame:
    k = keys.filter("source = 'understat'").select("source_player_id", "player_key").distinct()
    p = stats.join(k, F.col("player_id").cast("string") == F.col("source_player_id"))
    p = with_competition(p, "league", comp, "understat_league").withColumn("_team", F.element_at(F.split("team_name", ","), -1))
    p = resolve_alias(p, "_team", alias, "team_key")
    p = latest(p, ["player_key", "competition_key", "season", "team_key"], [F.desc_nulls_last("minutes_played"), F.asc("player_id")])
    per = {f"{m}_per90": X.per_90(m, "minutes_played") for m in ("goals", "xg", "xa")}
    return p.withColumnRenamed("team_name", "team_names_raw").withColumns(per).drop("_team", "source_player_id", "player_id", "league", "ingest_date", "player_name")


def audit_unmapped(parts: dict[str, tuple[DataFrame, list[str]]], alias: DataFrame) -> DataFrame:
    """(source, raw_name, n_rows) of team names that no alias knows."""
    names = None
    for source, (df, cols) in parts.items():
        one = df.select(F.lit(source).alias("source"), F.explode(F.array(*cols)).alias("name"))
        names = one if names is None else names.unionByName(one)
    return unmapped_report(names, "name", "source", alias)


def aliases(seed: DataFrame, not_entities: list[str] | None = None) -> DataFrame:
    return alias_dictionary(seed, not_entities)
