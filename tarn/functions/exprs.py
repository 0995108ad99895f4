"""Column expressions: names, dates, numbers, places, odds and text."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Composed Latin letters and their base letters, by canonical decomposition."""
    src, dst = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFD", chr(cp))
        if marks and all(unicodedata.combining(m) for m in marks):
            src.append(chr(cp))
            dst.append(base)
    return "".join(src), "".join(dst)


ACCENTED, PLAIN = _accent_table()


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c: Column | str) -> Column:
    """Base letters without combining marks; letters without a decomposition stay."""
    return F.regexp_replace(F.translate(col(c), ACCENTED, PLAIN), r"[̀-ͯ]", "")


def name_norm(c: Column | str, ascii_only: bool = False) -> Column:
    """Lower-case a-z words of a name. ascii_only: drop other letters instead of making them spaces."""
    x = strip_accents(F.lower(strip_accents(c)))
    if ascii_only:
        x = F.regexp_replace(x, r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^a-z ]", " "), r" +", " "))


def last_word(c: Column | str) -> Column:
    return F.element_at(F.split(col(c), " "), -1)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def key_of(*parts: Column | str) -> Column:
    """md5 of the lower-cased parts joined by a bar; null parts are empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.lower(col(p).cast("string")), F.lit("")) for p in parts]))


def season_of(d: Column | str, month: int = 7) -> Column:
    """Year in which the season of a date began."""
    d = col(d)
    return F.when(F.month(d) >= month, F.year(d)).otherwise(F.year(d) - 1)


def season_label(season: Column | str) -> Column:
    s = col(season)
    return F.concat(s.cast("string"), F.lit("/"), F.lpad(((s + 1) % 100).cast("string"), 2, "0"))


def season_code(season: Column | str) -> Column:
    s = col(season)
    return F.concat(F.lpad((s % 100).cast("string"), 2, "0"), F.lpad(((s + 1) % 100).cast("string"), 2, "0"))


def day_of_week_sunday0(d: Column | str) -> Column:
    return F.dayofweek(col(d)) - 1


def iso_day_of_week(d: Column | str) -> Column:
    return F.weekday(col(d)) + 1


def month_end(d: Column | str, months: int = 0) -> Column:
    return F.last_day(F.add_months(col(d), months))


def age_years(born: Column | str, at: Column | str) -> Column:
    return F.datediff(col(at), col(born)) / 365.25


def local_to_utc(ts: Column | str, zone: str) -> Column:
    return F.to_utc_timestamp(col(ts), zone)


def utc_to_local(ts: Column | str, zone: Column | str) -> Column:
    return F.from_utc_timestamp(col(ts), zone)


def parse_rfc822(c: Column | str) -> Column:
    """``Tue, 03 Feb 2026 10:11:12 GMT`` as a timestamp in UTC; null if it cannot be read."""
    text = F.trim(F.regexp_replace(F.regexp_replace(col(c), r"^[A-Za-z]{3},\s*", ""), r"\s*(GMT|UTC|[+-]0000)$", ""))
    return F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz")


def parse_day_first(c: Column | str) -> Column:
    """dd/mm/yyyy or dd/mm/yy."""
    c = F.trim(col(c))
    return F.coalesce(F.when(F.length(c) == 10, F.try_to_timestamp(c, F.lit("dd/MM/yyyy"))), F.when(F.length(c) == 8, F.try_to_timestamp(c, F.lit("dd/MM/yy")))).cast("date")


def parse_compact(c: Column | str) -> Column:
    """The date in the first eight digits, yyyymmdd."""
    return F.try_to_timestamp(F.left(col(c), F.lit(8)), F.lit("yyyyMMdd")).cast("date")


def to_number(c: Column | str) -> Column:
    """Number of a text with a percent sign or unit after it."""
    return F.regexp_replace(F.trim(col(c)), r"\s*(%|[A-Za-z]+)$", "").try_cast("double")


def coalesce_priority(*cols: Column | str) -> Column:
    return F.coalesce(*[col(c) for c in cols])


def n_distinct_in_row(*cols: Column | str) -> Column:
    """How many different non-null values the columns of a row hold."""
    return F.size(F.array_distinct(F.array_compact(F.array(*[col(c) for c in cols]))))


def guard(flag: Column | str, cols: Iterable[str]) -> list[Column]:
    """Each column only where ``flag`` holds, null elsewhere."""
    return [F.when(col(flag), F.col(c)).alias(c) for c in cols]


def pair_metrics(metrics: Iterable[str], home: str = "home_", away: str = "away_") -> list[Column]:
    """total, difference and presence flags of home/away pairs; null unless both sides are there."""
    out = []
    for m in metrics:
        h, a = F.col(f"{home}{m}"), F.col(f"{away}{m}")
        out += [(h + a).alias(f"total_{m}"), (h - a).alias(f"diff_{m}"), (h.isNotNull() & a.isNotNull()).alias(f"has_{m}_pair"), F.when(h.isNotNull() & a.isNotNull(), (h >= 0) & (a >= 0)).alias(f"valid_{m}_pair")]
    return out


def fan_out(metrics: Iterable[str], home: str = "h", away: str = "a", prefix: str = "f_") -> list[Column]:
    """home_, away_ and diff_ columns of each metric out of two joined copies of a table."""
    out = []
    for m in metrics:
        base = m.removeprefix(prefix)
        h, a = F.col(f"{home}.{m}"), F.col(f"{away}.{m}")
        out += [h.alias(f"{prefix}home_{base}"), a.alias(f"{prefix}away_{base}"), (h - a).alias(f"{prefix}diff_{base}")]
    return out


def first_present(df: DataFrame, candidates: Iterable[str], kind: str = "string") -> Column:
    """The first of the columns that exists; a null column if none does."""
    for c in candidates:
        if c in df.columns:
            return F.col(c)
    return F.lit(None).cast(kind)


def timeline_bucket(d: Column | str, today: Column | str) -> Column:
    n = F.datediff(col(d), col(today))
    return F.when(n < 0, "past").when(n == 0, "today").when(n == 1, "tomorrow").when(n <= 7, "next 7 days").otherwise("later")


def prob_summary(home: Column | str, draw: Column | str, away: Column | str) -> Column:
    """``H 50.0% | D 30.0% | A 20.0%``."""
    return F.concat_ws(" | ", *[F.concat(F.lit(k), F.format_number(100 * col(c), 1), F.lit("%")) for k, c in (("H ", home), ("D ", draw), ("A ", away))])


def pitch_distance(x: Column | str, y: Column | str, length: float = 105, width: float = 68) -> Column:
    """Metres to the goal's centre from relative pitch coordinates."""
    return F.sqrt(F.pow((1 - col(x)) * length, 2) + F.pow((col(y) - 0.5) * width, 2))


def shot_angle(x: Column | str, y: Column | str, length: float = 105, width: float = 68, goal: float = 7.32) -> Column:
    """Angle in radians under which the goal is seen."""
    dx, dy = (1 - col(x)) * length, (col(y) - 0.5) * width
    return F.abs(F.atan2(goal * dx, F.pow(dx, 2) + F.pow(dy, 2) - (goal / 2) ** 2))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    """Distance by the clamped arc cosine."""
    a, b, c, d = (F.radians(col(x)) for x in (lat1, lat2, lon1, lon2))
    return radius * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(d - c))))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    a, b, c, d = (F.radians(col(x)) for x in (lat1, lat2, lon1, lon2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((d - c) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def implied_prob(odds: Iterable[Column | str], which: int) -> Column:
    """Probability of outcome ``which`` without the bookmaker's margin; null unless all odds exceed one."""
    cs = [col(c) for c in odds]
    ok = cs[0] > 1
    for c in cs[1:]:
        ok = ok & (c > 1)
    return F.when(ok, (1 / cs[which]) / sum((1 / c for c in cs[1:]), 1 / cs[0]))


def overround(odds: Iterable[Column | str]) -> Column:
    cs = [col(c) for c in odds]
    return sum((1 / c for c in cs[1:]), 1 / cs[0]) - 1


def ratio(num: Column | str, den: Column | str, digits: int | None = None) -> Column:
    """num / den, null where den is null or 0."""
    r = col(num) / F.nullif(col(den), F.lit(0))
    return r if digits is None else F.round(r, digits)


def per_90(value: Column | str, minutes: Column | str, digits: int = 3) -> Column:
    return F.when(col(minutes) > 0, F.round(col(value) * 90.0 / col(minutes), digits))


def form_points_rate(form: Column | str) -> Column:
    """Share of the points that a string of W, D and L has won."""
    f = col(form)
    n = F.regexp_count(f, F.lit("[WDL]"))
    return (3 * F.regexp_count(f, F.lit("W")) + F.regexp_count(f, F.lit("D"))) / F.nullif(3 * n, F.lit(0))


def game_state(minute: Column | str, side: Column | str, home_after: Column | str, away_after: Column | str) -> dict[str, Column]:
    """Score before a goal and what the goal did: lead, equaliser, go-ahead, late."""
    m, s, h, a = col(minute), col(side), col(home_after), col(away_after)
    hb = F.when(s == "home", h - 1).when(s == "away", h)
    ab = F.when(s == "away", a - 1).when(s == "home", a)
    own_before = F.when(s == "home", hb - ab).otherwise(ab - hb)
    return {
        "home_before": hb,
        "away_before": ab,
        "minute_bucket": F.least(F.floor(F.greatest(m, F.lit(0)) / 15), F.lit(5)),
        "is_equaliser": own_before == -1,
        "is_go_ahead": own_before == 0,
        "is_late": m >= 75,
    }


def clean_text(c: Column | str) -> Column:
    """Without addresses and tags, white space squeezed."""
    x = F.regexp_replace(F.regexp_replace(col(c), r"https?://\S+|www\.\S+", " "), r"<[^>]+>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def word_count(c: Column | str) -> Column:
    return F.regexp_count(F.coalesce(col(c), F.lit("")), F.lit(r"\S+"))


def guess_language(c: Column | str, letters: dict[str, str], words: dict[str, list[str]], default: str = "en", least: int = 2) -> Column:
    """The first language with one of its own letters or at least ``least`` of its words; else the default."""
    x, out = F.lower(col(c)), None
    for lang in {**letters, **words}:
        hit = F.lit(False)
        if letters.get(lang):
            hit = hit | x.rlike(f"[{letters[lang]}]")
        if words.get(lang):
            hit = hit | (F.regexp_count(x, F.lit(rf"\b({'|'.join(words[lang])})\b")) >= least)
        out = F.when(hit, lang) if out is None else out.when(hit, lang)
    return F.lit(default) if out is None else out.otherwise(default)


def scope_of(c: Column | str, terms: Iterable[str], inside: str = "football", outside: str = "other") -> Column:
    return F.when(F.lower(col(c)).rlike("|".join(terms)), inside).otherwise(outside)


def lexicon_sentiment(c: Column | str, positive: Iterable[str], negative: Iterable[str]) -> tuple[Column, Column]:
    """(label, confidence) from counts of positive and negative terms."""
    x = F.lower(col(c))
    p, n = (F.regexp_count(x, F.lit(rf"\b({'|'.join(t)})\b")) for t in (list(positive), list(negative)))
    label = F.when(p > n, "positive").when(n > p, "negative").otherwise("neutral")
    return label, F.when(p + n > 0, F.least(F.lit(0.95), 0.5 + F.abs(p - n) / (2.0 * (p + n)))).otherwise(F.lit(0.5))


def softmax(*logits: Column) -> list[Column]:
    top = F.greatest(*logits)
    e = [F.exp(x - top) for x in logits]
    total = sum(e[1:], e[0])
    return [x / total for x in e]


def lookup(c: Column | str, values: dict, kind: str = "string") -> Column:
    """Value of a small fixed mapping; null for other keys."""
    if not values:
        return F.lit(None).cast(kind)
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[col(c)].cast(kind)


def elo_expected(diff: Column | str) -> Column:
    return 1 / (1 + F.pow(F.lit(10.0), -col(diff) / 400))


def elo_outcome(diff: Column | str, draw_peak: float = 0.28, width: float = 250.0) -> list[Column]:
    """Home, draw and away probabilities from a rating difference."""
    d = col(diff)
    draw = draw_peak * F.exp(-F.pow(d / width, 2) / 2)
    e = elo_expected(d)
    return [e * (1 - draw), draw, (1 - e) * (1 - draw)]


PI = math.pi
