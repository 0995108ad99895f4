"""Secret scan: fixed patterns plus a battery of randomness tests with false-discovery control.

Fixed patterns give the base spans. Beside them, every run of 20 or more encoding characters is a
candidate. Its encoding (hex, base32, base36, letters, base64) is the smallest alphabet that holds it;
digits alone are numbers and have none. Three statistics look at its symbols:

- the chi-squared distance from a uniform alphabet,
- by how much runs of one kind (lower case, upper case, digit) are fewer than in a uniform source,
- the lag-one correlations of the symbols' places in the alphabet and of vowels, squared and summed.

Text is large in all three, a random string small. Both are calibrated by encoding and length: a uniform
source, and text with the corpus's own pairs of adjacent characters (counted over all documents outside base spans, spaces and
signs left out; a small corpus is filled up by a fixed table), bare and in the styles of identifiers (STYLES), each simulated from a fixed seed. The
statistics become z-scores under text and are combined by a weighted inverse-normal rule, weights from the
calibrations, into one score. Its p-value, "this is text of that style", is the normal one, but never below
an exponential tail fitted to the largest fortieth of the simulated text, since few styles are normal that far
out; the largest over the styles counts. A run of over 512 characters is judged in equal pieces, of which the
most text-like counts.

A weighted step-up procedure over all candidates of the corpus outside base spans, weights rising with length
because longer strings can tell more, sets the cut at false-discovery rate q. Runs that meet a base span are
found anyway and stay out of that family, else many sure ones would loosen the cut for the others. Null and
empty texts have no spans; offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex", "random"]
# The base patterns.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
HINTS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Encodings from small to large: name and symbols; the test tables go by name.
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
WIDE = UPPER + LOWER + DIGITS + "+/"
ENCODINGS = [
    ("hex", DIGITS + "abcdef"),
    ("hex", DIGITS + "ABCDEF"),
    ("base32", UPPER + "234567"),
    ("base36", DIGITS + LOWER),
    ("base36", DIGITS + UPPER),
    ("letters", UPPER + LOWER),
    ("base64", WIDE),
    ("base64", UPPER + LOWER + DIGITS + "-_"),
]
SYMBOLS: dict[str, str] = {}
for _name, _symbols in ENCODINGS:
    SYMBOLS.setdefault(_name, _symbols)
CODES = [(name, {c: i for i, c in enumerate(symbols)}) for name, symbols in ENCODINGS]
# Styles of text without spaces, by encoding: case of a word's first letter and of its others, separator,
# share of numbers (one to six digits) among its words (two to nine letters); None for bare text. TURNS: words
# and single digits by turns, where it costs no power (in one case with digits, random strings look alike).
TURNS = -1.0
STYLES = {
    "hex": [None, ("l", "l", "", 0.5), ("l", "l", "", 0.8)],
    "base32": [None, ("u", "u", "", 0.3), ("u", "u", "", 0.6)],
    "base36": [None, ("l", "l", "", 0.3), ("l", "l", "", 0.6)],
    "letters": [None, ("u", "l", "", 0.0), ("u", "u", "", 0.0)],
    "base64": [None, ("u", "l", "", 0.1), ("l", "l", "_", 0.15), ("l", "l", "-", 0.4), ("u", "u", "_", 0.2), ("u", "u", "-", 0.6), ("u", "l", "-", 0.3), ("u", "l", "", TURNS)],
}
LENGTHS = np.array([20, 24, 28, 32, 40, 48, 64, 96, 128, 192, 256, 512])
TAIL = 0.025  # of the simulated text, from where on an exponential law bounds p
BIN, BINS = 20, 1000  # bins of -log10 p: 20 a decade
BANDS = 6  # of length: 20-31, 32-63, ... 512 and more


def _phi(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


KIND = {e: np.array([0 if c.islower() else 1 if c.isupper() else 2 for c in x]) for e, x in SYMBOLS.items()}
VOWEL = {e: np.array([c in "aeiouAEIOU" for c in x], float) for e, x in SYMBOLS.items()}


def _lag(x: np.ndarray) -> np.ndarray:
    """Lag-one correlation of each row; 0 where a row does not vary."""
    d = x - x.mean(axis=1, keepdims=True)
    v = (d * d).sum(axis=1)
    return np.where(v > 1e-12, (d[:, 1:] * d[:, :-1]).sum(axis=1) / np.maximum(v, 1e-12), 0.0)


def statistics(x: np.ndarray, e: str) -> np.ndarray:
    """Chi-squared, lack of runs and serial correlation of each row of codes of encoding ``e``."""
    m, n = x.shape
    k = len(SYMBOLS[e])
    counts = np.bincount((np.arange(m)[:, None] * k + x).ravel(), minlength=m * k).reshape(m, k).astype(float)
    chi = (counts**2).sum(axis=1) * k / n - n
    kind = KIND[e][x]
    same = (np.bincount(KIND[e], minlength=3) / k) @ (np.bincount(KIND[e], minlength=3) / k)
    runs = 1 + (kind[:, 1:] != kind[:, :-1]).sum(axis=1)
    few = np.maximum(0, (n - 1) * (1 - same) + 1 - runs) / np.sqrt(n)
    serial = n * (_lag(x.astype(float)) ** 2 + _lag(VOWEL[e][x]) ** 2)
    return np.column_stack([np.sqrt(np.maximum(chi, 0)), few, np.sqrt(serial)])


# Bytes to codes in the wide alphabet; '-' and '_' stand for '+' and '/'.
_BYTE = np.full(256, -1, np.int64)
_BYTE[np.frombuffer(WIDE.encode(), np.uint8)] = np.arange(64)
_BYTE[[45, 95]] = [62, 63]


def pair_counts(text: str) -> np.ndarray:
    """How often each pair of wide-alphabet symbols is adjacent in a text without its other characters."""
    codes = _BYTE[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    codes = codes[codes >= 0]
    return np.bincount(codes[:-1] * 64 + codes[1:], minlength=4096)


def _fold(pairs: np.ndarray, e: str) -> np.ndarray:
    """Pair counts in the alphabet of encoding ``e``, letters' case folded to it."""
    to = np.full(64, -1)
    for i, c in enumerate(WIDE):
        hit = next((x for x in (c, c.lower(), c.upper()) if x in SYMBOLS[e]), None)
        to[i] = -1 if hit is None else SYMBOLS[e].index(hit)
    k, out = len(SYMBOLS[e]), np.zeros((len(SYMBOLS[e]),) * 2)
    a, b = np.meshgrid(to, to, indexing="ij")
    on = (a >= 0) & (b >= 0)
    np.add.at(out, (a[on], b[on]), pairs.reshape(64, 64)[on])
    return out + 1e-3 * out.sum() / (k * k)


def _in_style(text: np.ndarray, e: str, style: tuple | None, rng: np.random.Generator) -> np.ndarray:
    """Rows of codes dealt into words of the style."""
    if style is None:
        return text
    head, body, sign, numbers = style
    symbols = SYMBOLS[e]
    digits = np.array([i for i, c in enumerate(symbols) if c.isdigit()] or [0])
    case = {k: np.array([max(symbols.find(f(c)), symbols.find(c) if f(c) not in symbols else -1) for c in symbols]) for k, f in (("u", str.upper), ("l", str.lower))}
    sep = symbols.index({"_": "/", "-": "+"}[sign]) if sign else -1
    m, out = len(text), np.empty_like(text)
    left, number = np.zeros(m, np.int64), np.zeros(m, bool)
    for t in range(text.shape[1]):
        first = left == 0
        number[first] = ~number[first] & (t > 0) if numbers == TURNS else rng.random(first.sum()) < numbers
        digit_run = 1 if numbers == TURNS else rng.integers(1, 7, first.sum())
        left[first] = np.where(number[first], digit_run, rng.integers(3 if numbers == TURNS else 2, 10, first.sum()))
        out[:, t] = np.where(number, rng.choice(digits, m), np.where(first, case[head][text[:, t]], case[body][text[:, t]]))
        if sep >= 0:
            out[left == 1, t] = sep
        left -= 1
    return out


def _prior(weight: float = 5000.0) -> np.ndarray:
    """Pairs that stand in where the corpus is small: letters by rank of frequency, a few capitals and digits."""
    f = np.full(64, 1e-3)
    for rank, c in enumerate("etaoinsrhdlucmfwygpbvkxqjz"):
        f[26 + LOWER.index(c)], f[LOWER.index(c)] = 1 / (rank + 1), 0.03 / (rank + 1)
    f[52:62] = 0.01
    return weight * np.outer(f, f).ravel() / f.sum() ** 2


def calibrate(pairs: np.ndarray, strings: int = 1600, seed: int = 5) -> dict[str, list[tuple[np.ndarray, ...]]]:
    """By encoding and length, a row for each style: mean and deviation of the statistics under text, the weights
    of the z-scores, and where the tail of the weighted score starts and its mean excess."""
    out, pairs = {}, pairs + _prior()
    for e in SYMBOLS:
        rng, chain = np.random.default_rng(seed), _fold(pairs, e)
        k, first = len(chain), np.cumsum(chain.sum(axis=1) / chain.sum())
        steps = np.cumsum(chain / chain.sum(axis=1, keepdims=True), axis=1)
        text = np.empty((strings, LENGTHS[-1]), np.int64)
        text[:, 0] = np.minimum(np.searchsorted(first, rng.random(strings)), k - 1)
        for t in range(1, text.shape[1]):
            text[:, t] = np.minimum((rng.random(strings)[:, None] > steps[text[:, t - 1]]).sum(axis=1), k - 1)
        even = rng.integers(0, k, text.shape)
        styled = [_in_style(text, e, style, rng) for style in STYLES[e]]
        rows = []
        for n in LENGTHS:
            b, here = statistics(even[:, :n], e), []
            for drawn in styled:
                a = statistics(drawn[:, :n], e)
                mean, sd = a.mean(axis=0), np.maximum(a.std(axis=0), 0.05)
                za, zb = (a - mean) / sd, (b - mean) / sd
                cov = np.cov(za.T) + 1e-3 * np.eye(3)
                # only towards random: a statistic in which random strings are larger gets no weight
                w = np.maximum(0, np.linalg.solve(cov + np.cov(zb.T), -zb.mean(axis=0)))
                w = w if w.any() else np.ones(3)
                w = w / np.sqrt(w @ cov @ w)
                score = np.sort(za @ w)[-int(TAIL * strings) - 1 :]
                here.append((mean, sd, w, np.array([score[0], max((score[1:] - score[0]).mean(), 0.05)])))
            rows.append(tuple(np.array(x) for x in zip(*here, strict=True)))
        out[e] = rows
    return out


def battery(s: str, tables: dict) -> float:
    """p-value of "this run of encoding characters is text"."""
    s = s.rstrip("=")
    chars = set(s)
    if len(s) < 20 or all(c.isdigit() for c in chars):
        return 1.0
    found = next(((e, code) for e, code in CODES if chars <= code.keys()), None)
    if found is None:
        return 1.0
    e, code = found
    codes = np.fromiter((code[c] for c in s), np.int64, len(s))
    pieces = -(-len(s) // int(LENGTHS[-1]))
    n = len(s) // pieces
    x = statistics(np.stack([codes[i * n : (i + 1) * n] for i in range(pieces)]), e)
    at = float(np.interp(np.log(n), np.log(LENGTHS), np.arange(len(LENGTHS))))
    lo, f = int(at), at - int(at)
    mean, sd, w, tail = (a * (1 - f) + b * f for a, b in zip(tables[e][lo], tables[e][min(lo + 1, len(LENGTHS) - 1)], strict=True))
    z = ((x[:, None] - mean) / sd * w).sum(axis=2).max(axis=0)  # of the most text-like piece, by style
    far = TAIL * np.exp(-np.maximum(0.0, z - tail[:, 0]) / tail[:, 1])
    return max(max(_phi(v), b if v > t else 0.0) for v, b, t in zip(z.tolist(), far.tolist(), tail[:, 0].tolist(), strict=True))


def _band(n: int) -> int:
    return min(BANDS - 1, max(0, n.bit_length() - 5))


def candidates(text: str, tables: dict, base: list[tuple[int, int, int]] = ()) -> list[tuple[int, int, int, int]]:
    """(start, end, length band, bin of -log10 p) of the runs in a text that meet none of the base spans."""
    out = []
    for m in RUN.finditer(text):
        if any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        p = battery(m[0], tables)
        out.append((m.start(), m.end(), _band(m.end() - m.start()), min(BINS - 1, int(-BIN * math.log10(max(p, 1e-60))))))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in that order."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def without(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with its spans left out."""
    out, at = [], 0
    for s, _, e in spans:
        out.append(text[at:s] if s > at else "")
        at = max(at, e)
    return "".join(out) + text[at:] if at else text


def all_spans(text: str, fitted: tuple[dict, list[int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base spans with those that the battery adds outside them."""
    tables, cuts = fitted
    base = base_spans(text)
    more = [(s, 3, e) for s, e, band, b in candidates(text, tables, base) if b >= cuts[band]]
    return base, sorted(base + more)


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(4096, np.int64)
    for pdf in batches:
        for t in pdf["text"]:
            if t:
                total += pair_counts(without(t, base_spans(t)))
    on = np.flatnonzero(total)
    yield pd.DataFrame({"pair": on, "n": total[on]})


def _histogram(batches: Iterator[pd.DataFrame], tables: dict) -> Iterator[pd.DataFrame]:
    total = np.zeros((BANDS, BINS), np.int64)
    for pdf in batches:
        for t in pdf["text"]:
            for _, _, band, b in candidates(t, tables, base_spans(t)) if t else ():
                total[band, b] += 1
    band, b = np.nonzero(total)
    yield pd.DataFrame({"band": band, "bin": b, "n": total[band, b]})


def step_up(counts: np.ndarray, q: float) -> list[int]:
    """Least bin of -log10 p that is found, per length band, at false-discovery rate q (weighted step-up)."""
    m = counts.sum()
    if not m:
        return [BINS] * BANDS
    weight = np.sqrt(2.0 ** np.arange(BANDS))
    weight /= (weight * counts.sum(axis=1)).sum() / m
    level = 10 ** (-np.arange(BINS)[None, :] / BIN) / weight[:, None]  # the largest weighted p in each bin
    flat, n = level.ravel(), counts.ravel()
    order = np.argsort(flat, kind="stable")
    ok = np.flatnonzero((flat[order] <= q * np.cumsum(n[order]) / m) & (n[order] > 0))
    if not len(ok):
        return [BINS] * BANDS
    cut = flat[order[ok[-1]]]
    return [int(np.flatnonzero(np.r_[level[b] <= cut, True])[0]) for b in range(BANDS)]


def fit(docs: DataFrame, text_col: str = "text", q: float = 0.05) -> tuple[dict, list[int]]:
    """The calibration, from pair counts over all documents, and the cut per length band, from the p-values
    of all candidates of the corpus outside base spans; what comes to the driver is 4,096 counts and a histogram of fixed size."""
    src = docs.select(F.col(text_col).cast("string").alias("text"))
    pairs = np.zeros(4096, np.int64)
    for r in src.mapInPandas(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"]] = r["n"]
    tables, counts = calibrate(pairs), np.zeros((BANDS, BINS), np.int64)
    hist = src.filter(F.col("text").rlike(RUN.pattern)).mapInPandas(partial(_histogram, tables=tables), "band int, bin int, n long")
    for r in hist.groupBy("band", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["band"], r["bin"]] = r["n"]
    return tables, step_up(counts, q)


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches: Iterator[pd.DataFrame], fitted: tuple[dict, list[int]]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for t in pdf["text"]:
            base, spans = all_spans(t, fitted) if t else ([], [])
            kinds = [k for _, k, _ in base]
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans)))
        out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
        out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
        yield out.astype({"doc_id": "Int64", "n_assign": "int64", "n_access": "int64", "n_hex": "int64", "base_sha256": "object", "spans": "object"})


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.05) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per row of ``docs``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInPandas(
        partial(_scan, fitted=fit(src, "text", q)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def _redact(text: str | None, fitted: tuple[dict, list[int]], mark: str) -> str | None:
    if not text:
        return text
    out, at = [], 0
    for s, _, e in all_spans(text, fitted)[1]:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:] if at else text


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", q: float = 0.05, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span found replaced by ``mark`` and the length column brought up to date."""
    fitted, names = fit(docs, text_col, q), docs.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[text_col] = [_redact(t, fitted, mark) for t in pdf[text_col]]
            yield pdf

    out = docs.mapInPandas(run, docs.schema)
    length = F.when(F.col(text_col).isNotNull(), F.length(text_col)).otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType)
    return out.withColumn(length_col, length).select(*names)
