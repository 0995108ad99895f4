"""Document quality by co-training.

Two views describe a document. The text view holds its content: hashed words, word pairs and character
trigrams by relative frequency, repetition, and shares of character kinds. The metadata view holds what
can be known without reading the words: language and source (one-hot by hash), length, and layout (lines and
their lengths). Each view has its own logistic regression. In every round both score all unlabelled
documents; those of which one view is sure become training rows of the other one. In the end each view
is calibrated on held-out labelled rows, and a two-weight regression on the same rows combines their log-odds.

Fits use bounded samples: at most about ``most_labelled`` labelled rows, and per view and round at most about
``most_new`` pseudo-labelled ones, drawn by hash evenly over label, language and source from all of which the
other view is sure. Scoring covers all rows and whole texts. Null, empty and blank texts score 0;
without labels of both classes every other document scores 0.5 and is kept; repeated rows are each
scored; a label that repeats counts by its largest quality. Rows with null id are scored, but teach nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tarn.llm.common import Scratch, mix64

BUCKETS = 2048  # of words, of word pairs, and of character trigrams
LANGS, SOURCES = 64, 1024
TEXT_STATS, META_STATS = 10, 6
TEXT, META = 3 * BUCKETS + TEXT_STATS, LANGS + SOURCES + META_STATS
SLICE = 1 << 19  # bytes of text that are looked at together
_ODD, _POWERS = np.uint64(0x9E3779B97F4A7C15), {}
# Kinds of bytes: lower case and beyond ASCII, upper case, digit, white space, full stop or comma, bar, other sign.
_KIND = np.full(256, 6, np.int64)
_KIND[97:123], _KIND[128:], _KIND[65:91], _KIND[48:58], _KIND[:33], _KIND[[44, 46]], _KIND[124] = 0, 0, 1, 2, 3, 4, 5


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        for name, x in (("up", int(_ODD)), ("down", pow(int(_ODD), -1, 1 << 64))):
            seq = np.full(n, np.uint64(x))
            seq[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[name] = np.multiply.accumulate(seq)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Slice:
    """Features of some documents at once: (document, feature) pairs of the text view, and both views' statistics."""

    def __init__(self, texts: list[bytes]):
        m, lens = len(texts), np.array([len(t) + 1 for t in texts])
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        doc = np.repeat(np.arange(m), lens)
        size = np.maximum(1, lens - 1)
        word = raw > 32
        first = np.flatnonzero(word & ~np.r_[False, word[:-1]])
        last = np.flatnonzero(word & ~np.r_[word[1:], False])
        up, down = _powers(len(raw) + 1)
        with np.errstate(over="ignore"):
            total = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])]
            h = mix64((total[last + 1] - total[first]) * down[first])
            wdoc = doc[first]
            near = wdoc[1:] == wdoc[:-1]
            pairs = mix64(h[:-1] * np.uint64(3) + h[1:])[near]
            tri = (raw[:-2].astype(np.uint32) | raw[1:-1].astype(np.uint32) << np.uint32(8) | raw[2:].astype(np.uint32) << np.uint32(16)) * np.uint32(0x9E3779B1)
        inside = np.flatnonzero(doc[:-2] == doc[2:]) if len(raw) > 2 else np.empty(0, np.int64)
        n = np.bincount(wdoc, minlength=m)
        self.n_words, self.docs, words = n, m, np.maximum(1, n)
        # the three groups of pairs: document, bucket, and what one occurrence counts
        self.groups = [
            (wdoc, (h >> np.uint64(53)).astype(np.int64), 1 / words),
            (wdoc[1:][near], (pairs >> np.uint64(53)).astype(np.int64) + BUCKETS, 1 / words),
            (doc[inside], (tri[inside] >> np.uint32(21)).astype(np.int64) + 2 * BUCKETS, 1 / size),
        ]
        kinds = np.bincount(doc * 7 + _KIND[raw], minlength=7 * m).reshape(m, 7).astype(float)
        kinds[:, 3] -= 1  # the blank after each document
        distinct = np.bincount((np.unique(wdoc.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20)) >> np.uint64(44)).astype(np.int64), minlength=m)
        again = np.bincount(wdoc[1:][near & (h[1:] == h[:-1])], minlength=m)
        length = np.bincount(wdoc, last - first + 1, minlength=m) / words
        share = kinds / size[:, None]
        self.text = np.column_stack([distinct / words, again / words, np.minimum(40, length) / 10, share[:, 1] * 4, share[:, 2] * 4, share[:, 6] * 4, share[:, 0], kinds[:, 5] / words, kinds[:, 4] / words, kinds[:, 1] > kinds[:, 0]])
        ends = raw == 10
        lines = 1 + np.bincount(doc[ends], minlength=m)
        blank = np.bincount(doc[1:][ends[1:] & ends[:-1]], minlength=m)
        self.meta = np.column_stack([np.log1p(lens - 1) / 10, np.log1p(lines) / 5, np.minimum(1, (lens - 1) / lines / 1000), blank / lines, np.log1p((lens - 1) / lines) / 10, lens < 100])

    def text_odds(self, w: np.ndarray, b: float) -> np.ndarray:
        out = self.text @ w[3 * BUCKETS :] + b
        for doc, feature, each in self.groups:
            out += np.bincount(doc, w[feature], minlength=self.docs) * each
        return out

    def text_rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(indices, values) of each document's text view."""
        key = np.concatenate([d * TEXT + f for d, f, _ in self.groups])
        value = np.concatenate([each[d] for d, _, each in self.groups])
        key, at = np.unique(key, return_inverse=True)
        value = np.bincount(at, value, minlength=len(key))
        cuts = np.searchsorted(key, np.arange(self.docs + 1) * TEXT)
        tail = np.arange(3 * BUCKETS, TEXT)
        return [(np.r_[key[a:b] - i * TEXT, tail], np.r_[value[a:b], self.text[i]]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


def _origin(langs: pd.Series, sources: pd.Series) -> np.ndarray:
    """Indices of language and source in the metadata view."""
    def place(x: str | None, n: int) -> int:
        return zlib.crc32((x or "").encode("utf-8", "surrogatepass")) % n

    return np.array([(place(a, LANGS), LANGS + place(b, SOURCES)) for a, b in zip(langs, sources, strict=True)]).reshape(-1, 2)


def _slices(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, Slice, np.ndarray]]:
    """Slices of the rows with their features and origins."""
    texts = [(t or "").encode("utf-8", "surrogatepass") for t in pdf["text"]]
    ends = np.cumsum([len(t) for t in texts])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE)))
        part = pdf.iloc[at:to]
        yield part, Slice(texts[at:to]), _origin(part["lang"], part["source"])
        at = to


def _odds(s: Slice, origin: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    (wt, bt), (wm, bm) = model["t"], model["m"]
    return np.clip(s.text_odds(wt, bt), -30, 30), np.clip(s.meta @ wm[LANGS + SOURCES :] + wm[origin].sum(axis=1) + bm, -30, 30)


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part, s, origin in _slices(pdf):
            rows, tail = s.text_rows(), np.arange(LANGS + SOURCES, META)
            out = part[KNOWN].copy()
            out["ti"], out["tv"] = [i for i, _ in rows], [v for _, v in rows]
            out["mi"] = [np.r_[o, tail] for o in origin]
            out["mv"] = [np.r_[1.0, 1.0, x] for x in s.meta]
            yield out


MEASURED = "doc_id long, y int, yt int, ym int, wt double, wm double, ti array<int>, tv array<double>, mi array<int>, mv array<double>"
KNOWN = ["doc_id", "y", "yt", "ym", "wt", "wm"]


def _views(rows: DataFrame, tmp: Scratch, tag: str) -> DataFrame:
    """(KNOWN, t, m): labels, their weights and the views of a bounded set of rows as sparse vectors, in a few partitions.

    Vectors are written as the struct that stores them and read back as vectors, without a Python function a row.
    The shuffle of these few rows leaves the scan of all documents at its full width.
    """
    def stored(view: str, size: int) -> Column:
        return F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.col(f"{view}i").alias("indices"), F.col(f"{view}v").alias("values")).alias(view)

    out = rows.mapInPandas(_measure, MEASURED).select(*KNOWN, stored("t", TEXT), stored("m", META)).repartition(4)
    schema = StructType([*[out.schema[c] for c in KNOWN], StructField("t", VectorUDT()), StructField("m", VectorUDT())])
    return tmp.put(out, tag, schema)


def _guess(batches: Iterator[pd.DataFrame], model: dict) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part, s, origin in _slices(pdf):
            ot, om = (np.clip(o * w[0] + b, -30, 30) for o, (w, b) in zip(_odds(s, origin, model), (model["ct"], model["cm"]), strict=True))
            yield pd.DataFrame({"doc_id": part["doc_id"], "lang": part["lang"], "source": part["source"], "ot": ot, "om": om})[s.n_words > 0]


def _at_once(spark: SparkSession, *fits: Callable[[], tuple | None]) -> list[tuple | None]:
    """The results of small fits, whose many short jobs share the executors."""
    with ThreadPool(len(fits)) as pool:
        return pool.map(lambda f: f(), [inheritable_thread_target(spark)(f) for f in fits])


def _fit(rows: DataFrame, view: str, reg: float = 3e-4, iterations: int = 25) -> tuple[np.ndarray, float] | None:
    """Weights and intercept of a view; None unless both classes occur."""
    known = rows.filter(F.col(f"y{view}").isNotNull())
    if known.select(f"y{view}").distinct().count() < 2:
        return None
    points = known.select(F.col(view).alias("v"), F.col(f"y{view}").cast("double").alias("l"), F.col(f"w{view}").alias("w"))
    m = LogisticRegression(featuresCol="v", labelCol="l", weightCol="w", maxIter=iterations, regParam=reg).fit(points)
    return m.coefficients.toArray(), float(m.intercept)


def _loss(y: np.ndarray, x: np.ndarray, by: tuple[np.ndarray, float]) -> float:
    """Mean log-loss of calibrated log-odds."""
    z = x @ by[0] + by[1]
    return float((np.logaddexp(0, z) - y * z).mean())


def _calibrate(y: np.ndarray, x: np.ndarray, reg: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept that turn views' log-odds into calibrated ones: a regression over the few held-out
    rows (a fifth of ``most_labelled``) and one or two columns, by Newton steps that are halved until they help."""
    n, k = x.shape
    if len(set(y.tolist())) < 2:
        return np.full(k, 1 / k), 0.0
    sd = np.maximum(x.std(axis=0), 1e-9)
    z, ridge, beta = np.c_[x / sd, np.ones(n)], np.diag([reg] * k + [0.0]), np.zeros(k + 1)

    def loss(b: np.ndarray) -> float:
        return float((np.logaddexp(0, z @ b) - y * (z @ b)).mean() + b @ ridge @ b / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p) / n)) @ z + ridge + 1e-9 * np.eye(k + 1), z.T @ (p - y) / n + ridge @ beta)
        while np.abs(step).max() > 1e-9 and loss(beta - step) > loss(beta):
            step /= 2
        beta = beta - step
        if np.abs(step).max() <= 1e-9:
            break
    return beta[:k] / sd, float(beta[k])


def _share(df: DataFrame, key: str, most: int, seed: int) -> Column:
    """Whether a row is in the hash sample of about ``most`` rows."""
    n = df.count()
    p = 1.0 if n <= most else most / n
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < F.lit(int(p * (1 << 30)) + (p >= 1))


def _sure(scored: DataFrame, odds: str, share: float, most: int, seed: int) -> DataFrame:
    """(doc_id, label, weight): of the ``share`` of each class of which a view is surest about ``most`` rows, evenly
    over label, language and source. The cut is found in a histogram of hundredths, so ties go together."""
    label, at = (F.col(odds) > 0).cast("int"), F.floor(F.abs(odds) * 100).cast("int")
    bins: dict[int, list[tuple[int, int]]] = {0: [], 1: []}
    for r in scored.groupBy(label.alias("label"), at.alias("at")).agg(F.count("*").alias("n")).collect():  # at most 6,002 rows
        bins[r["label"]].append((r["at"], r["n"]))
    cut = {}
    for k, rows in bins.items():
        rows.sort(reverse=True)
        reached = np.cumsum([n for _, n in rows])
        cut[k] = rows[int(np.searchsorted(reached, share * reached[-1]))][0] if rows else 0
    weight = 0.3 * F.abs(F.tanh(F.col(odds) / 2))
    sure = scored.filter(at >= F.when(label == 1, cut[1]).otherwise(cut[0])).select("doc_id", "lang", "source", label.alias("label"), weight.alias("weight"))
    keys = ["label", "lang", "source"]
    strata = sure.groupBy(*keys).agg(F.count("*").alias("n"))
    quota = most / max(1, strata.count())
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    drawn = sure.alias("r").join(strata.alias("s"), on).filter(F.pmod(F.xxhash64(F.lit(seed), "r.doc_id"), F.lit(1 << 30)) < F.lit(float(quota)) / F.col("s.n") * (1 << 30))
    return drawn.select("r.doc_id", "r.label", "r.weight").groupBy("doc_id").agg(F.max("label").alias("label"), F.max("weight").alias("weight"))


def train(docs: DataFrame, labels: DataFrame, rounds: int = 2, most_labelled: int = 4000, most_new: int = 2000, share: float = 0.25) -> dict | None:
    """Both views' weights, their calibrations, the weights of both together, and how many labels each view gave in
    each round and whether each kept those it got (``given``); None without labels of both classes."""
    spark = docs.sparkSession
    tmp = Scratch(spark)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    picked = tmp.put(known.filter(_share(known, "doc_id", most_labelled, 1)), "picked")
    cols = ["doc_id", "text", "lang", "source"]
    one = F.lit(1.0)
    seen = docs.join(F.broadcast(picked), "doc_id").select(*cols, "y", F.col("y").alias("yt"), F.col("y").alias("ym"), one.alias("wt"), one.alias("wm"))
    base = _views(seen, tmp, "views")
    held = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(5)) == 0
    test, start = base.filter(held), base.filter(~held)
    use, fresh = {"t": start, "m": start}, None  # the rows that each view has kept, and those of this round
    model, best, given, taken = {}, {"t": np.inf, "m": np.inf}, [], picked.select("doc_id")
    for k in range(rounds + 1):
        rows = {v: use[v] if fresh is None else use[v].unionByName(fresh) for v in use}
        fits = dict(zip(rows, _at_once(spark, *[partial(_fit, rows[v], v) for v in rows]), strict=True))
        if None in fits.values():
            return None
        judged = test.select("y", vector_to_array("t").alias("t"), vector_to_array("m").alias("m")).mapInPandas(partial(_judge, model=fits), "y int, ot double, om double").toPandas()
        y = judged["y"].to_numpy(float)
        for v, named in (("t", "text"), ("m", "meta")):
            x = judged[[f"o{v}"]].to_numpy(float)
            calibration = _calibrate(y, x)
            loss = _loss(y, x, calibration) if len(y) else 0.0
            better = loss < best[v]
            if better:
                model |= {v: fits[v], f"c{v}": calibration, f"x{v}": x}
                use[v], best[v] = rows[v], loss
            if given:
                given[-1][f"{named}_kept"] = better
        if k == rounds:
            break
        rest = docs.filter(F.col("doc_id").isNotNull()).select(*cols).join(F.broadcast(taken), "doc_id", "left_anti")
        scored = tmp.put(rest.mapInPandas(partial(_guess, model=model), "doc_id long, lang string, source string, ot double, om double"), "scored")
        by_meta, by_text = (_sure(scored, o, share, most_new, 5 + 2 * k + i).select("doc_id", F.col("label").alias(f"y{v}"), F.col("weight").alias(f"w{v}")) for i, (o, v) in enumerate((("om", "t"), ("ot", "m"))))
        new = tmp.put(by_meta.join(by_text, "doc_id", "full"), "new")  # at most about 2 * most_new rows
        given.append(new.agg(F.count("ym").alias("text"), F.count("yt").alias("meta")).first().asDict())
        fresh = _views(docs.join(F.broadcast(new), "doc_id").select(*cols, F.lit(None).cast("int").alias("y"), "yt", "ym", "wt", "wm"), tmp, "fresh")
        taken = taken.unionByName(new.select("doc_id"))
        tmp.free(scored)
    both = _calibrate(y, np.column_stack([model.pop("xt"), model.pop("xm")]))
    return model | {"both": both, "given": given}


def _judge(batches: Iterator[pd.DataFrame], model: dict) -> Iterator[pd.DataFrame]:
    (wt, bt), (wm, bm) = model["t"], model["m"]
    for pdf in batches:
        yield pd.DataFrame({"y": pdf["y"], "ot": [float(np.clip(wt @ v + bt, -30, 30)) for v in pdf["t"]], "om": [float(np.clip(wm @ v + bm, -30, 30)) for v in pdf["m"]]})


def _score(batches: Iterator[pd.DataFrame], model: dict | None) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part, s, origin in _slices(pdf):
            p = np.full((s.docs, 3), 0.5)
            if model is not None:
                odds = np.column_stack(_odds(s, origin, model))
                for j, (x, (w, b)) in enumerate(((odds[:, :1], model["ct"]), (odds[:, 1:], model["cm"]), (odds, model["both"]))):
                    p[:, j] = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
            p[[not (t and t.strip()) for t in part["text"]]] = 0.0
            yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "p_text": p[:, 0], "p_meta": p[:, 1], "score": p[:, 2]})


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")])


def score(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """(doc_id, p_text, p_meta, score, kept), one row per document; kept where score >= least."""
    src = _inputs(docs)
    out = src.mapInPandas(partial(_score, model=train(src, labels, **options)), "doc_id long, p_text double, p_meta double, score double")
    return out.withColumn("kept", F.col("score") >= least)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``least``, unchanged."""
    model, schema = train(_inputs(docs), labels, **options), docs.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = [p["score"].to_numpy() for p in _score(iter([pdf[["doc_id", "text", "lang", "source"]]]), model)]
            yield pdf[np.concatenate(scores) >= least] if scores else pdf

    return docs.mapInPandas(run, schema)
