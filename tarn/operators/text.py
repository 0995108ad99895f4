"""Text documents: one schema for all sources, mentions, trends, topics, sentiment."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial, reduce
from operator import and_

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, StringIndexer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tarn.functions.exprs import clean_text
from tarn.operators.aggregates import burst_alerts, exact_quantiles, sentiment_metrics, trend
from tarn.operators.snapshot import latest

SCHEMA = ["doc_id", "source_type", "title", "body", "published_at", "engagement", "language"]


def normalise(sources: dict[str, tuple[DataFrame, dict[str, Column]]], title_chars: int = 500, text_chars: int = 5000) -> DataFrame:
    """All sources in one schema, with cleaned, length-capped model inputs beside the whole texts.

    sources: {source_type: (table, {schema name: column})}; missing names are null.
    """
    kinds = {"published_at": "timestamp", "engagement": "double"}
    out = None
    for name, (df, cols) in sources.items():
        one = df.select(*[(F.lit(name) if c == "source_type" else cols.get(c, F.lit(None))).cast(kinds.get(c, "string")).alias(c) for c in SCHEMA])
        out = one if out is None else out.unionByName(one)
    return out.withColumns({"title_clean": F.substring(clean_text("title"), 1, title_chars), "text_clean": F.substring(clean_text(F.concat_ws(" ", "title", "body")), 1, text_chars)})


def drop_invalid(df: DataFrame, least_chars: int = 1) -> DataFrame:
    """Documents with id, time and text; the newest of equal ids."""
    ok = df.filter(F.col("doc_id").isNotNull() & F.col("published_at").isNotNull() & (F.length("text_clean") >= least_chars))
    return latest(ok, ["doc_id"], [F.desc_nulls_last("published_at"), F.desc_nulls_last("text_clean")])


def entity_patterns(alias: DataFrame, name: str = "alias", key: str = "team_key", least_chars: int = 4) -> DataFrame:
    """(key, pattern): one word-bounded alternation per entity, longest alias first."""
    a = alias.select(F.col(key).alias("entity"), F.lower(F.trim(name)).alias("a")).filter(F.length("a") >= least_chars).distinct()
    quoted = F.regexp_replace("a", r"([.\\+*?\[\]^$(){}|/-])", r"\\$1")
    longest = F.array_sort(F.collect_list(F.struct((-F.length("a")).alias("n"), "a", quoted.alias("q"))))
    return a.groupBy("entity").agg(F.concat(F.lit(r"(?<!\w)("), F.array_join(F.transform(longest, lambda x: x["q"]), "|"), F.lit(r")(?!\w)")).alias("pattern"))


#: The automaton that this worker has built last, by its tag.
_BUILT: dict = {}


def _automaton(names: tuple[str, Broadcast]) -> ahocorasick.Automaton:
    """A trie with failure links over the broadcast names, built once in each worker."""
    tag, told = names
    if tag not in _BUILT:
        _BUILT.clear()
        trie = ahocorasick.Automaton()
        for name, owners in told.value:
            trie.add_word(name, (len(name), name, owners))
        trie.make_automaton()
        _BUILT[tag] = trie
    return _BUILT[tag]


def _inside_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def _spans(text: str, trie: ahocorasick.Automaton) -> dict[int, list[tuple[int, int]]]:
    """(start, end) of every name that stands between word borders, by owner."""
    found: dict = {}
    for last, (length, _, owners) in trie.iter(text) if len(trie) else ():
        start = last + 1 - length
        if not _inside_word(text, start - 1) and not _inside_word(text, last + 1):
            for o in owners:
                found.setdefault(o, []).append((start, last + 1))
    return found


def _count_spans(spans: list[tuple[int, int]]) -> int:
    """How many a scan from the left takes that prefers the longest name and never overlaps."""
    n, free = 0, 0
    for start, end in sorted(spans, key=lambda x: (x[0], -x[1])):
        if start >= free:
            n, free = n + 1, end
    return n


def _mention_counts(batches: Iterator[pd.DataFrame], names, keep: list[str]) -> Iterator[pd.DataFrame]:
    trie = _automaton(names)
    for pdf in batches:
        hits = [(i, o, _count_spans(s)) for i, t in enumerate(pdf["_t"]) if t for o, s in _spans(t, trie).items()]
        out = pdf[keep].iloc[[h[0] for h in hits]].reset_index(drop=True)
        yield out.assign(entity=pd.Series([h[1] for h in hits], dtype=object), n_mentions=[h[2] for h in hits])


def _mention_spans(batches: Iterator[pd.DataFrame], names) -> Iterator[pd.DataFrame]:
    trie = _automaton(names)
    for pdf in batches:
        hits = [(d, o, s, e) for d, t in zip(pdf["_doc"], pdf["_t"], strict=True) if t for o, spans in _spans(t, trie).items() for s, e in spans]
        yield pd.DataFrame(hits, columns=["_doc", "entity", "s", "e"])


def _shards(names: DataFrame, most: int) -> Iterator[tuple[str, Broadcast]]:
    """Tagged broadcasts of (name, owners), of about ``most`` names at most; no more than one passes the driver at a time."""
    n = names.limit(most + 1).count()
    shards = 1 if n <= most else -(-names.count() * 5 // (4 * most))
    for s in range(shards):
        part = names if shards == 1 else names.filter(F.pmod(F.xxhash64("name"), F.lit(shards)) == s)
        owned = part.groupBy("name").agg(F.array_sort(F.collect_set("owner")).alias("o"))
        yield uuid.uuid4().hex, names.sparkSession.sparkContext.broadcast([(r["name"], r["o"]) for r in owned.collect()])


def mentions(docs: DataFrame, aliases: DataFrame, text: str, keep: list[str], name: str = "alias", key: str = "entity", least_chars: int = 4, shard_names: int = 1_000_000) -> DataFrame:
    """(keep, entity, n_mentions) for every document and entity that it names by one of its aliases.

    Aliases of ``least_chars`` or more stand between word borders, letter case apart; an entity's longest alias at
    a place counts, and what it covers counts once: what ``entity_patterns`` finds. All aliases are sought in one
    pass over each text by an automaton, so the time does not depend on their number. A dictionary of more
    than ``shard_names`` is cut into several automata of bounded size, and the places they find are united.
    """
    lower = lambda c: F.lower(F.trim(c))
    names = aliases.select(lower(F.col(name)).alias("name"), F.col(key).cast("string").alias("owner")).filter((F.length("name") >= least_chars) & F.col("owner").isNotNull()).distinct()
    shards = list(_shards(names, shard_names))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    src = docs.select(*keep, F.lower(text).alias("_t"))
    if len(shards) == 1:
        return src.mapInPandas(partial(_mention_counts, names=shards[0], keep=keep), f"{kinds}, entity string, n_mentions int")
    once = src.groupBy(*keep, "_t").agg(F.count("*").alias("_copies"))
    once = once.withColumn("_doc", F.sha2(F.to_json(F.struct(*keep, "_t")), 256))
    found = reduce(DataFrame.unionAll, [once.select("_doc", "_t").mapInPandas(partial(_mention_spans, names=b), "_doc string, entity string, s int, e int") for b in shards])
    ordered = F.array_sort(F.collect_list(F.struct("s", (-F.col("e")).alias("e"))))
    taken = lambda acc, x: F.when(x["s"] >= acc["free"], F.struct((acc["n"] + 1).alias("n"), (-x["e"]).alias("free"))).otherwise(acc)
    counts = found.groupBy("_doc", "entity").agg(ordered.alias("spans")).select("_doc", "entity", F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("free")), taken)["n"].alias("n_mentions"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))
    return once.select(*keep, "_doc", copies.alias("_c")).join(counts, "_doc").select(*keep, "entity", "n_mentions")


def word_mentions(docs: DataFrame, dictionary: DataFrame, text: str, keep: list[str], most_words: int = 4) -> DataFrame:
    """(keep, entity, n_mentions) by equality of word n-grams with the aliases (alias, entity); any size."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " "), lambda w: w != "")
    d = docs.select(*keep, words.alias("_w"))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(most_words)), lambda n: F.when(F.size("_w") >= n, F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), lambda i: F.array_join(F.slice("_w", i, n), " "))).otherwise(F.array().cast("array<string>"))))
    return d.select(*keep, F.explode(grams).alias("alias")).join(dictionary.select("alias", "entity"), "alias").groupBy(*keep, "entity").agg(F.count("*").alias("n_mentions"))


def mentions_by_day(docs: DataFrame, dictionary: DataFrame, text: str, ident: str, day: str, most_words: int = 4) -> DataFrame:
    """(entity, day, n_docs, n_mentions): how many documents of a day name an entity, and how often."""
    m = word_mentions(docs, dictionary, text, [ident, day], most_words)
    return m.groupBy("entity", F.col(day).alias("day")).agg(F.count_distinct(ident).alias("n_docs"), F.sum("n_mentions").alias("n_mentions"))


def _longest_inside(batches: Iterator[pd.DataFrame], names, keep: list[str]) -> Iterator[pd.DataFrame]:
    trie = _automaton(names)
    for pdf in batches:
        best = [min(((-n, v) for _, (n, v, _) in trie.iter(t)), default=None) if t and len(trie) else None for t in pdf["_t"]]
        at = [i for i, b in enumerate(best) if b]
        yield pdf[keep].iloc[at].reset_index(drop=True).assign(n=[best[i][0] for i in at], v=pd.Series([best[i][1] for i in at], dtype=object))


def contains_mentions(docs: DataFrame, names: DataFrame, text: str, name: str, keep: list[str], shard_names: int = 1_000_000) -> DataFrame:
    """The longest name that each text contains (ties: the smaller), anywhere in it; automata as in ``mentions``."""
    src = docs.select(*keep, F.col(text).cast("string").alias("_t"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    wanted = names.select(F.col(name).alias("name"), F.lit("").alias("owner")).filter("name <> ''").distinct()
    hit = reduce(DataFrame.unionAll, [src.mapInPandas(partial(_longest_inside, names=b, keep=keep), f"{kinds}, n int, v string") for b in _shards(wanted, shard_names)])
    return hit.groupBy(*keep).agg(F.min(F.struct("n", "v"))["v"].alias(name))


def lookback(df: DataFrame, day: str, days: int, today: str | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``today`` (the newest day if not given)."""
    if today is not None:
        return df.filter((F.col(day) <= F.lit(today).cast("date")) & (F.col(day) > F.date_sub(F.lit(today).cast("date"), days)))
    ref = df.agg(F.max(day).alias("_today"))
    return df.crossJoin(F.broadcast(ref)).filter(F.col(day) > F.date_sub("_today", days)).drop("_today")


def topic_alerts(df: DataFrame, keys: list[str], day: str, days: int = 7, least: int = 5, lift: float = 1.25, negative_rate: float = 0.4) -> tuple[DataFrame, DataFrame]:
    """(trends, alerts): growing topics, and those of them whose recent documents are mostly negative."""
    t = trend(df, keys, day, days, least=least, lift=lift)
    recent = lookback(df, day, days)
    return t, burst_alerts(t, sentiment_metrics(recent, keys), keys, negative_rate)


def anomaly_scores(daily: DataFrame, keys: list[str], values: list[str], enough: int = 1_000_000) -> DataFrame:
    """Robust z-scores (median and absolute deviation per key) and their largest magnitude; medians are exact, NaN left out."""

    number = lambda x: F.when(~F.isnan(x.cast("double")), x)

    def medians(df: DataFrame, prefix: str, of: Callable[[str], Column]) -> DataFrame:
        if keys and (df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) <= enough:
            return df.join(df.groupBy(*keys).agg(*[F.median(number(of(v))).alias(f"{prefix}{v}") for v in values]), keys)
        for v in values:
            one = exact_quantiles(df.withColumn("_x", of(v)), keys, "_x", [0.5], enough).withColumnRenamed("q0", f"{prefix}{v}")
            df = df.join(one, keys, "left") if keys else df.crossJoin(F.broadcast(one))  # one row
        return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys], F.lit(True)))

    j = medians(daily, "_m_", F.col)
    j = medians(j, "_d_", lambda v: F.abs(F.col(v) - F.col(f"_m_{v}")))
    z = {f"z_{v}": (F.col(v) - F.col(f"_m_{v}")) / F.nullif(1.4826 * F.col(f"_d_{v}"), F.lit(0.0)) for v in values}
    out = j.withColumns(z)
    return out.withColumn("anomaly_score", F.greatest(F.lit(0.0), *[F.coalesce(F.abs(f"z_{v}"), F.lit(0.0)) for v in values])).drop(*[f"{p}{v}" for p in ("_m_", "_d_") for v in values])


def topic_words(text: str, vocabulary: int = 5000, least_docs: int = 2) -> Pipeline:
    """Word counts over the most frequent words; nothing here depends on the number of topics."""
    return Pipeline(stages=[RegexTokenizer(inputCol=text, outputCol="_w", pattern=r"[^\p{L}\p{N}]+", minTokenLength=2), CountVectorizer(inputCol="_w", outputCol="_tf", vocabSize=vocabulary, minDF=least_docs)])


def fit_topics(df: DataFrame, text: str, ks: list[int], least_share: float = 0.02, seed: int = 7, **options) -> tuple[PipelineModel, int]:
    """The model of the best silhouette among those without tiny clusters (or of all, if each has some).

    Texts are read twice, for the vocabulary and for their counts, which stay on the executors' disks until all
    ``ks`` are fitted; so the time for another ``k`` does not depend on the length of the texts.
    """
    words = topic_words(text, **options).fit(df)
    counts = words.transform(df).select("_tf").persist(StorageLevel.DISK_ONLY)
    try:
        idf = IDF(inputCol="_tf", outputCol="features").fit(counts)
        vectors, best = idf.transform(counts).select("features"), None
        for k in ks:
            m = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="topic_id").fit(vectors)
            out = m.transform(vectors)
            total, least = out.groupBy("topic_id").count().agg(F.sum("count"), F.min("count")).first()
            score = ClusteringEvaluator(predictionCol="topic_id").evaluate(out) if k > 1 else 0.0
            rank = (least >= least_share * total, score)
            if best is None or rank > best[0]:
                best = (rank, m, k)
    finally:
        counts.unpersist()
    return PipelineModel([*words.stages, idf, best[1]]), best[2]


def topic_names(spark: SparkSession, model: PipelineModel, n: int = 5) -> DataFrame:
    """(topic_id, topic_name) from the centres' top terms."""
    words, centres = model.stages[1].vocabulary, model.stages[-1].clusterCenters()
    rows = [(i, " / ".join(words[j] for j in sorted(range(len(words)), key=lambda j: (-c[j], words[j]))[:n] if c[j] > 0)) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "topic_id int, topic_name string")


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mixer of unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def trigram_counts(text: str, dims: int) -> np.ndarray:
    """Counts of the hashed trigrams of characters of a whole text, lower-cased."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = (c[:-2] << np.uint64(42)) ^ (c[1:-1] << np.uint64(21)) ^ c[2:] if len(c) > 2 else c[:0]
    return np.bincount((mix64(h) % np.uint64(dims)).astype(np.int64), minlength=dims)


def _trigram_batches(batches: Iterator[pa.RecordBatch], text: str, out: str, dims: int, vector: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            where, counts, ends = [], [], [0]
            for t in part.column(text).to_pylist():
                n = trigram_counts(t or "", dims)
                i = np.flatnonzero(n)
                where.append(i)
                counts.append(n[i])
                ends.append(ends[-1] + len(i))
            at_end, rows = pa.array(ends, pa.int32()), part.num_rows
            lists = [pa.ListArray.from_arrays(at_end, pa.array(np.concatenate(x).astype(t))) for x, t in ((where, np.int32), (counts, np.float64))]
            cells = [pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, dims, np.int32)), *[x.cast(f.type) for x, f in zip(lists, list(vector)[2:], strict=True)]]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.StructArray.from_arrays(cells, fields=list(vector))], names=[*part.schema.names, out])


class CharTrigrams(Transformer):
    """Vectors of hashed character trigrams, counted per document outside the JVM: no token per character."""

    def __init__(self, text: str, out: str, dims: int):
        super().__init__()
        self.text, self.out, self.dims = text, out, dims

    def _transform(self, df: DataFrame) -> DataFrame:
        vector = pa.struct([pa.field("type", pa.int8(), False), pa.field("size", pa.int32()), pa.field("indices", pa.list_(pa.field("element", pa.int32(), False))), pa.field("values", pa.list_(pa.field("element", pa.float64(), False)))])
        run = partial(_trigram_batches, text=self.text, out=self.out, dims=self.dims, vector=vector)
        return df.mapInArrow(run, StructType([*df.schema.fields, StructField(self.out, VectorUDT())]))


def sentiment_pipeline(text: str, label: str, dims: int = 1 << 14, iterations: int = 30, weight: str | None = None) -> Pipeline:
    """Character trigram TF-IDF over whole texts and multinomial logistic regression."""
    last = LogisticRegression(labelCol="_y", maxIter=iterations, regParam=0.01)
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_y", handleInvalid="skip", stringOrderType="alphabetAsc"),
        CharTrigrams(text, "_h", dims), IDF(inputCol="_h", outputCol="features"),
        last.setWeightCol(weight) if weight else last,
    ])


def fit_sentiment(df: DataFrame, ident: str, text: str, label: str, most_labelled: int = 20_000, **options) -> PipelineModel:
    """``sentiment_pipeline`` fitted on all labelled rows, or on a sample of about ``most_labelled``.

    Labels share the sample evenly, so a rare one is used whole; rows are taken by the hash of ``ident`` and
    weighted by what their label's sample stands for. Texts are never cut.
    """
    ok = df.filter(F.col(label).isNotNull()).select(ident, text, label)
    left, share = most_labelled, {}
    found = sorted((n, y) for y, n in ok.groupBy(label).count().collect())
    for i, (n, y) in enumerate(found):  # what small labels leave goes to the larger ones
        share[y] = min(1.0, left / (len(found) - i) / n)
        left -= share[y] * n
    rate = F.lit(1.0)
    for y, r in share.items():
        rate = F.when(F.col(label) == y, r).otherwise(rate)
    taken = ok.withColumn("_rate", rate).filter(F.pmod(F.xxhash64(ident), F.lit(1 << 20)) < F.col("_rate") * (1 << 20))
    return sentiment_pipeline(text, label, weight="_weight", **options).fit(taken.select(text, label, (1 / F.col("_rate")).alias("_weight")))


def score_sentiment(model: PipelineModel, df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(keep, prediction) of every row, labelled or not; ``prediction`` is the label's place in the alphabet."""
    return PipelineModel(model.stages[1:]).transform(df.select(*keep, text)).select(*keep, F.col("prediction").cast("int").alias("prediction"))


def js_distance(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: Jensen-Shannon distance (base 2) of the distributions of ``key`` in two tables."""
    def dist(df: DataFrame, name: str) -> DataFrame:
        c = df.groupBy(key).agg(F.count("*").alias("_n"))
        return c.crossJoin(F.broadcast(c.agg(F.sum("_n").alias("_t")))).select(key, (F.col("_n") / F.col("_t")).alias(name))

    j = dist(a, "p").join(dist(b, "q"), key, "outer").fillna(0.0, ["p", "q"])
    m = (F.col("p") + F.col("q")) / 2
    part = lambda x: F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(0.0)
    return j.agg(F.sqrt(F.greatest(F.lit(0.0), F.sum(part("p") / 2 + part("q") / 2))).alias("js_distance"))


def source_health(df: DataFrame, source: str, day: str, recent_days: int = 7) -> DataFrame:
    ref = df.agg(F.max(day).alias("_today"))
    j = df.crossJoin(F.broadcast(ref))
    return j.groupBy(source).agg(F.count("*").alias("n_rows"), F.max(day).alias("newest"), F.count_distinct(day).alias("n_days"), F.count(F.when(F.col(day) > F.date_sub("_today", recent_days), 1)).alias("n_recent"), F.min(F.datediff("_today", day)).alias("days_behind"))
