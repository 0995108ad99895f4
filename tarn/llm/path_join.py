"""Near-duplicate detection by a chosen-path set similarity join.

Every text becomes the set of its k-word shingles. Equal sets collapse into one class first, so
exact copies cost one row. Independent trees then branch the classes: at a node, one or two minwise
coordinates are chosen at random (1.25 on average, the inverse of the threshold 0.8) and each class
goes to the child named by its minwise token there. Nodes of one class vanish; small nodes are
compared exhaustively by sketches; larger ones branch again, and what cannot be branched is compared
in blocks. The sketch links of all trees make candidate clusters; inside each, full shingle sets are
compared through an inverted index, and only links of Jaccard similarity >= threshold count. A cluster of
too many texts or shingles is confirmed node by node, and a node whose shingles are still too many in pairs
of blocks, so that a task holds a bounded number of them (or two texts, if those are larger).

The number of trees follows from the recall wanted for a pair exactly at the threshold (``trees_for``).

Rows with a null id come back with null ``component_id`` and ``kept``; null, empty and blank texts
have no shingles and link with nothing; repeated rows are each returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import Scratch, connected_components, groups, hot_join, mix64, roots

WIDTH = 128  # minwise coordinates of a signature


def _word_hashes(text: str, cache: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z in lower case, split at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(cache) > 400_000:
        cache.clear()
    out = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def shingle_set(text: str | None, k: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles; a shorter text is one shingle."""
    h = _word_hashes(text, cache) if text else np.empty(0, np.uint64)
    n = len(h)
    if not n:
        return h
    width = min(k, n)
    with np.errstate(over="ignore"):
        acc = np.full(max(1, n - k + 1), width, np.uint64)
        for j in range(width):
            acc = (acc ^ (acc >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25) + h[j : j + len(acc)]
    return np.unique(mix64(acc))


def _coefficients(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**31, WIDTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, WIDTH, dtype=np.uint32)


def signature(s: np.ndarray, coef: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Minimum of each of WIDTH random linear hashes over the set."""
    a, b = coef
    u, out = (s >> np.uint64(32)).astype(np.uint32), np.full(WIDTH, 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(u), 512):
            np.minimum(out, (u[at : at + 512, None] * a + b).min(axis=0), out=out)
    return out


def _measure(batches: Iterator[pd.DataFrame], k: int, seed: int) -> Iterator[pd.DataFrame]:
    cache: dict[bytes, int] = {}
    coef = _coefficients(seed)
    for pdf in batches:
        ns, keys, sigs = [], [], []
        for text in pdf["text"]:
            s = shingle_set(text, k, cache)
            ns.append(len(s))
            keys.append(xxhash.xxh128(s.tobytes()).digest() if len(s) else None)
            sigs.append(signature(s, coef).tobytes() if len(s) else None)
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_shingles": np.array(ns, np.int64), "set_key": keys, "sig": sigs})


def _stack(col: pd.Series, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), kind).reshape(-1, width)


def _sketch(sig: np.ndarray) -> np.ndarray:
    """One byte a coordinate."""
    with np.errstate(over="ignore"):
        return ((sig * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _with_sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            sk = _sketch(_stack(pdf["sig"], np.uint32, WIDTH))
            yield pd.DataFrame({"rep": pdf["rep"], "sig": pdf["sig"], "sketch": [r.tobytes() for r in sk]})


def _children(node: np.ndarray, sig: np.ndarray, rep: np.ndarray, extra: float) -> pd.DataFrame:
    """One or, with probability ``extra``, two coordinates of each node; its members go to the children."""
    draw = mix64(node ^ np.uint64(0xA5A5A5A5))
    rows, nodes = [], []
    for i in range(2):
        on = np.arange(len(node)) if i == 0 else np.flatnonzero((draw >> np.uint64(40)) < np.uint64(int(extra * 2**24)))
        coord = ((draw[on] >> np.uint64(8 * i)) % np.uint64(WIDTH)).astype(int)
        value = sig[on, coord].astype(np.uint64)
        with np.errstate(over="ignore"):
            nodes.append(mix64(mix64(node[on] + np.uint64(i + 1)) ^ (value << np.uint64(8)) ^ coord.astype(np.uint64)))
        rows.append(rep[on])
    return pd.DataFrame({"node": np.concatenate(nodes).view(np.int64), "rep": np.concatenate(rows)})


def _plant(batches: Iterator[pd.DataFrame], trees: int, extra: float) -> Iterator[pd.DataFrame]:
    """Children of the roots of all trees."""
    for pdf in batches:
        if len(pdf):
            sig, rep = _stack(pdf["sig"], np.uint32, WIDTH), pdf["rep"].to_numpy()
            top = mix64(np.arange(1, trees + 1, dtype=np.uint64))
            yield pd.concat([_children(np.full(len(rep), t), sig, rep, extra) for t in top], ignore_index=True)


def _branch(batches: Iterator[pd.DataFrame], extra: float) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            yield _children(pdf["node"].to_numpy().view(np.uint64), _stack(pdf["sig"], np.uint32, WIDTH), pdf["rep"].to_numpy(), extra)


def _near(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """A spanning forest of the sketch links inside each node; nodes of two members go in one step."""
    empty = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})

    def whole() -> Iterator[pd.DataFrame]:
        tail = None
        for pdf in batches:
            pdf = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = pdf["node"].iloc[-1]
            start = int(np.searchsorted(pdf["node"].to_numpy(), last))
            tail = pdf.iloc[start:]
            if start:
                yield pdf.iloc[:start]
        if tail is not None and len(tail):
            yield tail

    for pdf in whole():
        node, rep, sk = pdf["node"].to_numpy(), pdf["rep"].to_numpy(), _stack(pdf["sketch"], np.uint8, WIDTH)
        cuts = np.r_[0, np.flatnonzero(node[1:] != node[:-1]) + 1, len(node)]
        size = np.diff(cuts)
        two = cuts[:-1][size == 2]
        hit = two[(sk[two] == sk[two + 1]).sum(axis=1) >= least]
        a, b = [rep[hit]], [rep[hit + 1]]
        for s, n in zip(cuts[:-1][size > 2], size[size > 2], strict=True):
            x = sk[s : s + n]
            i, j = [], []
            for r in range(n - 1):
                m = np.flatnonzero((x[r + 1 :] == x[r]).sum(axis=1) >= least)
                if len(m):
                    i.append(np.full(len(m), r))
                    j.append(m + r + 1)
            if i:
                lab = roots(n, np.concatenate(i), np.concatenate(j))
                on = np.flatnonzero(lab != np.arange(n))
                a.append(rep[s + lab[on]])
                b.append(rep[s + on])
        a, b = np.concatenate(a), np.concatenate(b)
        yield pd.DataFrame({"a": a, "b": b}) if len(a) else empty


def links_of(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component (smallest index) of each set; i and j link if 100 * common >= percent * union, exactly."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, inv = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(n), sizes)
    order = np.argsort(inv, kind="stable")
    posted, first = doc[order], np.r_[0, np.cumsum(np.bincount(inv, minlength=len(flat)))]
    ends = np.cumsum(sizes)
    a, b = [], []
    for i in range(n - 1):
        ids = inv[ends[i] - sizes[i] : ends[i]]
        lo, cnt = first[ids], first[ids + 1] - first[ids]
        at = np.repeat(lo - np.r_[0, np.cumsum(cnt)[:-1]], cnt) + np.arange(cnt.sum())
        common = np.bincount(posted[at], minlength=n)[i + 1 :]
        j = np.flatnonzero(100 * common >= percent * (sizes[i] + sizes[i + 1 :] - common)) + i + 1
        if len(j):
            a.append(np.full(len(j), i))
            b.append(j)
    return roots(n, np.concatenate(a), np.concatenate(b)) if a else np.arange(n)


def _confirm(batches: Iterator[pd.DataFrame], k: int, percent: int) -> Iterator[pd.DataFrame]:
    """Stars (smallest id, id) of the confirmed components inside each group of texts."""
    cache: dict[bytes, int] = {}
    for g in groups(batches, "bunch"):
        g = g.sort_values("doc_id", kind="stable")
        ids = g["doc_id"].to_numpy()
        if len(ids) < 2:
            continue
        lab = links_of([shingle_set(t, k, cache) for t in g["text"]], percent)
        on = np.flatnonzero(lab != np.arange(len(ids)))
        if len(on):
            yield pd.DataFrame({"a": ids[lab[on]], "b": ids[on]})


def survival(percent: int, depth: int) -> float:
    """Chance that a pair at the threshold is still together in one tree after ``depth`` levels."""
    s, extra, p = percent / 100, max(0.0, min(1.0, 100 / percent - 1)), 1.0
    for _ in range(depth):  # one or two coordinates, each with equal minwise tokens at chance s
        p = 1 - ((1 - extra) * (1 - s * p) + extra * (1 - s * p) ** 2)
    return p


def trees_for(recall: float, percent: int, depth: int) -> int:
    """Independent trees that meet such a pair at least with chance ``recall``, even at the deepest level."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival(percent, depth))))


def _bounded(texts: DataFrame, most: int) -> DataFrame:
    """(bunch, rep) of (bunch, rep, n_shingles), where a bunch of more than ``most`` shingles is dealt into blocks
    of half as many, and each pair of its blocks becomes a bunch."""
    sums = texts.groupBy("bunch").agg(F.ceil(2 * F.sum("n_shingles") / most).cast("int").alias("blocks"), F.sum("n_shingles").alias("w"))
    cut = texts.join(sums, "bunch").withColumn("p", F.when(F.col("w") > most, F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    whole = cut.filter("p is null").select("bunch", "rep")
    pairs = cut.filter("p is not null").select("bunch", "rep", "p", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"))
    return whole.union(pairs.select(F.xxhash64("bunch", F.least("p", "q"), F.greatest("p", "q")), "rep"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    recall: float = 0.998,
    trees: int | None = None,
    leaf: int = 4096,
    depth: int = 8,
    bunch_docs: int = 4096,
    bunch_shingles: int = 4_000_000,
    seed: int = 7,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    recall: least chance that a pair exactly at the threshold is compared, if nodes branch to the last level;
    most pairs are more alike or meet at the first level. trees: independent trees, by default as many as that takes.
    leaf: most members of a node that is compared exhaustively. depth: levels of branching; nodes still
    larger after them are compared in pairs of blocks, so that nothing is dropped. bunch_docs and
    bunch_shingles: a larger candidate cluster is confirmed node by node instead of at once, and a node of more
    shingles in pairs of blocks.
    """
    spark = docs.sparkSession
    tmp = Scratch(spark)
    trees = trees or trees_for(recall, percent, depth)
    extra = max(0.0, min(1.0, 100 / percent - 1))
    least = int(WIDTH * (percent / 100 - 0.14))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = tmp.put(src.mapInPandas(partial(_measure, k=k, seed=seed), "doc_id long, n_shingles long, set_key binary, sig binary"), "sets")
    classes = seen.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.min_by("sig", "doc_id").alias("sig"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("copies"))
    keyed = tmp.put(classes, "classes")
    sketched = tmp.put(keyed.select("rep", "sig").mapInPandas(_with_sketch, "rep long, sig binary, sketch binary"), "sketch")

    leaves: DataFrame | None = None
    rows = sketched.select("rep", "sig").mapInPandas(partial(_plant, trees=trees, extra=extra), "node long, rep long")
    for level in range(1, depth + 1):
        many = rows.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        alive = tmp.put(rows.join(many, "node"), "nodes")
        small = alive.filter(F.col("size") <= leaf).select("node", "rep")
        leaves = small if leaves is None else leaves.unionByName(small)
        if not alive.filter(F.col("size") > leaf).limit(1).count():
            break
        big = alive.filter(F.col("size") > leaf)
        if level == depth:
            half = leaf // 2
            part = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
            blocked = big.withColumn("blocks", F.ceil(F.col("size") / half)).withColumn("p", part)
            pairs = blocked.select("rep", "node", "p", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("q"))
            leaves = leaves.unionByName(pairs.select(F.xxhash64("node", F.least("p", "q"), F.greatest("p", "q")).alias("node"), "rep"))
        else:
            rows = big.select("node", "rep").join(sketched.select("rep", "sig"), "rep").select("node", "rep", "sig").mapInPandas(partial(_branch, extra=extra), "node long, rep long")

    near = (
        leaves.join(sketched.select("rep", "sketch"), "rep")
        .select("node", "rep", "sketch")
        .repartition(F.col("node"))
        .sortWithinPartitions("node")
        .mapInPandas(partial(_near, least=least), "a long, b long")
        .distinct()
    )
    clusters = tmp.put(connected_components(near, "a", "b", tmp), "clusters").withColumnRenamed("id", "rep")
    sized = tmp.put(clusters.join(keyed.select("rep", "n_shingles"), "rep"), "sized")
    sums = sized.groupBy("component").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("weight"))
    large = (F.col("docs") > bunch_docs) | (F.col("weight") > bunch_shingles)
    weighed = tmp.put(hot_join(sized, sums.select("component", large.alias("large"), "docs"), "component", "docs"), "weighed")
    any_large = bool(weighed.filter("large").limit(1).count())
    bunches = weighed.filter("not large").select("rep", F.col("component").alias("bunch"))
    if any_large:
        inside = weighed.filter("large").join(leaves.distinct(), "rep").select(F.xxhash64("component", "node").alias("bunch"), "rep", "n_shingles")
        bunches = bunches.unionByName(_bounded(inside, bunch_shingles))
    texts = src.join(bunches, src["doc_id"] == bunches["rep"]).select("bunch", "doc_id", "text")
    stars = texts.repartition(F.col("bunch")).sortWithinPartitions("bunch").mapInPandas(partial(_confirm, k=k, percent=percent), "a long, b long")
    if any_large:
        found = connected_components(stars, "a", "b", tmp)
    else:
        found = stars.select(F.col("b").alias("id"), F.col("a").alias("component"))
    found = tmp.put(found, "found")

    reps = keyed.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component"), "copies")
    mine = seen.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    out = hot_join(mine, tmp.put(reps, "reps"), "set_key", "copies", "left")
    comp = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), comp).alias("component_id"), (comp == F.col("doc_id")).alias("kept"))
