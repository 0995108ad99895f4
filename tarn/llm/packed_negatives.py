"""Hard-negative mining with exact integer scores from Kronecker-packed products.

Many candidates' components of one dimension are biased to be non-negative and laid into separated fields
of one wide integer. An anchor's biased component multiplies all of them at once; the sum of the products
over the dimensions holds each candidate's score in its field, from which the biases are taken off exactly.

Anchors (a stated query set) meet all rows in blocks: both sides are dealt by row number into blocks of
bounded size, and one task compares one block of anchors with one block of rows. A first pass finds each
anchor's positives, a second one the negatives that fit them; what blocks return is merged by ranking
windows with at most a few rows an anchor and block. Neither labels nor ids decide where a row goes, so a
hot label or a repeated id makes no hot task.

Rows with a null id, a null label, a null vector, or a null or non-finite component take no part; a vector
shorter than others counts as filled up with zeros. An anchor's positives have other ids than its own; a row
of its id and another label may be a negative. Rows that repeat an id are candidates of their own; anchor
rows that are equal in id, label and vector count once. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import Scratch

FOUND = "a long, anchor_id long, vec_id long, score long"
MINED = "a long, place int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


class Fields:
    """Up to some thousand candidates (rows of ``q``), one wide integer for each dimension."""

    def __init__(self, q: np.ndarray, size: int):
        self.count, self.size, self.kind = len(q), size, f"<u{size}"
        self.low, self.sums = min(int(q.min(initial=0)), 0), q.sum(axis=1)
        biased = (q - self.low).astype(self.kind)
        self.wide = [int.from_bytes(biased[:, d].tobytes(), "little") for d in range(q.shape[1])]

    def scores(self, biased: list[int], total: int, low: int) -> np.ndarray:
        """Inner products with an anchor, given as its components less ``low``, and their sum."""
        packed = sum(map(mul, self.wide, biased))
        raw = np.frombuffer(packed.to_bytes(self.count * self.size, "little"), self.kind)
        return raw.astype(np.int64) + self.low * total + low * self.sums


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _biased(q: np.ndarray) -> Iterator[tuple[list[int], int, int]]:
    for v in q:
        low = min(int(v.min(initial=0)), 0)
        shifted = (v - low).tolist()
        yield shifted, sum(shifted), low


def _packs(q: np.ndarray, at: np.ndarray, size: int, width: int) -> Iterator[tuple[np.ndarray, Fields]]:
    for s in range(0, len(at), width):
        part = at[s : s + width]
        yield part, Fields(q[part], size)


def _cell(anchors: pd.DataFrame, rows: pd.DataFrame, dims: int) -> tuple:
    """Both sides with numbered labels; rows by id, so that equal scores stay in order of id."""
    rows = rows.sort_values("vec_id", kind="stable", ignore_index=True)
    codes, _ = pd.factorize(pd.concat([anchors["label"], rows["label"]], ignore_index=True))
    return rows, codes[: len(anchors)], codes[len(anchors) :], _matrix(anchors["q"], dims), _matrix(rows["q"], dims)


def _positives(anchors: pd.DataFrame, rows: pd.DataFrame, dims: int, size: int, width: int, most: int) -> pd.DataFrame:
    """The best ``most`` other rows of an anchor's label within this block."""
    rows, la, lr, qa, qr = _cell(anchors, rows, dims)
    ids, own = rows["vec_id"].to_numpy(), anchors["vec_id"].to_numpy()
    shifted = list(_biased(qa))
    order = np.argsort(lr, kind="stable")
    found = []
    for label in np.unique(la):
        lo, hi = np.searchsorted(lr[order], [label, label + 1])
        packs = list(_packs(qr, order[lo:hi], size, width))
        for k in np.flatnonzero(la == label):
            best_s, best_i = np.empty(0, np.int64), np.empty(0, np.int64)
            for part, fields in packs:
                s = fields.scores(*shifted[k])
                ok = ids[part] != own[k]
                if len(best_s) == most:
                    ok &= s > best_s[-1]
                best_s, best_i = np.r_[best_s, s[ok]], np.r_[best_i, ids[part][ok]]
                top = np.argsort(-best_s, kind="stable")[:most]
                best_s, best_i = best_s[top], best_i[top]
            found.append(pd.DataFrame({"a": anchors["a"].iat[k], "anchor_id": own[k], "vec_id": best_i, "score": best_s}))
    return pd.concat(found) if found else pd.DataFrame(columns=["a", "anchor_id", "vec_id", "score"])


def _negatives(anchors: pd.DataFrame, rows: pd.DataFrame, dims: int, size: int, width: int, most: int, least: int, highest: int) -> pd.DataFrame:
    """The best ``most`` rows of other labels, within this block, in each positive's range of scores."""
    rows, la, lr, qa, qr = _cell(anchors, rows, dims)
    ids, shifted, out = rows["vec_id"].to_numpy(), list(_biased(qa)), []
    wanted = [np.array([(p["score"], p["vec_id"]) for p in ps], np.int64) for ps in anchors["positives"]]
    low = [-(-least * w[:, 0] // 100) for w in wanted]
    high = [highest * w[:, 0] // 100 for w in wanted]
    best = [[(np.empty(0, np.int64), np.empty(0, np.int64))] * len(w) for w in wanted]
    for part, fields in _packs(qr, np.arange(len(rows)), size, width):
        for k, w in enumerate(wanted):
            s = fields.scores(*shifted[k])
            fit = (s >= low[k][:, None]) & (s <= high[k][:, None]) & (lr[part] != la[k])
            for p in np.flatnonzero(fit.any(axis=1)):
                bs, bi = np.r_[best[k][p][0], s[fit[p]]], np.r_[best[k][p][1], ids[part][fit[p]]]
                top = np.argsort(-bs, kind="stable")[:most]
                best[k][p] = bs[top], bi[top]
                if len(top) == most:  # later rows have larger ids and must score higher
                    low[k][p] = bs[top[-1]] + 1
    for k, w in enumerate(wanted):
        for p, (bs, bi) in enumerate(best[k]):
            out += [(anchors["a"].iat[k], p, anchors["vec_id"].iat[k], w[p, 1], w[p, 0], i, s) for s, i in zip(bs.tolist(), bi.tolist(), strict=True)]
    return pd.DataFrame(out, columns=["a", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def mine(
    df: DataFrame,
    is_anchor: Column,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    highest: int = 95,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = 8192,
    block_anchors: int = 2048,
    width: int = 2048,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    is_anchor: a condition over ``vec_id``. Components become floor(scale * x). A negative's score lies between
    ``least`` and ``highest`` per cent of the positive's; equal scores are ordered by smaller id. block_rows,
    block_anchors: rows on either side that meet in one task; width: candidates in one wide integer.
    """
    spark = df.sparkSession
    tmp = Scratch(spark)
    whole = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    src = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), whole.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = src.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = known.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("q"), F.monotonically_increasing_id().alias("row"))
    rows = tmp.put(rows, "rows")
    anchors = rows.filter(is_anchor).select("vec_id", "label", "q").distinct().withColumn("a", F.monotonically_increasing_id())
    anchors = tmp.put(anchors, "anchors")
    reach = F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q")))
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("dims"), F.max(reach).alias("top")).first()
    dims, top = facts["dims"] or 0, facts["top"] or 0
    if dims * top * top * 100 >= 1 << 62:
        raise ValueError(f"scores of {dims} components up to {top} do not fit a long; use a smaller scale")
    size = 4 if 4 * dims * top * top < 1 << 32 else 8
    across, down = -(-facts["n"] // block_rows) or 1, -(-anchors.count() // block_anchors) or 1

    def meet(left: DataFrame, f: Callable, schema: str, **how: int) -> DataFrame:
        """Every block of anchors with every block of rows; both sides are cut by row number."""
        block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        lt = left.select("*", block("a", down).alias("i"), every(across).alias("j")).withColumn("cell", F.col("i") * across + F.col("j")).drop("i", "j")
        rt = rows.select("vec_id", "label", "q", block("row", across).alias("j"), every(down).alias("i")).withColumn("cell", F.col("i") * across + F.col("j")).drop("i", "j")
        run = partial(f, dims=dims, size=size, width=width, **how)
        lt, rt = (x.repartition(min(across * down, 10_000), "cell").groupBy("cell") for x in (lt, rt))
        return lt.cogroup(rt).applyInPandas(lambda a, b: run(a, b), schema)

    ranked = Window.partitionBy("a").orderBy(F.desc("score"), "vec_id")
    pos = meet(anchors, _positives, FOUND, most=positives).withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= positives)
    pos = pos.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("n", "score", "vec_id"))).alias("positives"))
    asked = tmp.put(anchors.join(pos, "a"), "asked")
    mined = meet(asked, _negatives, MINED, most=negatives, least=least, highest=highest)
    by = Window.partitionBy("a", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = mined.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
