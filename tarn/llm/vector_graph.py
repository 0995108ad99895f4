"""Near-duplicate vectors over a flat graph of pruned neighbour lists.

Equal vectors of a label collapse into one class, whatever their ids. Each class goes to the shards of its
nearest centres (shards overlap); shards that come out too large are divided again by centres of their own,
so the number of centres grows with the table while no task holds more than a bounded set of them. In a
shard, vectors are inserted into a graph batch by batch: a beam search over what is there names candidates,
robust pruning thins them, and links back are added. The lists that a class got in its shards are united.
Every class is then searched for in its home shard: a greedy beam search from several medoids, which goes
on through all vectors inside the radius as long as it finds more. A query that does not meet itself has
gone astray and is scanned against its shard. Links are confirmed in double precision.

Recall is audited against brute force on a bounded sample of classes: some at random, some that have links,
some whose nearest found vector just misses. A low mean recall is answered with wider overlap. Where no
audited class has a link, recall is null.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without label or
id, link with nothing; rows with null id get null results. Repeated rows count as copies; rows that share
an id but not a vector are judged each by its own vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import Scratch, connected_components, groups, hot_join, roots

DEGREE, BEAM, STARTS = 16, 32, 4
INDEX, BOTH, QUERY = 0, 1, 2  # roles of a vector in a shard


def _unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Unit vectors as bytes of doubles; null where there is none."""
    for pdf in batches:
        out = []
        for v in pdf["embedding"]:
            x = None if v is None else np.array([np.nan if c is None else c for c in v], float)
            if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                out.append(None)
                continue
            x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))  # neither overflow nor underflow in the norm
            out.append((x / np.sqrt(x @ x) + 0.0).tobytes())
        yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "v": out})


def _matrix(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), float).reshape(len(col), -1)


def _place(part: pd.DataFrame, c: np.ndarray | None, margin: float, name: str) -> pd.DataFrame:
    """Copies of the rows for their nearest centre and for those hardly farther; ``home`` marks the nearest."""
    angle = np.arccos(np.clip(_matrix(part["v"]) @ c.T, -1, 1)) if c is not None else np.zeros((len(part), 1))
    near = angle.argmin(axis=1)
    i, k = np.nonzero(angle <= angle.min(axis=1)[:, None] + margin)
    home = part["home"].to_numpy()[i] & (near[i] == k)
    return pd.DataFrame({"shard": [f"{name}/{x}" for x in k], "cid": part["cid"].to_numpy()[i], "copies": part["copies"].to_numpy()[i], "home": home, "v": part["v"].to_numpy()[i]})


def _to_shards(batches: Iterator[pd.DataFrame], centres: dict[tuple[str, int], np.ndarray], margin: float) -> Iterator[pd.DataFrame]:
    """Each vector to the shards of its label and width."""
    for pdf in batches:
        pdf = pdf.reset_index(drop=True).assign(home=True)
        for (label, width), at in pdf.groupby(["label", pdf["v"].map(len)]).groups.items():
            yield _place(pdf.loc[at], centres.get((label, width // 8)), margin, f"{label}/{width}")


def _divide(batches: Iterator[pd.DataFrame], margin: float) -> Iterator[pd.DataFrame]:
    """Rows of one shard and salt after another, its own centres first, to the parts of that shard."""
    key, centres = None, []
    for pdf in batches:
        if not len(pdf):
            continue
        names = pdf["shard"].to_numpy() + "#" + pdf["salt"].astype(str).to_numpy()
        cuts = np.r_[0, np.flatnonzero(names[1:] != names[:-1]) + 1, len(names)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            part = pdf.iloc[s:e]
            if names[s] != key:
                key, centres = names[s], []
            first = part["centre"].to_numpy()
            centres += [np.frombuffer(v, float) for v in part["v"][first]]
            rest = part[~first]
            if len(rest):
                yield _place(rest, np.array(centres), margin, part["shard"].iloc[0])


def robust_prune(x: np.ndarray, rows: np.ndarray, pool: np.ndarray, alpha: float = 1.2) -> np.ndarray:
    """DEGREE neighbours of ``rows`` out of each one's pool; -1 fills up.

    A chosen neighbour removes candidates that are nearer to it, by the factor alpha, than to the row.
    """
    m = np.arange(len(rows))
    d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,ncd->nc", x[rows], x[pool])))
    order = np.argsort(d, axis=1, kind="stable")
    pool, d = np.take_along_axis(pool, order, 1), np.take_along_axis(d, order, 1)
    cand, alive, out = x[pool], pool != rows[:, None], np.full((len(rows), DEGREE), -1)
    for r in range(DEGREE):
        has = alive.any(axis=1)
        if not has.any():
            break
        first = alive.argmax(axis=1)
        chosen = pool[m, first]
        out[has, r] = chosen[has]
        alive &= alpha * np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,ncd->nc", x[chosen], cand))) > d
        alive[m, first] = False
    return out


def beam_search(x: np.ndarray, adj: np.ndarray, starts: np.ndarray, q: np.ndarray, cos: float = 2.0, itself: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Greedy search with a beam for each query vector: the beam's vectors and cosines, which vectors of ``x``
    it saw, which of them lie inside the radius, and the nearest one that is not the query itself."""
    m, n = len(q), len(x)
    itself = np.full(m, -1) if itself is None else itself
    seen, inside = np.zeros((m, n), bool), np.zeros((m, n), bool)
    ids = np.tile(starts, (m, 1))
    sims = q @ x[starts].T
    seen[:, starts] = True
    np.put_along_axis(inside, ids, sims >= cos, 1)
    best = np.where(ids == itself[:, None], -1.0, sims).max(axis=1)
    done = np.zeros(ids.shape, bool)
    while True:
        open_sims = np.where(done, -np.inf, sims)
        at = open_sims.argmax(axis=1)
        live = np.flatnonzero(np.isfinite(open_sims[np.arange(m), at]))
        if not len(live):
            break
        done[live, at[live]] = True
        nb = adj[ids[live, at[live]]]
        fresh = (nb >= 0) & ~seen[live[:, None], nb]
        s = np.where(fresh, np.einsum("nd,ncd->nc", q[live], x[nb]), -np.inf)
        r, c = np.nonzero(fresh)
        seen[live[r], nb[r, c]] = True
        inside[live[r], nb[r, c]] = s[r, c] >= cos
        best[live] = np.maximum(best[live], np.where(nb == itself[live, None], -1.0, s).max(axis=1))
        all_ids, all_sims = np.hstack([ids[live], nb]), np.hstack([sims[live], s])
        all_done = np.hstack([done[live], ~fresh])
        if all_ids.shape[1] > BEAM:
            top = np.argpartition(-all_sims, BEAM - 1, axis=1)[:, :BEAM]
            all_ids, all_sims, all_done = (np.take_along_axis(a, top, 1) for a in (all_ids, all_sims, all_done))
        if ids.shape[1] != all_ids.shape[1]:
            wide = all_ids.shape[1]
            ids, sims, done = (np.hstack([a, np.full((m, wide - a.shape[1]), f, a.dtype)]) for a, f in ((ids, 0), (sims, -np.inf), (done, True)))
        ids[live], sims[live], done[live] = all_ids, all_sims, all_done
    return ids, sims, seen, inside, best


def insert_all(x: np.ndarray, first: int = 256, step: int = 128, near: int = 24, far: int = 8) -> np.ndarray:
    """Neighbours (-1 fills up) of each vector, by inserting them batch by batch into a growing graph.

    The first ``first`` vectors are compared with each other; each further batch searches the graph for its
    candidates, takes its own members too, and is pruned. Links back fill free places; a full list is pruned.
    """
    n, rng, most = len(x), np.random.default_rng(len(x)), 3 * DEGREE
    adj, size = np.full((n, most), -1), np.zeros(n, np.int64)
    at = 0
    while at < n:
        end = min(n, at + (step if at else first))
        rows = np.arange(at, end)
        sims = x[rows] @ x[rows].T
        k = min(near, len(rows))
        mates = np.argpartition(-sims, k - 1, axis=1)[:, :k] + at
        if at:
            starts = np.unique(np.r_[np.argmax(x[:at] @ x[:at].mean(axis=0)), rng.integers(0, at, STARTS)])
            ids, found, *_ = beam_search(x[:at], adj[:at], starts, x[rows])
            mates = np.hstack([mates, np.where(np.isfinite(found), ids, rows[:, None])])
        out = robust_prune(x, rows, np.hstack([mates, rng.integers(0, end, (len(rows), far))]))
        adj[at:end, :DEGREE], size[at:end] = out, (out >= 0).sum(axis=1)
        at = end
        for u, o in zip(rows, out[:, :6], strict=True):  # so that every vector can be reached
            for v in o[o >= 0]:
                if size[v] == most:
                    kept = robust_prune(x, np.array([v]), np.r_[adj[v], u][None])[0]
                    adj[v], size[v] = -1, (kept >= 0).sum()
                    adj[v, : size[v]] = kept[kept >= 0]
                if size[v] < most and u not in adj[v, : size[v]]:
                    adj[v, size[v]] = u
                    size[v] += 1
    return adj


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbour lists of the vectors that a shard indexes."""
    for g in groups(batches, "shard"):
        g = g[g["role"] != QUERY].sort_values("cid", kind="stable")
        if len(g):
            ids = g["cid"].to_numpy()
            yield pd.DataFrame({"shard": g["shard"].iloc[0], "cid": ids, "out": [ids[o[o >= 0]] for o in insert_all(_matrix(g["v"]))]})


def range_search(x: np.ndarray, adj: np.ndarray, starts: np.ndarray, q: np.ndarray, itself: np.ndarray, cos: float) -> tuple[np.ndarray, np.ndarray]:
    """For each query vector, which of ``x`` lie inside the radius (beam search, then range expansion), and
    the cosine of the nearest other one that was seen.

    itself: index of the query in ``x``, or -1; a query that never meets itself is scanned instead.
    """
    n = len(x)
    _, _, seen, inside, best = beam_search(x, adj, starts, q, cos, itself)
    r, c = np.nonzero(inside)
    while len(r):
        nr, nc = [], []
        for at in range(0, len(r), 20_000):
            nb = adj[c[at : at + 20_000]]
            rr, ok = np.repeat(r[at : at + 20_000], nb.shape[1]), nb.ravel() >= 0
            pair = np.unique(rr[ok] * n + nb.ravel()[ok])
            pr, pc = pair // n, pair % n
            fresh = ~seen[pr, pc]
            pr, pc = pr[fresh], pc[fresh]
            seen[pr, pc] = True
            hit = np.einsum("nd,nd->n", q[pr], x[pc]) >= cos
            inside[pr[hit], pc[hit]] = True
            nr.append(pr[hit])
            nc.append(pc[hit])
        r, c = np.concatenate(nr), np.concatenate(nc)
    known = np.flatnonzero(itself >= 0)
    for i in known[~seen[known, itself[known]]]:
        sims = x @ q[i]
        inside[i] = sims >= cos
        best[i] = np.delete(sims, itself[i]).max(initial=-1.0)
    return inside, best


def _search(batches: Iterator[pd.DataFrame], cos: float) -> Iterator[pd.DataFrame]:
    """Per query of a shard the copies that it links (n) and the best cosine seen; per shard a spanning forest of the links (a, b)."""
    for g in groups(batches, "shard"):
        g = g.sort_values("cid", kind="stable")
        index, asks = g[g["role"] != QUERY], g[g["role"] != INDEX]
        if not len(index) or not len(asks):
            continue
        x, ids, copies = _matrix(index["v"]), index["cid"].to_numpy(), index["copies"].to_numpy()
        lists = [np.asarray(o, np.int64) if o is not None else np.empty(0, np.int64) for o in index["out"]]
        adj = np.full((len(ids), max(1, max(map(len, lists)))), -1)
        for i, o in enumerate(lists):
            k = np.minimum(np.searchsorted(ids, o), len(ids) - 1)
            k = k[ids[k] == o]
            adj[i, : len(k)] = k
        mean = x.mean(axis=0)
        starts = np.unique(np.r_[np.argmax(x @ mean), [np.argmax(x[i :: STARTS] @ x[i :: STARTS].mean(axis=0)) * STARTS + i for i in range(min(STARTS, len(x)))]])
        q, qid = _matrix(asks["v"]), asks["cid"].to_numpy()
        own = np.minimum(np.searchsorted(ids, qid), len(ids) - 1)
        own = np.where(ids[own] == qid, own, -1)
        lab = np.arange(len(ids) + len(qid))
        for at in range(0, len(qid), 256):
            inside, best = range_search(x, adj, starts, q[at : at + 256], own[at : at + 256], cos)
            mine = np.arange(at, at + len(inside))
            has = own[mine] >= 0
            inside[np.flatnonzero(has), own[mine][has]] = False
            r, c = np.nonzero(inside)
            yield pd.DataFrame({"a": qid[mine], "b": pd.array([None] * len(mine), "Int64"), "n": inside @ copies, "best": best})
            node = np.where(own[mine] >= 0, own[mine], len(ids) + mine)
            a, b = lab[node[r]], lab[c]
            new = roots(len(lab), a, b)
            lab = new[lab]
        name = np.r_[ids, qid]
        on = np.flatnonzero(lab != np.arange(len(lab)))
        if len(on):
            yield pd.DataFrame({"a": name[lab[on]], "b": pd.array(name[on], "Int64"), "n": 0, "best": -1.0})


def _count_true(batches: Iterator[pd.DataFrame], asks: list[tuple[int, str, bytes]], cos: float) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        total = np.zeros(len(asks), np.int64)
        for (label, width), at in pdf.reset_index(drop=True).groupby(["label", pdf["v"].map(len).to_numpy()]).groups.items():
            mine = [i for i, (_, y, v) in enumerate(asks) if y == label and len(v) == width]
            if mine:
                part = pdf.iloc[at]
                sims = np.frombuffer(b"".join(asks[i][2] for i in mine), float).reshape(len(mine), -1) @ _matrix(part["v"]).T
                total[mine] += (sims >= cos) @ part["copies"].to_numpy()
        yield pd.DataFrame({"cid": [a[0] for a in asks], "n": total})


def _sample(df: DataFrame, share: Column) -> DataFrame:
    return df.filter(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) / (1 << 30) < share)


def _centres(classes: DataFrame, shard_rows: int, most_centres: int) -> dict[tuple[str, int], np.ndarray]:
    """Centres of the labels with more rows than two shards: at most about 2 * most_centres in all."""
    sizes = classes.groupBy("label", F.length("v").alias("width")).agg(F.count("*").alias("n")).filter(F.col("n") > 2 * shard_rows)
    large = sizes.orderBy(F.desc("n"), "label", "width").limit(most_centres // 2).collect()
    total, centres = sum(r["n"] for r in large), {}
    share = {f"{r['label']}/{r['width']}": 2.0 * max(2, min(-(-r["n"] // shard_rows), most_centres // 2 * r["n"] // total)) / r["n"] for r in large}
    if share:
        given = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
        drawn = _sample(classes, given[F.concat_ws("/", "label", F.length("v"))])
        for r in drawn.select("label", F.length("v").alias("width"), "v").orderBy(F.xxhash64("cid")).limit(2 * most_centres).collect():
            centres.setdefault((r["label"], r["width"] // 8), []).append(np.frombuffer(r["v"], float))
    return {k: np.array(v) for k, v in centres.items()}


def _shards(classes: DataFrame, centres: dict, margin: float, shard_rows: int, shard_limit: int, most_centres: int, levels: int, tmp: Scratch) -> DataFrame:
    """(shard, cid, copies, home, v): every class in its home shard and in those it overlaps."""
    schema = "shard string, cid long, copies long, home boolean, v binary"
    spread = tmp.put(classes.select("label", "cid", "copies", "v").mapInPandas(partial(_to_shards, centres=centres, margin=margin), schema), "shards")
    whole = None  # shards that are small enough, or that dividing does not thin
    for _ in range(levels):
        counts = spread.groupBy("shard").agg(F.count("*").alias("n"))
        large = tmp.put(counts.filter(F.col("n") > shard_limit), "large")
        if not large.limit(1).count():
            break
        rows = spread.join(large, "shard")
        salts = F.ceil(F.col("n") / (16 * shard_limit)).cast("int")
        share = F.least(F.lit(float(most_centres)), F.greatest(F.lit(8.0), 2.0 * F.col("n") / shard_rows)) / F.col("n")
        # the least hash is a centre too, so that none is without
        drawn = _sample(rows, share).select("shard", "n", "v").union(rows.groupBy("shard").agg(F.first("n"), F.min_by("v", F.xxhash64("cid"))))
        empty = [F.lit(0).cast("long").alias("cid"), F.lit(0).cast("long").alias("copies"), F.lit(False).alias("home"), "v"]
        first = drawn.select("shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(True).alias("centre"), *empty)
        rest = rows.select("shard", F.pmod(F.xxhash64("cid"), salts).cast("int").alias("salt"), F.lit(False).alias("centre"), "cid", "copies", "home", "v")
        parts = first.unionByName(rest).repartition(F.col("shard"), F.col("salt")).sortWithinPartitions("shard", "salt", F.desc("centre"))
        divided = tmp.put(parts.mapInPandas(partial(_divide, margin=margin), schema), "divided")
        after = divided.groupBy(F.regexp_extract("shard", r"(?s)^(.*)/[0-9]+$", 1).alias("parent"), "shard").agg(F.count("*").alias("m")).groupBy("parent").agg(F.sum("m").alias("all"), F.max("m").alias("most"))
        good = after.join(large, F.col("parent") == large["shard"]).filter((F.col("all") <= 4 * F.col("n")) & (2 * F.col("most") <= F.col("n"))).select("parent")
        kept = spread.join(good, F.col("shard") == F.col("parent"), "left_anti")
        whole = kept if whole is None else whole.unionByName(kept)
        spread = tmp.put(divided.join(good, F.regexp_extract("shard", r"(?s)^(.*)/[0-9]+$", 1) == F.col("parent"), "left_semi"), "shards")
    return spread if whole is None else tmp.put(whole.unionByName(spread), "shards")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cos: float = 0.98,
    shard_rows: int = 4000,
    most_centres: int = 2048,
    shard_limit: int = 16000,
    levels: int = 3,
    margin: float = 0.16,
    audit: int = 120,
    near_miss: float = 0.03,
    least_recall: float = 0.95,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept, audit_recall, audit_classes, audit_links), one row per row of ``vectors``.

    shard_rows: aimed-at rows of a shard; a label of up to twice as many is one shard, without overlap. most_centres: bound of the centres that a task gets, for all labels
    together or for one shard that is divided. shard_limit: a larger shard is divided again, up to ``levels``
    times; where dividing does not thin it (a dense ball of near copies), it is indexed in parts, each searched
    for all queries of the shard. margin: radians by which a shard's centre may be farther than the nearest
    one and still index a vector; near duplicates differ in their distance to any centre by little more than
    their own angle over the root of the dimension. audit: most classes compared with brute force, a third
    each at random, with links, and with a nearest vector within ``near_miss`` below the threshold.
    audit_recall: mean over the audited classes that have links, null if none has; audit_links: their links.
    """
    spark = vectors.sparkSession
    tmp = Scratch(spark)
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    units = src.mapInPandas(_unit, "vec_id long, label string, v binary")
    ok = F.col("v").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    units = tmp.put(units.withColumn("key", F.when(ok, F.concat_ws("/", F.md5("v"), F.md5(F.col("label").cast("binary"))))), "units")
    grouped = units.filter("key is not null").groupBy("key", "label", "v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = tmp.put(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    centres = _centres(classes, shard_rows, most_centres)

    asked: dict[int, tuple[str, bytes, int]] = {}
    truth: dict[int, int] = {}
    while True:
        spread = _shards(classes, centres, margin, shard_rows, shard_limit, most_centres, levels, tmp)
        counts = spread.groupBy("shard").agg(F.ceil(F.count("*") / shard_limit).cast("int").alias("parts"))
        cut = spread.join(counts, "shard").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
        cut = cut.withColumn("part", F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own"))))
        role = F.when(F.col("part") != F.col("own"), QUERY).when(F.col("home"), BOTH).otherwise(INDEX)
        members = cut.select(F.concat_ws("#", "shard", "part").alias("shard"), "cid", "copies", role.alias("role"), "v")
        lists = members.repartition(F.col("shard")).sortWithinPartitions("shard").mapInPandas(_build, "shard string, cid long, out array<long>")
        united = lists.groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("out"))).alias("out"))
        ready = members.join(united, "cid", "left").repartition(F.col("shard")).sortWithinPartitions("shard")
        found = tmp.put(ready.mapInPandas(partial(_search, cos=cos), "a long, b long, n long, best double"), "found")
        links = tmp.put(found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"), F.max("best").alias("best")), "links")
        if not asked:
            third = -(-audit // 3)
            near = (F.col("n") == 0) & (F.col("best") >= cos - near_miss)
            picks = [links.filter(c).orderBy(F.xxhash64("a")).limit(third) for c in (F.lit(True), F.col("n") > 0, near)]
            chosen = picks[0].union(picks[1]).union(picks[2]).select("a").distinct()
            for r in classes.join(F.broadcast(chosen), F.col("cid") == F.col("a")).select("cid", "label", "v", "copies").collect():
                asked[r["cid"]] = (r["label"], bytes(r["v"]), r["copies"])
            asks = [(i, y, v) for i, (y, v, _) in asked.items()]
            counted = classes.select("label", "v", "copies").mapInPandas(partial(_count_true, asks=asks, cos=cos), "cid long, n long")
            for r in counted.groupBy("cid").agg(F.sum("n").alias("n")).collect() if asks else []:
                truth[r["cid"]] = r["n"] - asked[r["cid"]][2]
        true = {i: n for i, n in truth.items() if n > 0}
        got = {r["a"]: r["n"] for r in links.filter(F.col("a").isin(list(true))).collect()} if true else {}
        recall = float(np.mean([min(got.get(i, 0), n) / n for i, n in true.items()])) if true else None
        if recall is None or recall >= least_recall or margin > 2:
            break
        margin *= 2
    comps = tmp.put(connected_components(found.filter("b is not null").select("a", "b"), "a", "b", tmp), "components")
    joined = classes.join(comps.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_class = (
        joined.join(links.select(F.col("a").alias("cid"), "n"), "cid", "left")
        .join(least, "component")
        .select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", "copies")
    )
    out = hot_join(units.select("vec_id", "key"), tmp.put(per_class, "classes"), "key", "copies", "left")
    comp = F.coalesce("component_id", "vec_id")
    n = F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
    report = [F.lit(recall).cast("double").alias("audit_recall"), F.lit(len(truth)).cast("long").alias("audit_classes"), F.lit(sum(true.values())).cast("long").alias("audit_links")]
    return out.select("vec_id", n.cast("long").alias("n_links"), comp.alias("component_id"), (comp == F.col("vec_id")).alias("kept"), *report)
