"""URL rules by a sort-merge range join.

Hosts are written with their labels reversed, each followed by a dot, so that a host and all its
subdomains are one interval of keys, and the intervals of rules nest or are disjoint. Urls and rules
are dealt to ranges of (key, id), rules to every range that their interval meets, and sorted; one
sweep over each range keeps a stack of the rules' hosts that are open and tests the url's path
against them. The longest rule (host and path together, then host) wins.

Null urls and urls without ``://`` have empty host and path; rules that repeat the same host and path
keep the first verdict in the order of their text; null rule hosts fit nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = r"^[\s\S]*?://([\s\S]*)$"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, REST, 1), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _deal_urls(batches: Iterator[pd.DataFrame], splits: list[tuple[str, int]]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["part"] = [bisect_right(splits, (k.encode(), i)) for k, i in zip(pdf["key"], pdf["tie"], strict=True)]
        yield pdf


def _deal_rules(batches: Iterator[pd.DataFrame], splits: list[tuple[str, int]]) -> Iterator[pd.DataFrame]:
    """Each rule to all ranges that meet [key, key with its last dot raised)."""
    for pdf in batches:
        lo = [bisect_right(splits, (k.encode(), -(2**63))) for k in pdf["key"]]
        hi = [bisect_right(splits, (k.encode()[:-1] + b"/", -(2**63))) for k in pdf["key"]]
        pdf["part"] = [list(range(a, b + 1)) for a, b in zip(lo, hi, strict=True)]
        yield pdf.explode("part").astype({"part": "int64"})


def _sweep(batches: Iterator[pd.DataFrame], default: str) -> Iterator[pd.DataFrame]:
    part, stack = None, []  # (key, {path: (rule, verdict)}, lengths of its paths, longest first)
    for pdf in batches:
        ids, hosts, paths, rules, verdicts = [], [], [], [], []
        for p, key, is_url, ident, host, path, verdict in zip(*(pdf[c] for c in ("part", "key", "is_url", "page_id", "host", "path", "verdict")), strict=True):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                top = stack[-1]
                if path not in top[1]:
                    top[1][path] = (host + path, verdict)
                    top[2][:] = sorted({len(x) for x in top[1]}, reverse=True)
                continue
            best, size = None, (-1, -1)
            for k, by_path, lengths in stack:
                for n in lengths:
                    if n <= len(path) and (hit := by_path.get(path[:n])):
                        if (len(k) + n, len(k)) > size:
                            best, size = hit, (len(k) + n, len(k))
                        break
            ids.append(ident)
            hosts.append(host)
            paths.append(path)
            rules.append(best[0] if best else None)
            verdicts.append(best[1] if best else default)
        yield pd.DataFrame({"page_id": pd.array(ids, "Int64"), "host": hosts, "path": paths, "rule": pd.Series(rules, dtype=object), "verdict": verdicts})


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", parts: int | None = None, sample: int = 20_000) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``urls``.

    rules: (host, path, verdict). default: verdict where no rule fits. parts: key ranges, the session's
    shuffle partitions if not given. sample: most keys that the driver sees to choose the ranges' ends.
    """
    spark = urls.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = split_url(F.col(url_col).cast("string"))
    src = urls.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    keyed = src.select("page_id", "host", "path", _key(F.col("host")).alias("key"), F.xxhash64("page_id", "path").alias("tie"))
    n = urls.count()
    picked = keyed.select("key", "tie") if n <= sample else keyed.select("key", "tie").sample(sample / n, seed=1)
    ends = sorted((r["key"].encode(), r["tie"]) for r in picked.limit(2 * sample).collect())
    splits = sorted({ends[len(ends) * i // parts] for i in range(1, parts)}) if len(ends) > parts else []
    cols = "page_id long, host string, path string, key string, tie long, is_url boolean, verdict string, part long"
    dealt = keyed.select("*", F.lit(True).alias("is_url"), F.lit(None).cast("string").alias("verdict")).mapInPandas(partial(_deal_urls, splits=splits), cols)
    known = rules.filter(F.col("host").isNotNull()).select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    named = known.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    spread = named.select(
        F.lit(None).cast("long").alias("page_id"), "host", "path", _key(F.col("host")).alias("key"), F.lit(0).cast("long").alias("tie"), F.lit(False).alias("is_url"), "verdict"
    ).mapInPandas(partial(_deal_rules, splits=splits), cols)
    both = dealt.unionByName(spread).repartitionByRange(parts, "part").sortWithinPartitions("part", "key", "is_url", "tie")
    return both.mapInPandas(partial(_sweep, default=default), "page_id long, host string, path string, rule string, verdict string")
