"""Packing of token sequences by minimum bin slack.

Texts are tokenised where they are read; only piece lengths and checksums move. The histogram of
lengths (at most ``capacity`` rows, whatever the corpus) is all that bin building needs: for each bin
a bitset subset-sum over the lengths still available finds the fullest feasible combination, which
is removed as often as the remaining counts allow. Pieces then get a rank among those of their length,
from counts per (length, bucket), and the rank tells the bin and the place in it.

Null texts count as empty (one end token); null ids and repeated rows are packed like any other row.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import Scratch

END = b"\0\0\0\0"
GAPS = re.compile(r"\s\s")


class WordEncoder:
    """Token ids, as little-endian unsigned 32-bit bytes, joined from cached space-separated chunks.

    A chunk with the one space before it encodes alike in any text without double white space. Rare
    chunks are merged from the same vocabulary given as ranks; texts with double white space, and
    texts with a special token's name, go to the tokenizer whole.
    """

    def __init__(self, path: str, ranks: str, pattern: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.rare = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        self.tok, self.most, self.cache = Tokenizer.from_file(path), most, {}
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if GAPS.search(text) or any(s in text for s in self.special):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        chunks = text.split(" ")
        parts = [self.cache.get(c) for c in chunks]
        if not chunks[0]:
            parts[0] = b""
        else:
            parts[0] = array("I", self.rare(chunks[0])).tobytes()
        if None in parts:
            room = len(self.cache) < self.most
            for i, p in enumerate(parts):
                if p is None:
                    parts[i] = new = array("I", self.rare(" " + chunks[i])).tobytes()
                    if room:
                        self.cache[chunks[i]] = new
        return b"".join(parts)


def _pieces(batches: Iterator[pd.DataFrame], files: tuple[str, str, str], capacity: int) -> Iterator[pd.DataFrame]:
    enc = WordEncoder(*files)
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            ids = enc.encode(text or "") + END
            n = len(ids) // 4
            cuts = [0, n] if n <= capacity else [0, *range(n % capacity or capacity, n + 1, capacity)]
            rows += [(doc_id, i, s, e - s, zlib.crc32(ids[4 * s : 4 * e])) for i, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
        yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and multiplicities of a combination with the largest sum <= room."""
    mask, reach, trail = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if counts[x] and x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left:
            step = min(step, left)
            before, reach = reach, (reach | reach << (length * step)) & mask
            if reach != before:
                trail.append((before, length, step))
            left -= step
            step *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, step in reversed(trail):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + step
            total -= length * step
    return used


def plan_bins(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, how many, first sequence, offset): every rank of every length once."""
    left, ranks, seq, rows = dict(counts), dict.fromkeys(counts, 0), 0, []
    while left:
        top = max(left)
        left[top] -= 1
        used = fullest(left, capacity - top)
        left[top] += 1
        used[top] = used.get(top, 0) + 1
        times, offset = min(left[x] // m for x, m in used.items()), 0
        for length in sorted(used, reverse=True):
            for _ in range(used[length]):
                rows.append((length, ranks[length], times, seq, offset))
                ranks[length] += times
                offset += length
            left[length] -= times * used[length]
            if not left[length]:
                del left[length]
        seq += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(batches: Iterator[pd.DataFrame], plan: np.ndarray) -> Iterator[pd.DataFrame]:
    keys = plan[:, 0] << 48 | plan[:, 1]
    for pdf in batches:
        at = np.searchsorted(keys, pdf["length"].to_numpy() << 48 | pdf["rank"].to_numpy(), "right") - 1
        pdf["sequence_id"] = plan[at, 3] + pdf["rank"].to_numpy() - plan[at, 1]
        pdf["offset"] = plan[at, 4]
        yield pdf.drop(columns="rank")


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", buckets: int = 256) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    tokenizer, ranks, pattern: paths of a byte-level vocabulary as a tokenizer file and as ranks, on every
    executor, and its splitting pattern. buckets: parts into which the pieces
    of one length are dealt for ranking, so that a hot length is no hot task.
    """
    tmp = Scratch(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = tmp.put(src.mapInPandas(partial(_pieces, files=(tokenizer, ranks, pattern), capacity=capacity), schema), "pieces")
    plan = plan_bins({r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = dealt.withColumn("i", within).join(offsets, ["length", "bucket"])
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*cols, (F.col("i") + F.col("base")).alias("rank")).mapInPandas(partial(_place, plan=plan), schema + ", sequence_id long, offset long")
