"""Chat formatting as prefix trees: shared initial turns are emitted once, depth-first.

A conversation is the sequence of its turns' digests. Sorted by these sequences, conversations stand in
depth-first order of the tree of their prefixes, and each emits only the turns that it does not share with
the one before it. The order is cut into shards by range partitioning, so a tree under one common opening
turn is spread over as many tasks as it needs; a shard that begins inside a tree first repeats the one open
path as ``context`` (tokens to attend to, not to be trained on again) and is complete in itself.

Every turn becomes one row: its tokens, their place in the shard's token stream, the position id of the
first one (the number of tokens of its ancestors), the intervals of the stream that its ancestors take (what
its tokens may attend to besides themselves, causally), and the token interval under the loss mask.

The template marks turns by two control ids beyond the vocabulary. In texts and roles every ``<`` followed
by backslashes and ``|`` gets one more backslash, so no control string can arise, and reading takes it away.

Null roles and texts count as empty, null turns come first, rows with equal turns follow their digest, and
repeated rows are turns of their own. Rows without a conversation id form one conversation without id. Equal
conversations share all their rows. A task holds the digests of one conversation (32 characters a turn),
never its texts. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import Scratch, hot_join
from tarn.llm.slack_pack import WordEncoder

START, END = "<|im_start|>", "<|im_end|>"
NODES = "shard long, start long, n_tokens int, depth int, position long, ancestors array<struct<start: long, end: long>>, tokens array<int>, loss_from int, loss_to int, context boolean, leaf string, copies long"
READ = "leaf string, copies long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Codec:
    """Turns to token ids and back; the control ids are the first two beyond the vocabulary."""

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        self.words = WordEncoder(tokenizer, ranks, pattern)
        with open(ranks, "rb") as f:
            self.bytes = {int(i): base64.b64decode(b) for b, i in map(bytes.split, f)}
        top = self.words.tok.get_vocab_size()
        self.controls = np.array([top], "<u4").tobytes(), np.array([top + 1], "<u4").tobytes()
        self.bytes |= {top: START.encode(), top + 1: END.encode()}

    def write(self, role: str, text: str) -> tuple[np.ndarray, int, int]:
        """Ids of a turn, and where its text begins and ends among them."""
        head = self.controls[0] + self.words.encode(escape_role(role) + "\n")
        body = self.words.encode(escape(text))
        ids = np.frombuffer(head + body + self.controls[1] + self.words.encode("\n"), "<u4")
        return ids, len(head) // 4, (len(head) + len(body)) // 4

    def text(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode()

    def read(self, ids: list[int]) -> tuple[str, str, int]:
        """Role and text of a turn, and the code points of its formatted form."""
        whole = self.text(ids)
        role, text = whole[len(START) : -len(END) - 1].split("\n", 1)
        return unescape_role(role), unescape(text), len(whole)


def _shared(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many turns each conversation shares with the one before it in its shard."""
    shard, before = None, []
    for pdf in batches:
        shared = []
        for s, path in zip(pdf["shard"], pdf["path"], strict=True):
            path = list(path)
            shared.append(_shared(before, path) if s == shard else 0)
            shard, before = s, path
        yield pdf.drop(columns=["path"]).assign(shared=shared)


def _emit(batches: Iterator[pd.DataFrame], files: dict[str, str]) -> Iterator[pd.DataFrame]:
    """Rows of NODES from turns in depth-first order; the stack holds the open path of the shard."""
    codec, shard, cursor, stack = Codec(**files), None, 0, []
    for pdf in batches:
        rows = []
        for t in pdf.itertuples(index=False):
            if t.shard != shard:
                shard, cursor, stack = t.shard, 0, []
            del stack[t.depth :]
            position, spans = stack[-1] if stack else (0, ())
            ids, loss_from, loss_to = codec.write(t.role, t.text)
            if t.role != "assistant":
                loss_from = loss_to = 0
            end = cursor + len(ids)
            last = t.depth == t.n_turns - 1
            rows.append((shard, cursor, len(ids), t.depth, position, [{"start": s, "end": e} for s, e in spans], ids.tolist(), loss_from, loss_to, t.depth < t.known, t.leaf if last else None, t.copies if last else None))
            own = (*spans[:-1], (spans[-1][0], end)) if spans and spans[-1][1] == cursor else (*spans, (cursor, end))
            stack.append((position + len(ids), own))
            cursor = end
        yield pd.DataFrame(rows, columns=["shard", "start", "n_tokens", "depth", "position", "ancestors", "tokens", "loss_from", "loss_to", "context", "leaf", "copies"]).astype({"copies": "Int64"})


def build_tree(convs: DataFrame, tokenizer: str, ranks: str, pattern: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", shard_turns: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(NODES, one row per turn and prefix; (conv_id, leaf), one row per conversation).

    A conversation is the row of its ``leaf`` and that row's ancestors. tokenizer, ranks, pattern: as for
    packing. shard_turns: about how many turns go to one shard.
    """
    spark = convs.sparkSession
    tmp = Scratch(spark)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = convs.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    turns = turns.withColumns({"key": F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "h": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))})
    path = F.transform(F.array_sort(F.collect_list(F.struct("turn", "h"))), lambda x: x["h"])
    paths = turns.groupBy("key", "conv_id").agg(path.alias("path")).withColumn("leaf", F.md5(F.array_join("path", "")))
    paths = tmp.put(paths, "paths")
    # one of equal conversations stands for all
    reps = paths.groupBy("leaf").agg(F.min(F.struct("key", "path")).alias("r"), F.count("*").alias("copies"))
    reps = reps.select("leaf", "copies", F.col("r.key").alias("key"), F.col("r.path").alias("path"), F.size("r.path").alias("n_turns"))
    total = paths.agg(F.sum(F.size("path"))).first()[0] or 0
    shards = max(1, -(-total // shard_turns))
    ordered = reps.repartitionByRange(shards, "path").sortWithinPartitions("path")
    ordered = tmp.put(ordered.withColumns({"shard": F.spark_partition_id().cast("long"), "place": F.monotonically_increasing_id()}), "ordered")
    # a shard's first conversation against the last one of the shard before
    ends = ordered.groupBy("shard").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    ends = tmp.put(ends.withColumn("nth", F.row_number().over(Window.orderBy("shard"))), "ends")
    at = lambda c, n: ends.select(F.col(c).alias("place"), (F.col("nth") + n).alias("nth")).join(ordered.select("place", "path"), "place")
    both = at("first", 0).join(at("last", 1).select("nth", F.col("path").alias("before")), "nth")
    differ = F.array_position(F.zip_with("path", "before", lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    known = both.select("place", (differ - 1).cast("int").alias("known"))
    schema = "leaf string, copies long, key string, n_turns int, shard long, place long, shared int"
    placed = ordered.repartition(shards, "shard").sortWithinPartitions("shard", "place").select("leaf", "copies", "key", "path", "n_turns", "shard", "place")
    placed = placed.mapInPandas(_places, schema).join(known, "place", "left").fillna(0, ["known"])
    depth = F.row_number().over(Window.partitionBy("key").orderBy("turn", "h")) - 1
    emitted = turns.select("key", "role", "text", depth.alias("depth")).join(placed, "key").filter("depth >= shared")
    laid = emitted.select("shard", "place", "depth", "role", "text", "n_turns", "known", "leaf", "copies").repartition(shards, "shard").sortWithinPartitions("shard", "place", "depth")
    nodes = tmp.put(laid.mapInPandas(partial(_emit, files={"tokenizer": tokenizer, "ranks": ranks, "pattern": pattern}), NODES), "nodes")
    return nodes, paths.select("conv_id", "leaf")


def _read(batches: Iterator[pd.DataFrame], files: dict[str, str]) -> Iterator[pd.DataFrame]:
    """READ for every leaf, from rows in order of the stream: ancestors are found by their intervals."""
    codec, shard, stack = Codec(**files), None, []
    for pdf in batches:
        rows = []
        for t in pdf.itertuples(index=False):
            if t.shard != shard:
                shard, stack = t.shard, []
            parent = t.ancestors[-1]["end"] if len(t.ancestors) else -1
            while stack and stack[-1][0] != parent:
                stack.pop()
            n, turns, chars, loss, formatted = stack[-1][1:] if stack else (0, hashlib.sha256(), 0, hashlib.sha256(), 0)
            ids = t.tokens.tolist()
            role, text, length = codec.read(ids)
            turns, loss = turns.copy(), loss.copy()
            turns.update(f"{role}\n{text}\n".encode())
            trained = unescape(codec.text(ids[t.loss_from : t.loss_to]))
            loss.update(trained.encode())
            stack.append((t.start + t.n_tokens, n + 1, turns, chars + len(trained), loss, formatted + length))
            if t.leaf is not None:
                rows.append((t.leaf, t.copies, n + 1, turns.hexdigest(), chars + len(trained), loss.hexdigest(), formatted + length))
        yield pd.DataFrame(rows, columns=["leaf", "copies", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_tree(nodes: DataFrame, members: DataFrame, tokenizer: str, ranks: str, pattern: str, parts: int | None = None) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from ``nodes``."""
    n = parts or int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = ["shard", "start", "n_tokens", "ancestors", "tokens", "loss_from", "loss_to", "leaf", "copies"]
    laid = nodes.select(*cols).repartition(n, "shard").sortWithinPartitions("shard", "start")
    read = Scratch(nodes.sparkSession).put(laid.mapInPandas(partial(_read, files={"tokenizer": tokenizer, "ranks": ranks, "pattern": pattern}), READ), "read")
    found = hot_join(members, read, "leaf", "copies")
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
