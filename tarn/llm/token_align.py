"""Alignment of two tokenizers' tokens over the same bytes by diagonal run skipping.

Both token sequences of a text become arrays of byte ends. Where the ends agree along a diagonal (the same
index shift between the two arrays) tokens correspond one to one; exponential probing compares ever longer
slices of the arrays and a halving search finds the last equal end, so a stretch is jumped in a few slice
comparisons. At its end the irregular group (one-to-many, many-to-one or crossing cuts) is walked token by
token until the ends meet again, which gives the shift of the next stretch. Every overlapping pair of
tokens is a link: one per one-to-one group, the steps of the walk in an irregular one.

How often a pair of ids is linked in the whole corpus is summed within tasks first and then over the
corpus. Each document then needs the counts of its own pairs: the most frequent pairs (at most
``most_hot``, so a proven bound) are broadcast, and the rest, spread thinly over many keys, is joined.

A token of the byte-level tokenizer stands for its decoded bytes, a piece of the other one for its UTF-8
with the word mark as a space, or for its byte. The text is taken with one space before it, which the
piece tokenizer puts there itself. Texts that are null or empty, or whose tokens do not give the text's
bytes, have no tokens: zeros and an empty digest. Null ids and repeated rows are kept, each with a result
of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import Scratch

GAPS = re.compile(r"\s\s")
MARK = "▁"
BLOCK = 1 << 20  # characters of text whose new words are encoded at once
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes the bytes: printable ones as themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TwoTokenizers:
    """Ids of both tokenizers for a text, joined from words where neither joins tokens over a space.

    A word with the one space before it encodes alike in any text without double white space and spaces at
    its ends: the byte-level pattern cuts before a space, and no piece holds a mark after other characters.
    Other texts are encoded whole, and so are texts with a word that does not give its own bytes. Where the
    byte-level file numbers its tokens by the order of its merges, words are merged by these numbers.
    """

    def __init__(self, tokenizer: str, pieces: str, pattern: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters, names = byte_letters(), self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * self.a.get_vocab_size()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        for name, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        words = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.by_word = not any(MARK in p[1:] and p.strip(MARK) for p in words)
        with open(tokenizer, encoding="utf-8") as f:
            merges = [m.split(" ") if isinstance(m, str) else m for m in json.load(f)["model"]["merges"]]
        if all(names.get(x + y) == 256 + n for n, (x, y) in enumerate(merges)):
            ranks = {self.bytes_a[i]: i for i in names.values() if i < 256 + len(merges)}
            merge = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            merge = lambda text: self._whole_a([text])[0]
        self.merge = merge
        self.most, self.cache = most, {}

    def _piece(self, i: int) -> bytes:
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(MARK, " ").encode()

    def _whole_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _both(self, texts: list[str], side_a: Callable[[list[str]], list[list[int]]]) -> list[tuple[bytes, bytes] | None]:
        """Ids as 32-bit bytes, or None where either side's tokens do not give a space and the text."""
        out, of_a, of_b = [], self.bytes_a, self.bytes_b
        spaced = [f" {t}" for t in texts]
        for text, ia, ib in zip(spaced, side_a(spaced), self.b.encode(texts, num_threads=1), strict=True):
            same = b"".join([of_a[i] for i in ia]) == text.encode() == b"".join([of_b[i] for i in ib])
            out.append((array("I", ia).tobytes(), array("I", ib).tobytes()) if same else None)
        return out

    def _words(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of many words: A's in one go over the words joined by spaces, cut again at the words' ends."""
        if not all(words) or any(w[0].isspace() or w[-1].isspace() for w in words):
            plain = [w for w in words if w and not (w[0].isspace() or w[-1].isspace())]
            known = dict(zip(plain, self._words(plain), strict=True)) if plain else {}
            return [known[w] if w in known else self._both([w], self._whole_a)[0] for w in words]
        raw = [f" {w}".encode() for w in words]
        whole = b"".join(raw)
        borders = np.cumsum([len(w) for w in raw])
        sides = []
        for ids, table, lengths in ((self.merge(whole.decode()), self.bytes_a, self.len_a), ([i for ids in self.b.encode(words, num_threads=1) for i in ids], self.bytes_b, self.len_b)):
            flat = np.array(ids, "<u4")
            ends = np.cumsum(lengths[flat])
            at = np.minimum(np.searchsorted(ends, borders), len(ends) - 1)
            if b"".join([table[i] for i in ids]) != whole or (ends[at] != borders).any():
                return self._both(words, self._whole_a)  # some word does not give its bytes
            cuts, packed = [0, *(4 * (at + 1)).tolist()], flat.tobytes()
            sides.append([packed[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)])
        return list(zip(*sides, strict=True))

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Both id arrays of every text, empty where a side does not give the text's bytes."""
        get, split = self.cache.get, []
        for t in texts:
            words = t.split(" ") if t and self.by_word and not (GAPS.search(t) or t[0] == " " or t[-1] == " ") else []
            split.append((words, [get(w) for w in words]))
        new = list({w for words, found in split if None in found for w, f in zip(words, found, strict=True) if f is None})
        known = dict(zip(new, self._words(new), strict=True)) if new else {}
        if len(self.cache) < self.most:
            self.cache.update((w, f) for w, f in known.items() if f)
        for text, (words, found) in zip(texts, split, strict=True):
            if None in found:
                found = [f or known[w] for w, f in zip(words, found, strict=True)]
            if None in found or not words:
                found = [f for f in (self._both([text], self._whole_a) if text else []) if f]
            yield tuple(np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in (zip(*found, strict=True) if found else ((), ())))


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], bytearray, bytearray]:
    """Links as indices on both sides, in order, and marks of the last token of each group on both sides."""
    la, lb, n = [], [], len(ends_a)
    last_a, last_b = bytearray(n), bytearray(len(ends_b))
    i = j = 0
    while i < n:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            s, t, k = i, j, 4
            i, j = i + 1, j + 1
            while (part := ends_a[i : i + k]) and part == ends_b[j : j + k]:
                i, j, k = i + len(part), j + len(part), 2 * k
            while k > 1:  # the last slice differs: halve it
                k //= 2
                if (part := ends_a[i : i + k]) and part == ends_b[j : j + k]:
                    i, j = i + len(part), j + len(part)
            la.extend(range(s, i))
            lb.extend(range(t, j))
            last_a[s:i] = last_b[t:j] = b"\1" * (i - s)
            continue
        while x != y:
            la.append(i)
            lb.append(j)
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        la.append(i)
        lb.append(j)
        last_a[i] = last_b[j] = 1
        i, j = i + 1, j + 1
    return la, lb, last_a, last_b


class GroupText:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, put in order for a whole text at once."""

    def __init__(self, size_a: int, size_b: int):
        names = [f"{i}{c}".encode() for n, marks in ((size_a, ",|"), (size_b, ",;")) for i in range(n) for c in marks]
        self.letters, self.first_b = np.array(names).view(np.uint8).reshape(len(names), -1), 2 * size_a

    def write(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        cut_a, cut_b = (np.r_[0, np.flatnonzero(x) + 1] for x in (last_a, last_b))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + cut_b[np.cumsum(last_a) - last_a]] = 2 * a + last_a
        order[np.arange(len(b)) + cut_a[np.cumsum(last_b) - last_b + 1]] = self.first_b + 2 * b + last_b
        letters = self.letters[order]
        return letters[letters != 0].tobytes()[:-1]


def _aligned(batches: Iterator[pd.DataFrame], tokenizer: str, pieces: str, pattern: str) -> Iterator[pd.DataFrame]:
    two = TwoTokenizers(tokenizer, pieces, pattern)
    text_of = GroupText(len(two.bytes_a), len(two.bytes_b))
    for pdf in batches:
        texts = pdf["text"].fillna("").tolist()
        part = np.cumsum([len(t) for t in texts]) // BLOCK
        for p in np.unique(part):
            at, rows = np.flatnonzero(part == p), []
            for a, b in two.encode([texts[i] for i in at]):
                if not len(a):
                    rows.append((0, 0, 0, 0, "", b"", b""))
                    continue
                la, lb, last_a, last_b = align(np.cumsum(two.len_a[a]).tolist(), np.cumsum(two.len_b[b]).tolist())
                ga, gb = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (last_a, last_b))
                digest = hashlib.sha256(text_of.write(a, b, ga, gb)).hexdigest()
                pairs, times = np.unique(a[la] << 32 | b[lb], return_counts=True)
                rows.append((len(a), len(b), int(ga.sum()), len(la), digest, pairs.tobytes(), times.astype("<u4").tobytes()))
            out = pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
            out.insert(0, "doc_id", pdf["doc_id"].iloc[at].to_numpy())
            out.insert(0, "row", pdf["row"].iloc[at].to_numpy())
            yield out.astype({"doc_id": "Int64"})


def _unpack(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a batch, how often each is linked, and how many pairs each row has."""
    pairs = np.frombuffer(b"".join(pdf["pairs"]), np.int64)
    return pairs, np.frombuffer(b"".join(pdf["times"]), "<u4").astype(np.int64), pdf["pairs"].str.len().to_numpy(np.int64) // 8


def _sums(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate(pairs), return_inverse=True)
    sums = np.zeros(len(codes), np.int64)
    np.add.at(sums, where, np.concatenate(times))
    return codes, sums


def _count(batches: Iterator[pd.DataFrame], most: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Sums of a task's pairs; beyond ``most`` different ones a part is passed on and counting starts anew."""
    codes, sums = np.empty(0, np.int64), np.empty(0, np.int64)
    for pdf in batches:
        pairs, times, _ = _unpack(pdf)
        codes, sums = _sums([codes, pairs], [sums, times])
        if len(codes) > most:
            yield pd.DataFrame({"pair": codes, "n": sums})
            codes, sums = codes[:0], sums[:0]
    yield pd.DataFrame({"pair": codes, "n": sums})


def _look_up(batches: Iterator[pd.DataFrame], hot) -> Iterator[pd.DataFrame]:
    """What the frequent pairs give each row, and its other pairs."""
    codes, counts, best = hot.value
    for pdf in batches:
        pairs, times, sizes = _unpack(pdf)
        ends = np.cumsum(sizes)
        row = np.repeat(np.arange(len(pdf)), sizes)
        at = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
        hit = codes[at] == pairs if len(codes) else np.zeros(len(pairs), bool)
        sums, bests = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        np.add.at(sums, row[hit], times[hit] * counts[at[hit]])
        np.add.at(bests, row[hit], times[hit] * best[at[hit]])
        left = [[(int(p), int(t)) for p, t in zip(pairs[s:e][~hit[s:e]], times[s:e][~hit[s:e]], strict=True)] for s, e in zip(ends - sizes, ends, strict=True)]
        yield pdf.drop(columns=["pairs", "times"]).assign(count_sum=sums, n_best=bests, left=left)


def align_tokenizers(docs: DataFrame, tokenizer: str, pieces: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", most_hot: int = 200_000) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per document.

    tokenizer, pieces: paths of a byte-level tokenizer file (A) and a piece model (B) on every executor;
    pattern: how A splits texts before merging.
    n_best counts the links whose pair is, in the corpus, among the most frequent of its B id.
    """
    spark = docs.sparkSession
    tmp = Scratch(spark)
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    done = tmp.put(src.mapInPandas(partial(_aligned, tokenizer=tokenizer, pieces=pieces, pattern=pattern), f"{ALIGNED}, pairs binary, times binary"), "aligned")
    counts = done.select("pairs", "times").mapInPandas(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = tmp.put(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "counts")
    tops = counts.groupBy("b").agg(F.max("n").alias("top"))
    scored = tmp.put(counts.join(tops, "b").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "scored")
    frequent = scored.orderBy(F.desc("n"), "pair").limit(most_hot).toPandas().sort_values("pair")
    hot = spark.sparkContext.broadcast(tuple(frequent[c].to_numpy(np.int64) for c in ("pair", "n", "best")))
    parts = tmp.put(done.mapInPandas(partial(_look_up, hot=hot), f"{ALIGNED}, count_sum long, n_best long, left array<struct<pair: long, times: long>>"), "parts")
    rest = parts.select("row", F.inline("left")).join(scored, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.col("times") * F.col("best")).alias("more_best"))
    whole = parts.drop("left").join(rest, "row", "left")
    more = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", more("n_best", "more_best"), more("count_sum", "more_sum"), "groups_sha256")
