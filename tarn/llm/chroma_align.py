"""Chroma audio fingerprints and their alignment.

A recording (a column of WAV bytes) becomes frames of energy per pitch class. Filters that add and
subtract rectangles of frames and pitch classes, each a few look-ups in the integral image, are
quantised to two bits; sixteen of them make one packed 32-bit integer per frame position. Recordings
with equal fingerprints are one class. Query classes meet the others through equal pairs of integers; the
histogram of their offsets names an alignment, and the bit errors along it decide.

Recordings shorter than the widest filter have no integers: those of equal frames and samples are one class,
and they match nothing else. Recordings with fewer pairs of integers than the votes asked for must lie wholly
in the other one, and meet it through equal single integers. An integer or pair that many asking positions
share is dealt over salts, so that it does not meet in one task. Rows with null id are members of a null class; null audio counts as empty. The tables here hold no media, so ``render`` makes one recording per
text: a note per word, whose pitch comes from the word.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import Scratch

RATE, NOTE, FRAME, HOP = 4000, 256, 512, 256
BANDS, WIDEST = 12, 8
SALTS = 32  # shares of a hot key


def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, height, width) of sixteen filters, from a rule."""
    return [(i % 4, (5 * i) % BANDS - (5 * i) % BANDS % 2, 2 + 2 * (i % 3), 3 + i % 6) for i in range(16)]


FILTERS = [(k, y if y + h <= BANDS else BANDS - h, h, w) for k, y, h, w in _filters()]


def notes_of(text: str | None) -> np.ndarray:
    """Samples of a text's tune, 8 bits each: the word's checksum gives pitch class, octave and loudness."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.uint8)
    t = np.arange(NOTE) / RATE
    table = getattr(notes_of, "table", None)
    if table is None:
        grid = [(p, o, v) for p in range(12) for o in range(2) for v in range(4)]
        table = np.array([128 + (40 + 20 * v) * np.sin(2 * np.pi * 220 * 2 ** (o + p / 12) * t) * np.hanning(NOTE) ** 0.25 for p, o, v in grid]).round().astype(np.uint8)
        notes_of.table = table
    return table[[zlib.crc32(w.encode("utf-8", "surrogatepass")) % 96 for w in words]].ravel()


def to_wav(samples: np.ndarray) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(RATE)
        f.writeframes(samples.tobytes())
    return out.getvalue()


def from_wav(blob: bytes | None) -> np.ndarray:
    """Mono samples around zero of 8- or 16-bit PCM."""
    if not blob:
        return np.empty(0, np.float32)
    with wave.open(io.BytesIO(blob)) as f:
        raw, width, channels = f.readframes(f.getnframes()), f.getsampwidth(), f.getnchannels()
    x = np.frombuffer(raw, np.uint8).astype(np.float32) - 128 if width == 1 else np.frombuffer(raw, "<i2").astype(np.float32) / 256
    return x.reshape(-1, channels).mean(axis=1) if channels > 1 else x


def _pitch_matrix() -> np.ndarray:
    freq = np.fft.rfftfreq(FRAME, 1 / RATE)
    m = np.zeros((len(freq), BANDS), np.float32)
    on = np.flatnonzero((freq >= 100) & (freq <= 1800))
    m[on, np.round(12 * np.log2(freq[on] / 220)).astype(int) % 12] = 1
    return m


PITCH, HANN = _pitch_matrix(), np.hanning(FRAME).astype(np.float32)


def chroma(x: np.ndarray) -> np.ndarray:
    """Share of each pitch class in the energy of each frame."""
    n = (len(x) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, BANDS), np.float32)
    out = []
    for at in range(0, n, 4096):  # a long recording goes in pieces
        k = np.arange(at, min(n, at + 4096))
        spec = np.abs(np.fft.rfft(x[k[:, None] * HOP + np.arange(FRAME)] * HANN, axis=1)).astype(np.float32)
        e = (spec * spec) @ PITCH
        out.append(e / (e.sum(axis=1, keepdims=True) + 1e-6))
    return np.concatenate(out)


def fingerprint(c: np.ndarray) -> np.ndarray:
    """One 32-bit integer per frame position: sixteen filters of two bits (Gray code)."""
    n = len(c) - WIDEST + 1
    if n < 1:
        return np.empty(0, np.int32)
    s = np.zeros((len(c) + 1, BANDS + 1))
    s[1:, 1:] = c.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(n)

    def box(t0: int, t1: int, y0: int, y1: int) -> np.ndarray:
        return s[t + t1, y1] - s[t + t0, y1] - s[t + t1, y0] + s[t + t0, y0]

    out = np.zeros(n, np.uint32)
    for kind, y, h, w in FILTERS:
        if kind == 0:  # upper against lower half
            a, b = box(0, w, y + h // 2, y + h), box(0, w, y, y + h // 2)
        elif kind == 1:  # later against earlier half
            a, b = box(w - w // 2, w, y, y + h), box(0, w // 2, y, y + h)
        elif kind == 2:  # checkerboard
            a = box(0, w // 2, y, y + h // 2) + box(w - w // 2, w, y + h // 2, y + h)
            b = box(0, w // 2, y + h // 2, y + h) + box(w - w // 2, w, y, y + h // 2)
        else:  # middle third against the rest
            third = max(1, w // 3)
            a = box(third, 2 * third, y, y + h)
            b = box(0, w, y, y + h) - a
        v = np.log1p(a) - np.log1p(b)
        level = (v > -0.3).astype(np.uint32) + (v > 0) + (v > 0.3)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1))).astype(np.uint32)
    return out.view(np.int32)


def _render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 256):
            part = pdf.iloc[at : at + 256]
            yield part.drop(columns="text").assign(audio=[to_wav(notes_of(t)) for t in part["text"]])


def render(texts: DataFrame) -> DataFrame:
    """(rec_id, audio) of (rec_id, text)."""
    return texts.select("rec_id", "text").mapInPandas(_render, "rec_id long, audio binary")


def _fingerprints(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for x in pdf[column]:
            samples = from_wav(x if column == "audio" else to_wav(notes_of(x)))
            c = chroma(samples)
            f = fingerprint(c)
            rows.append((len(c), f, None if len(f) else hashlib.md5(samples.tobytes()).hexdigest()))
        yield pd.DataFrame({"rec_id": pdf["rec_id"].astype("Int64"), "n_frames": [n for n, _, _ in rows], "fp": [f for _, f, _ in rows], "fp_crc32": [zlib.crc32(f.tobytes()) for _, f, _ in rows], "sound": [h for _, _, h in rows]})


def fingerprints(recordings: DataFrame, column: str = "audio") -> DataFrame:
    """(rec_id, n_frames, fp, fp_crc32, sound) of (rec_id, audio), or of the recordings rendered from (rec_id, text).

    A text's recording is made, read and dropped before the next one, so no batch of audio is held; for
    stored audio keep ``spark.sql.execution.arrow.maxRecordsPerBatch`` small. ``sound`` is a digest of the
    samples where they are too few for an integer.
    """
    return recordings.select("rec_id", column).mapInPandas(partial(_fingerprints, column=column), "rec_id long, n_frames long, fp array<int>, fp_crc32 long, sound string")


def _bit_errors(batches: Iterator[pd.DataFrame], most_error: float) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for q, m, a, b, offsets in zip(pdf["class_id"], pdf["match_id"], pdf["q_fp"], pdf["fp"], pdf["offsets"], strict=True):
            a, b = np.asarray(a, np.int32), np.asarray(b, np.int32)
            for o in sorted(offsets, key=lambda o: (-o["votes"], abs(o["offset"]), -o["offset"])):
                off = int(o["offset"])
                lo, hi = max(0, -off), min(len(a), len(b) - off)
                error = float(np.unpackbits((a[lo:hi] ^ b[lo + off : hi + off]).view(np.uint8)).sum()) / (32 * max(1, hi - lo))
                if error <= (most_error if hi - lo > 1 else 0):
                    rows.append((q, m, off, o["votes"], hi - lo, error))
                    break
        yield pd.DataFrame(rows, columns=["class_id", "match_id", "offset", "votes", "shared", "bit_error"])


def align(prints: DataFrame, is_query: Column, votes: int = 4, most_error: float = 0.1) -> DataFrame:
    """Member rows (rec_id, class_id, n_frames, fp_crc32) and pair rows (class_id, match_id, offset, shared,
    bit_error) in one table, told apart by ``kind``.

    is_query: condition on rec_id; a class with such a member is searched for in all classes.
    votes: equal keys that an offset needs where the shorter recording has 8 * votes keys; an eighth of its keys
    where it has fewer, one at least. A key is two integers of adjacent, separate windows: one alone has so few
    bits of its own that chance hits would grow with the square of the input. Recordings with fewer keys than
    ``votes`` lie whole in the other one or not at all; single integers are their keys. most_error: largest
    share of differing bits; an alignment of one integer must be exact, since its 32 bits (some 18 of their own)
    cannot tell a near hit from chance, and chance hits grow with the square of the input. All offsets with enough votes are tried; of those that pass, the one of most votes is named.
    """
    tmp = Scratch(prints.sparkSession)
    key = F.when(F.size("fp") > 0, F.md5(F.concat_ws(",", F.transform("fp", lambda x: x.cast("string"))))).otherwise(F.concat_ws("/", F.lit("short"), "n_frames", "sound"))
    seen = tmp.put(prints.withColumn("key", key), "prints")
    classes = seen.groupBy("key").agg(F.min("rec_id").alias("class_id"), F.max(is_query.cast("int")).alias("asks"))
    reps = tmp.put(seen.select("key", F.col("rec_id").alias("class_id"), "fp").join(classes, ["key", "class_id"]).select("class_id", "asks", "fp").dropDuplicates(["class_id"]), "reps")
    next_fp = F.slice("fp", WIDEST + 1, F.greatest(F.size("fp") - WIDEST, F.lit(0)))
    least = WIDEST + votes  # integers of a recording with ``votes`` keys
    n = F.size("fp").alias("n")
    two = reps.filter(F.size("fp") >= least).select("class_id", "asks", n, F.posexplode(F.arrays_zip(F.col("fp").alias("a"), next_fp.alias("b"))).alias("at", "w"))
    posted = two.filter("w.b is not null").select("class_id", "asks", "n", "at", F.xxhash64("w.a", "w.b").alias("value"))
    one = reps.select("class_id", "asks", n, F.posexplode("fp").alias("at", "value")).withColumn("value", F.col("value").cast("long"))
    few = one.filter(F.col("n") < least)

    def met(posted: DataFrame, asked: DataFrame, needed: Column) -> DataFrame:
        asked = tmp.put(asked.filter("asks = 1").select(F.col("class_id").alias("q"), F.col("at").alias("q_at"), F.col("n").alias("q_n"), "value"), "asked")
        counts = asked.groupBy("value").agg(F.count("*").alias("c"))
        hot = counts.filter(F.col("c") > max(100, asked.count() // 2000)).select("value", F.lit(True).alias("hot"))  # fewer than 2,000
        deal = F.when(F.col("hot"), F.pmod(F.xxhash64("match_id", "at"), F.lit(SALTS))).otherwise(0).cast("int")
        left = posted.select(F.col("class_id").alias("match_id"), "at", "n", "value").join(F.broadcast(hot), "value", "left").withColumn("salt", deal).drop("hot")
        every = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
        right = asked.join(F.broadcast(hot), "value", "left").withColumn("salt", every).drop("hot")
        return (
            left.join(right, ["value", "salt"])
            .filter(F.col("match_id") != F.col("q"))
            .groupBy("q", "match_id", "n", "q_n", (F.col("at") - F.col("q_at")).alias("offset"))
            .agg(F.count("*").alias("votes"))
            .filter(F.col("votes") >= needed)
        )

    shorter = F.least("n", "q_n")
    eighth = F.greatest(F.lit(1), F.least(F.lit(votes), F.floor((shorter - WIDEST) / 8)))
    hits = met(posted, posted, eighth).unionByName(met(one, few, F.lit(1))).unionByName(met(few, one.filter(F.col("n") >= least), F.lit(1)))
    shared = F.least(F.col("q_n"), F.col("n") - F.col("offset")) - F.greatest(F.lit(0), -F.col("offset"))
    tried = hits.filter(shared >= F.least(shorter, F.lit(least))).groupBy("q", "match_id").agg(F.collect_list(F.struct("votes", "offset")).alias("offsets"))
    fps = reps.select("class_id", "fp")
    both = tried.join(fps.select(F.col("class_id").alias("match_id"), "fp"), "match_id").join(fps.select(F.col("class_id").alias("q"), F.col("fp").alias("q_fp")), "q")
    pairs = both.select(F.col("q").alias("class_id"), "match_id", "offsets", "fp", "q_fp").mapInPandas(partial(_bit_errors, most_error=most_error), "class_id long, match_id long, offset int, votes long, shared long, bit_error double")
    members = seen.join(classes, "key").select(F.lit("member").alias("kind"), "rec_id", "class_id", "n_frames", "fp_crc32")
    return members.unionByName(pairs.withColumn("kind", F.lit("pair")), allowMissingColumns=True)
