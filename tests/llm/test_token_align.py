import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarn.llm import queries as Q
from tarn.llm.token_align import TwoTokenizers, align, align_tokenizers

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, row string, n_a int, pair long, left string"


@pytest.fixture(scope="module")
def files():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def two(files):
    return TwoTokenizers(*files)


def tokens(two, text):
    """Ids and byte ranges of both sides for a whole text, or nothing."""
    if not text:
        return [], []
    ids = two.a.encode(f" {text}", add_special_tokens=False).ids, two.b.encode(text)
    out = []
    for side, table in zip(ids, (two.bytes_a, two.bytes_b), strict=True):
        at, line = 0, []
        for i in side:
            line.append((i, at, at + len(table[i])))
            at += len(table[i])
        if b"".join(table[i] for i in side) != f" {text}".encode():
            return [], []
        out.append(line)
    return tuple(out)


def plain(two, rows):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(two, text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ";".join(",".join(str(x[0]) for x in a if s < x[2] <= e) + "|" + ",".join(str(y[0]) for y in b if s < y[2] <= e) for s, e in zip([0, *ends], ends, strict=False))
        counts.update(links)
        docs.append((doc_id, len(a), len(b), len(ends), links, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return sorted((str(d), na, nb, g, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), h) for d, na, nb, g, links, h in docs)


def run(df, files, **how):
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    out = align_tokenizers(df, *files, **how)
    assert out.columns == cols
    return sorted((str(r[0]), *r[1:]) for r in out.collect())


ODD = ["", None, " ", "a", "  two  gaps ", "x\n\ny\t z", "▁mark ▁", "<|endoftext|> <s></s>", "don 't 's", "é́ﬁ　x\xa0y", "\x00\x01 a\x00b", "日本語 テキスト", "🙂🙂 👩‍👩‍👧", "a" * 5000, "ab12 " * 700, "\n", "trail ", " lead", "</s> <unk> <0x41>"]


def test_equals_brute_force_on_odd_texts(spark, two, files):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (3, "a"), (None, "no id at all"), (None, None)]
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    want = plain(two, rows)
    assert sum(w[1] for w in want) > 1000
    for most_hot in (200_000, 20, 0):
        assert run(df, files, most_hot=most_hot) == want
    assert run(df.limit(0), files) == []


def test_query_equals_brute_force(spark, two, files):
    df = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 1500")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert len(rows) > 500 and run(df, files, most_hot=1000) == plain(two, rows)
    whole = Q.op13_diagonal_align(spark, SF)
    assert whole.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "\n", "▁", "é", "the", " word", "'s", "9", "  ", "\x00", "|", "<s>", " "]), max_size=12))
def test_words_encode_like_whole_texts(two, parts):
    text = "".join(parts)
    a, b = next(iter(two.encode([text])))
    want = tokens(two, text)
    assert (a.tolist(), b.tolist()) == tuple([x[0] for x in side] for side in want)


@given(st.lists(st.integers(1, 5), min_size=1, max_size=60), st.data())
def test_run_skipping_equals_all_overlaps(gaps, data):
    a = [sum(gaps[: i + 1]) for i in range(len(gaps))]
    cuts = data.draw(st.sets(st.integers(1, a[-1])))
    b = sorted({x for x in a if data.draw(st.integers(0, 3))} | cuts | {a[-1]}) if data.draw(st.booleans()) else list(a)
    la, lb, last_a, last_b = align(a, b)
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(([0] + a)[i], ([0] + b)[j]) < min(a[i], b[j])]
    assert list(zip(la, lb, strict=True)) == want
    common = set(a) & set(b)
    assert [x for x, m in zip(a, last_a, strict=True) if m] == [x for x, m in zip(b, last_b, strict=True) if m] == sorted(common)
