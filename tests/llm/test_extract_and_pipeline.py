import html as htmllib
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarn.llm import common
from tarn.llm import tree_extract as X

SF = "/root/testdata/sf0.001"


def expected(source):
    a = source.find("<article>")
    inner = source[a + 9 : (source.find("</article>") if "</article>" in source else None)] if a >= 0 else ""
    inner = re.sub(r"<[^>]*$", "", inner)
    blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))
    return " ".join(x for x in (" ".join(htmllib.unescape(b).split()) for b in blocks) if x)


@pytest.fixture(scope="module")
def model(spark):
    return X.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_held_out_pages(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("page_id >= 1500").collect()
    got = X._texts([r.html for r in rows], model)
    assert np.mean([g == expected(r.html) for g, r in zip(got, rows, strict=True)]) >= 0.99


def test_pages_that_no_element_divides(model):
    """Bare text, with inline marks or breaks, in html and body or without any tag, is text as a whole."""
    bare = "Short note, written <b>without</b> blocks<br>at all &amp; kept.<script>x</script>"
    want = ["Short note, written without blocks at all & kept."] * 3
    assert X._texts([bare, f"<html><head><title>t</title></head><body>{bare}</body></html>", f"<body class='sidebar'>{bare}"], model) == want


def test_hard_pages(model):
    prose = "".join(f"<p>Some longer sentence number {i}, which says a thing or two about it.</p>" for i in range(5))
    page = f'<html><head><title>T</title></head><body><div><a href=a>Home</a> <a href=b>News</a></div><div>{prose}</div><div class="comments"><p>Great post, thanks.</p></div><aside><p>Side text here, more.</p></aside><form><p>Name please, now.</p></form><script>x="</p>"</script><footer>&copy; x</footer></body></html>'
    want = " ".join(f"Some longer sentence number {i}, which says a thing or two about it." for i in range(5))
    assert X._texts([page], model) == [want]
    assert X._texts(["", None, "<p", "<<<>>><a<b", "<!-- x", "<script>", "a&am"], model)[:3] == ["", "", ""]
    nested = "<article>" + "<div>" * 3000 + "<p>deep &amp; x</p>"
    assert isinstance(X._texts([nested], model)[0], str)


PROSE = ["Of a longer kind is this one. It says, in short, a thing.", "The second goes on about it, and on, and on again.", "Short one.", "The last of them ends it, as it should, in good order."]
PS, ALL = "".join(f"<p>{p}</p>" for p in PROSE), " ".join(PROSE)
NAV = "<nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>"
PAGES = {
    "main": (f"<header><h1>Site</h1><p>Tag line of the site.</p></header>{NAV}<main>{PS}</main><footer>x y</footer>", ALL),
    "cookie": (f'<div class="cookie-notice"><p>We use cookies to improve, and so on.</p></div>{NAV}<article>{PS}</article>', ALL),
    "comments": (f'{NAV}<article>{PS}<section class="comments"><div class="comment"><p>I like this one, thanks a lot.</p></div></section></article>', ALL),
    "after": (f'{NAV}<article>{PS}</article><div id="comments"><p>I like this one, thanks.</p></div><form><label>Your name</label></form>', ALL),
    "plain": (f'<div class="menu"><a href=a>A</a><a href=b>B</a></div><div class="content">{PS}</div><div class="footer">c</div>', ALL),
    "list": (f"{NAV}<article><p>{PROSE[0]}</p><ul><li>first item of it</li><li>second item</li></ul></article>", PROSE[0] + " first item of it second item"),
    "table": (f"{NAV}<article><p>{PROSE[0]}</p><table><tr><td>one cell</td><td>two cell</td></tr></table></article>", PROSE[0] + " one cell two cell"),
    "bare": (f"{NAV}<article>{PROSE[0]}<br>{PROSE[1]}</article>", " ".join(PROSE[:2])),
    "tiny": (f'{NAV}<div class="ad">Buy it.</div><article><h1>Éaux.</h1><p>Éaux.</p></article><footer>x</footer>', "Éaux. Éaux."),
}


@pytest.mark.parametrize("name", PAGES)
def test_templates(model, name):
    body, want = PAGES[name]
    assert X._texts([f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>"], model) == [want]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    model = {"w": rng.normal(size=(3, X.WIDTH)), "b": rng.normal(size=3), "prior": np.log(np.full(3, 1 / 3)), "pair": np.log(rng.dirichlet(np.ones(3), 3)), "root": np.log(rng.dirichlet(np.ones(3)))}
    parent, depth, x = np.array([0, 0, 0, 1, 1]), np.array([0, 1, 1, 2, 2]), rng.normal(size=(5, X.WIDTH))
    u = x @ model["w"].T + model["b"]
    total = np.zeros((5, 3))
    for s in np.ndindex(*[3] * 5):
        p = np.exp(sum(u[i, s[i]] for i in range(5)) - sum(np.log(np.exp(u).sum(1))) + model["root"][s[0]] + sum(model["pair"][s[parent[i]], s[i]] for i in range(1, 5)))
        for i in range(5):
            total[i, s[i]] += p
    assert np.allclose(X.marginals(x, parent, depth, model), total / total.sum(1, keepdims=True))


def test_extract_edge_tables(spark):
    schema = "page_id long, url string, html string, text string"
    assert X.extract(spark.createDataFrame([], schema)).count() == 0
    out = X.extract(spark.createDataFrame([(1, None, None, "c"), (1, "u", "<article><p>a b</p></article>", "c"), (None, "u", "", "c")], schema)).collect()
    assert len(out) == 3 and all(r.n_chars == len(r.text) for r in out)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    n, at = docs.count(), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SF).cache()
        assert out.columns == corpus_pipeline.COLUMNS and out.count() <= at.count(), name
        if name == "quality_classifier":
            kept = {r.doc_id for r in out.select("doc_id").collect()}
            assert np.mean([(i in kept) == (q == 1) for i, q in labels.items()]) >= 0.9
        if name == "near_dedup":
            assert out.groupBy("text").count().filter("count > 1 and length(trim(text)) > 0").count() == 0
        if name == "secret_scan":
            assert out.count() == at.count() and out.filter("text rlike 'token = \"[0-9a-f]{32}'").count() == 0
        at = out
    last = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert last.select("doc_id").distinct().count() == at.count() <= n


DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id long"


def plain_near_dedup(rows, k=5):
    """Ids that stay: the smallest of each component of texts alike to 80 of 100 in word shingles."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if comp[a] < comp[b] and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[b], changed = comp[a], True
    return {i for i in comp if comp[i] == i}


def test_pipeline_stages_by_brute_force(spark):
    """Near copies, secrets, budgets and sequences of a small table, each stage on its own input."""
    base = [f"word{i % 37}x{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base[:58] + ["other", "end"]), " ".join(base[::-1]), "one two", "", None, " ".join(base), 'long one here token = "abcdef0123456789" and so on it goes']
    rows = [(i, t, "en" if i % 2 else "de", f"src{i}", len(t or ""), "clash", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None, "no id", None, None, None, "", 1), (3, "one two", "en", "src3", 7, "", 1)], DOCS)
    stages = dict(corpus_pipeline.STAGES)
    out = stages["near_dedup"](spark, df, SF)
    assert out.columns == corpus_pipeline.COLUMNS
    got = sorted(r.doc_id if r.doc_id is not None else -1 for r in out.collect())
    assert got == sorted([-1, *plain_near_dedup([(i, t) for i, t in enumerate(texts)])])
    clean = {r.doc_id: r for r in stages["secret_scan"](spark, df, SF).collect()}
    assert clean[7].text == "long one here [SECRET]\" and so on it goes" and clean[7].n_chars == len(clean[7].text) and clean[0].text == texts[0]
    mixed = stages["mixture"](spark, df, SF).collect()
    tokens = {i: len((t or "").split()) for i, t in enumerate(texts)}
    used = sum(tokens[r.doc_id] for r in mixed if r.doc_id is not None)
    assert 0 < used <= 0.9 * (sum(tokens.values()) + 2) and sum(r.doc_id is None for r in mixed) == 1
    packed = stages["packing"](spark, df, SF)
    assert packed.filter("doc_id is not null").select("doc_id").distinct().count() == 8
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_stages_take_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_stages_bound_batches_by_bytes(spark):
    """No stage holds 10,000 whole texts at once: batches are bounded by bytes, whole, and change no result."""
    key, most = corpus_pipeline.BATCH_LIMIT, corpus_pipeline.BATCH_BYTES
    texts = [f'number {i} token = "abcdef01234567{i:02d}" ' + f"word{i} " * 20_000 for i in range(40)] + ["x " * most, None, ""]
    rows = [(i, t, "en", "src", len(t or ""), "", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1), DOCS)

    def held(batches):
        for pdf in batches:
            yield pd.DataFrame({"rows": [len(pdf)], "before_last": [sum(len(t or "") for t in pdf["text"][:-1])]})

    stages, before = dict(corpus_pipeline.STAGES), spark.conf.get(key, None)
    try:
        spark.conf.set(key, str(2**31 - 2))  # a session's own limit holds
        want = {name: sorted(stages[name](spark, docs, SF).collect()) for name in ("secret_scan", "packing")}
        assert spark.conf.get(key) == str(2**31 - 2)
        for name, stage in stages.items():
            spark.conf.unset(key)
            stage(spark, spark.createDataFrame([], DOCS), SF)
            sizes = docs.mapInPandas(held, "rows long, before_last long").collect()
            assert sum(r.rows for r in sizes) == len(texts), name
            assert max(r.before_last for r in sizes) < most and len(sizes) > 5, name
        got = {name: sorted(stages[name](spark, docs, SF).collect()) for name in want}
        assert all([r[0] for r in got[n]] == [r[0] for r in want[n]] for n in want)
        assert got["secret_scan"] == want["secret_scan"]
        cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert [[r[c] for c in cols] for r in got["packing"]] == [[r[c] for c in cols] for r in want["packing"]]
    finally:
        spark.conf.unset(key)
        if before is not None:
            spark.conf.set(key, before)


def test_run_leaves_one_table(spark, tmp_path, monkeypatch):
    for t in ("documents", "labels"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        (df.limit(60) if t == "documents" else df).write.parquet(str(tmp_path / f"{t}.parquet"))
    root = tmp_path / "scratch"
    monkeypatch.setattr(common, "scratch_dir", lambda spark: str(root))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert [p.name.split("-")[0] for p in root.iterdir()] == ["packing"]


@pytest.mark.parametrize("source", ["<div>" * 400_000, "<div><p>x" * 200_000, "<b><p>" * 300_000, "<p>x" * 400_000, "<a '" * 400_000, "<" * 2_000_000, "</b>" * 400_000])
def test_hostile_pages_take_linear_time(model, source):
    def seconds(s):
        start = time.process_time()
        X._texts([s], model)
        return time.process_time() - start

    small, whole = seconds(source[: len(source) // 4]), seconds(source)
    assert whole < 8 * small + 2 and whole < 30


def test_deep_nesting_keeps_text_and_order(model):
    page = X.Page("<article>" + "<div>" * 2000 + "<p>one</p>" + "</div>" * 1500 + "<p>two</p></article><p>three")
    assert [t for _, t, _ in page.blocks] == ["one", "two", "three"] and max(page.depth) <= X.DEEPEST + 1


def test_class_names_decide_no_label():
    page = X.Page('<article><div class="comments"><p>a</p></div><div data-put-in class="x"><p>b</p></div><nav><p>c</p></nav></article>')
    state = page.labels()
    assert [int(state[n]) for n, _, _ in page.blocks] == [2, 0, 0]
