import glob
import gzip

import pytest
from pyspark.sql import functions as F

from tarn.llm.arc_convert import Stream, arc_records, arc_to_records, convert, mark_revisits, parse_arc, parse_warc, read_warc, write_warc
from tarn.llm.url_rules import judge

PAGES = "page_id long, url string, html string, record_type string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], PAGES)


def test_round_trip_and_revisits(spark, tmp_path):
    big, tricky = "é" * 600, "a\r\n\r\nWARC/1.1\r\n\r\nhttp://x 1.2.3.4 20260101000000 text/html 5\n" * 40
    rows = [(1, "http://a/ b", big), (2, "http://b/", big), (3, None, big), (4, "http://c/", "short"), (5, "http://c/", "short"), (6, "", None), (7, "u", tricky), (8, "u", tricky), (9, "z", "")]
    got = {r.page_id: r for r in convert(pages(spark, rows), str(tmp_path / "w")).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None), 7: ("revisit", 8), 8: ("response", None), 9: ("response", None)}
    for i, _, html in rows:
        raw = (html or "").encode()
        assert got[i].payload_bytes == len(raw)
        assert got[i].payload_digest == __import__("hashlib").sha1(raw).hexdigest()
    assert convert(pages(spark, []), str(tmp_path / "e")).count() == 0
    assert convert(pages(spark, [(None, "u", "x")]), str(tmp_path / "n")).collect()[0].page_id is None


@pytest.mark.parametrize("version,fields", [(1, 5), (2, 10)])
def test_arc_versions(spark, version, fields):
    blob = bytes(arc_records(pages(spark, [(7, "http://x/ y", "bödy\n\n")]), F.lit(version)).collect()[0].arc)
    (r,) = parse_arc(blob)
    assert len(r) == fields + 1 and r["URL"] == "http://x/%20y" and r["block"].endswith("bödy\n\n".encode())
    with pytest.raises(ValueError):
        list(parse_arc(blob[:-8]))


def test_warc_members_and_bad_length():
    rec = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in parse_warc(gzip.compress(rec) + gzip.compress(rec))] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(parse_warc(rec.replace(b": 3", b": 2")))


def test_gzip_archives_of_many_records():
    one = b"filedesc://x.arc 0.0.0.0 20260101000000 text/plain 77\n1 0 x\nURL IP-address Archive-date Content-type Archive-length\n" + b" " * 13
    head, rest = one.split(b"\n", 1)
    head = head.rsplit(b" ", 1)[0] + b" " + str(len(rest)).encode()
    parts = [head + b"\n" + rest + b"\n"] + [f"http://h/{i} 1.2.3.4 20260102030405 text/html {5000 + i}\n".encode() + bytes([97 + i]) * (5000 + i) + b"\n" for i in range(9)]
    for blob in (b"".join(parts), gzip.compress(b"".join(parts)), b"".join(gzip.compress(p) for p in parts)):
        got = list(parse_arc(blob))
        assert [r["URL"] for r in got] == [f"http://h/{i}" for i in range(9)]
        assert all(r["block"] == bytes([97 + i]) * (5000 + i) for i, r in enumerate(got))
        with pytest.raises(ValueError):
            list(parse_arc(blob[:-300]))


def test_streams_hold_one_piece():
    s = Stream(gzip.compress(b"x" * 10_000_000 + b"\n" + b"y" * 10), piece=1000)
    assert s.take(5) == b"xxxxx" and len(s.held) < 2_000_000
    assert len(s.until(b"\n")) == 9_999_995 and s.take(99) == b"y" * 10 and s.take(1) == b""


def test_files_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, "u", chr(97 + i % 26) * (3000 + i)) for i in range(300)]
    src = arc_to_records(arc_records(pages(spark, rows).coalesce(2), F.lit(2)))
    marked = mark_revisits(src, src.select("page_id", "record_id", "payload_bytes", "payload_digest"))
    write_warc(marked, str(tmp_path / "w"), file_bytes=50_000)
    files = [gzip.open(f, "rb").read() for f in glob.glob(f"{tmp_path}/w/*/*.gz")]
    assert len(files) >= 18 and max(map(len, files)) <= 56_000
    kinds = [[h["WARC-Type"] for h, _ in parse_warc(f)] for f in files]
    assert all(k[0] == "warcinfo" and set(k[1:]) == {"response"} for k in kinds)
    assert sorted(r.page_id for r in read_warc(spark, str(tmp_path / "w")).collect()) == list(range(300))


def test_revisits_of_pages_without_id_and_of_hot_payloads(spark, tmp_path):
    big, other = "x" * 1500, "y" * 1500
    rows = [(None, "a", big), (4, "b", big), (None, "c", other), (None, "d", other), *[(100 + i, "h", "z" * 1200) for i in range(2500)]]
    got = convert(pages(spark, rows), str(tmp_path / "w")).collect()
    assert [(r.record_type, r.refers_to) for r in got if r.target_uri in "ab"] == [(("revisit", 4) if r.target_uri == "a" else ("response", None)) for r in got if r.target_uri in "ab"]
    assert sorted(r.record_type for r in got if r.target_uri in "cd") == ["response", "revisit"]
    hot = {r.page_id: (r.record_type, r.refers_to) for r in got if r.target_uri == "h"}
    assert hot[2599] == ("response", None) and all(hot[100 + i] == ("revisit", 2599) for i in range(2499))


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("b.com", "/de/x", "allow"), ("net", "", "block")]
URLS = ["http://example.org/es/a", "https://www.example.org/en/12?x#y", "http://xexample.org/es/a", "http://EXAMPLE.ORG/en/2", "ftp://b.com/de/x/y", "http://a,b.com/de/q", "http://a.b.com/de/q", "nourl", None, "http://", "http://com/fr/", "http://u@h.net:80?q=/de/", "://org", "http://a.net#f", "http://é.org/es/", "x\n://q.org/"]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_urls_equal_brute_force(spark, parts):
    urls = URLS * 5
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(df, spark.createDataFrame(RULES, "host string, path string, verdict string"), parts=parts).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        end = min([k for k in (rest.find(c, cut) for c in "?#") if k >= 0], default=len(rest))
        path = rest[cut:end]
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert got[i] == (host, path, best and best[2], best[3] if best else "allow"), u


def test_urls_empty_tables(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    (r,) = judge(spark.createDataFrame([(None, "http://a.b/c")], "page_id long, url string"), rules).collect()
    assert (r.page_id, r.host, r.rule, r.verdict) == (None, "a.b", None, "allow")
