"""Operators on pages: URL rules against a plain loop, WARC archives byte by byte."""

import glob
import gzip
import io
import random

import pytest

from checks.compare import compare, duck
from convocases.llm import urls, warc
from convocases.llm.queries import QUERIES, SQL, URL_RULES

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, path string, verdict string, payload string, _at int"


def plain(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.mark.parametrize("block_rows", [3, 5_000])
def test_urls_against_a_loop(spark, block_rows):
    r = random.Random(8)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "net", "A.net", "", "a.com:80", "ü.net"]
    paths = ["", "/", "/e", "/en/", "/en/x", "/en", "/é/", "/\U0010ffff/x"]
    tails = ["", "?q=/en/", "#/en/", "?a://b"]
    rules = sorted({(r.choice(hosts).lower(), r.choice(paths), r.choice(["allow", "block"])) for _ in range(40)})
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    rows = [(i, "https://" + r.choice(hosts) + r.choice(paths) + r.choice(tails), None, "h", "p", "v", "x", 1) for i in range(300)]
    rows += [(1000, None, None, "h", "p", "v", "x", 1), (1001, "no url", "", "h", "p", "v", "x", 1), (1002, "", "", "h", "p", "v", "x", 1), rows[0]]
    rows += [(2000 + i, "https://hot.a.com/en/same", None, "h", "p", "v", "x", 1) for i in range(100)]
    found = urls.judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, "host string, path string, verdict string"),
                            block_rows=block_rows)
    assert sorted((tuple(x) for x in found.collect()), key=str) == sorted(((i, *plain(u, rules)) for i, u, *_ in rows), key=str)


def test_urls_without_rows_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert urls.judge_urls(pages.where("false"), rules).count() == 0
    assert [tuple(x) for x in urls.judge_urls(pages, rules.where("false"), "block").collect()] == [(1, "a.com", "/", None, "block")]


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op8_url_filters", "op10_warc"])
def test_queries_against_sql(spark, name):
    assert compare(spark, duck(SF), SF, name, QUERIES[name], SQL[name]) == ""


@pytest.fixture()
def pages(spark):
    big = "<p>" + "ü\r\n\r\nWARC/1.1\r\n" * 20_000
    rows = [(5, "http://a/\r\nX: y", "x" * 100), (3, None, "x" * 100), (4, "u", "x" * 99), (2, "u", "x" * 99), (1, "u", None), (9, "u", ""),
            (7, "u", big), (6, "u", big), (5, "http://a/\r\nX: y", "x" * 100), (None, "u", "null id")]
    return spark.createDataFrame([(*r, "h", "p", "v", "x", 1) for r in rows], PAGES), rows, big


def test_archives(spark, pages, tmp_path):
    df, rows, big = pages
    folder = f"file://{tmp_path}/out"
    found = warc.archive_pages(df, folder, with_payload=True).collect()
    assert sorted(str(r.page_id) for r in found) == sorted(str(r[0]) for r in rows)
    kinds = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in found}
    assert kinds == {
        5: ("revisit", 3, 100), 3: ("response", None, 100), 4: ("response", None, 99), 2: ("response", None, 99), 1: ("response", None, 0),
        9: ("response", None, 0), 7: ("revisit", 6, len(big.encode())), 6: ("response", None, len(big.encode())), None: ("response", None, 7),
    }
    html = {r[0]: (r[2] or "").encode() for r in rows}
    assert all(bytes(r.payload) == html[r.page_id] for r in found if r.record_type == "response")
    # The monolithic files are one stream each; the normal ones have a member for each record, where the index says.
    for path in glob.glob(f"{tmp_path}/out/monolithic/*.gz"):
        data = open(path, "rb").read()
        assert len(list(warc.members(data))) <= 1
    files = {p.split("archive=")[1].split("/")[0]: open(p, "rb").read() for p in glob.glob(f"{tmp_path}/out/normal/archives/archive=*/part-*")}
    index = spark.read.parquet(f"{folder}/normal/index").collect()
    assert len(index) == len(rows)
    for entry in index:
        member = files[entry.archive][entry.record_offset:entry.record_offset + entry.record_length]
        fields, _ = warc.parse(gzip.decompress(member))
        assert (fields["warc-record-id"], fields["warc-type"]) == (entry.record_id, entry.record_type)
    for data in files.values():
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(list(warc.members(data)))


def test_archives_of_a_page_id_with_different_payloads(spark):
    x, y, z = ("x" * 200, "y" * 200, "z" * 200)
    rows = [(1, x), (2, x), (2, y), (3, z), (7, x), (7, z)]
    df = spark.createDataFrame([(i, f"u{i}", t) for i, t in rows], "page_id long, url string, html string")
    found = warc.archive_pages(df, with_payload=True).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to or 0, bytes(r.payload or b"").decode()) for r in found) == [
        (1, "response", 0, x), (2, "response", 0, y), (2, "revisit", 1, ""), (3, "response", 0, z), (7, "revisit", 1, ""), (7, "revisit", 3, "")]
    assert len({r.payload_digest for r in found if r.page_id == 7}) == 2


def test_archives_without_pages(spark, pages):
    assert warc.archive_pages(pages[0].where("false")).count() == 0


def test_inflating_members_and_damage():
    whole = b"".join(gzip.compress(bytes([i]) * 100_000) for i in range(3))
    assert b"".join(warc.inflated(whole)) == b"".join(bytes([i]) * 100_000 for i in range(3))
    found = list(warc.members(whole))
    assert [len(d) for _, _, d in found] == [100_000] * 3 and [whole[a:a + 2] for a, _, _ in found] == [b"\x1f\x8b"] * 3
    assert sum(n for _, n, _ in found) == len(whole)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.inflated(whole[:-5]))
    with pytest.raises(ValueError, match="starts with"):
        list(warc.records(io.BufferedReader(io.BytesIO(b"HTTP/1.1 200 OK\r\n\r\n"))))
