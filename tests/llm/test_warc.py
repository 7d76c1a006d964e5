"""Archives and their index, round trip."""

import base64
import hashlib

from lexiloom.llm import warc

ROWS = [(5, "http://www.a.com/x?q=1", "<p>same</p>", "e"), (3, "http://a.com/", "<p>same</p>", "e"), (9, "http://b.org/\r\nX: y", None, "e"),
        (1, None, "", "e"), (7, "no scheme", "\r\n\r\n é 😀 WARC/1.1\r\n\r\n", "e"), (3, "http://a.com/", "<p>same</p>", "e"),
        (None, "http://a.com/null", "<p>same</p>", "e"), (11, "http://z.net/long", "x" * 3_000_000, "e"), (12, "http://a.com/", "other", "e")]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha string").repartition(3)


def expected(least=0):
    first = {}
    for page, _, html, _ in ROWS:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, url, html, _ in ROWS:
        body = (html or "").encode()
        later = len(body) >= least and (page is None or page > first[html or ""])
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((str(page) if page is not None else None, len(body), sha, "revisit" if later else "response", str(first[html or ""]) if later else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    for least in (0, 100):
        archive = warc.write(table(spark), least_bytes=least, block_lines=2, file_bytes=200)
        rows = warc.read(archive, warc.captures(archive)).collect()
        assert sorted(((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(least)
        for r in rows:
            assert (r.payload is None) == (r.record_type == "revisit")
        assert archive.directory.count() > 2


def test_lookup(spark):
    archive = warc.write(table(spark), block_lines=2)
    found = warc.read(archive, warc.lookup(archive, ["http://A.com/", "http://www.a.com/x?q=1", "http://absent.com/", "no scheme"])).collect()
    assert sorted(r.page for r in found) == ["12", "3", "3", "5", "7"]
    assert warc.lookup(archive, []).count() == 0


def test_lookup_of_any_number(spark, monkeypatch):
    """Many ranges of the directory, a key of many blocks, absent keys before, between and behind, against a plain search."""
    monkeypatch.setattr(warc, "HEADS", 7)
    hosts = [f"h{i:03d}" for i in range(60)]
    rows = [(i, f"http://{'h030' if i % 3 == 0 else hosts[i % 60]}.com/{i % 5}", str(i), "e") for i in range(600)] + [(1000, None, "n", "e")]
    archive = warc.write(table(spark, rows), block_lines=4)
    urls = [f"http://{h}.com/{i}" for h in hosts[::2] for i in (0, 3, 9)] + ["http://h030.com/0", "http://h.aa/", "http://h.zz/", None, None]
    held = [None if u is None else u for u in urls]
    for wanted in (urls, spark.createDataFrame([(u,) for u in held], "url string")):
        found = [r.page for r in warc.read(archive, warc.lookup(archive, wanted)).collect()]
        assert sorted(found) == sorted(str(page) for page, url, _, _ in rows if url in urls)
    every = warc.read(archive, warc.lookup(archive, table(spark, rows).select("url"))).count()
    assert every == len(rows) == warc.captures(archive).count()


def test_empty(spark):
    archive = warc.write(table(spark).limit(0))
    assert warc.lookup(archive, ["http://a.com/"]).count() == 0
    assert warc.read(archive, warc.captures(archive)).count() == 0


def test_record_survives_header_characters():
    fields = warc.parse(warc.record("1", "http://a/\r\nEvil: 1", b"body", None))
    assert fields["url"] == "http://a/%0D%0AEvil: 1" and fields["payload"] == b"body"
