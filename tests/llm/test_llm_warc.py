import gzip
import hashlib
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from compare import connect, difference, duck_result, spark_result
from text_cases import SF

from lakeassay.llm import oracles, queries, warc

SCHEMA = "page_id long, url string, html string, file string, offset string, length string, first string, key string, body string, original string"
BIG, MANY = "é" * 50, "<p>" + "wort " * 40_000
PAGES = [
    (3, "http://a/1", BIG), (1, "http://b/?q=1 2\r\nX: y%20", BIG), (2, None, BIG), (None, "http://c/", BIG), (1, "http://b/again", BIG),
    (4, "", "x" * 99), (5, "http://d/", "x" * 99), (6, "http://d/", None), (7, "http://ü/", ""), (8, "u", MANY), (9, "u", MANY),
    (None, "n", "only without id " * 20), (None, "n", "only without id " * 20), (10, "h", "WARC/1.1\r\n\r\nHTTP\r\n\r\n" * 9), (11, "z", "\x00\x1f " * 60)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, *["own"] * 7) for p in PAGES], SCHEMA).repartition(3)


def records(rows, least=100):
    """What is written, in plain Python: (id, url, type, original, bytes, digest)."""
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, url, html in rows:
        payload = (html or "").encode()
        original = first.get(html or "") if len(payload) >= least else None
        original = None if original == i else original
        out.append((i, url or None, "revisit" if original is not None else "response", original, len(payload), hashlib.sha256(payload).hexdigest()))
    return out


def found(df):
    return [(r.page_id and int(r.page_id), r.url, r.record_type, r.refers_to and int(r.refers_to), r.payload_bytes, r.payload_digest) for r in df.collect()]


def test_round_trip(spark, pages, tmp_path):
    index = warc.write_archives(pages, f"file://{tmp_path}/a", date=datetime(2024, 1, 2))
    assert Counter(found(index.withColumn("url", warc.F.expr("nullif(url, '')")))) == Counter(records(PAGES))
    back = warc.read_records(index)
    assert Counter(found(back)) == Counter(records(PAGES))
    payloads = Counter(bytes(r.payload).decode() for r in back.collect() if r.record_type == "response")
    wanted = Counter((p[2] or "") for p, r in zip(PAGES, records(PAGES)) if r[2] == "response")
    assert payloads == wanted
    assert {r.payload for r in back.collect() if r.record_type == "revisit"} == {None}
    assert {r.payload for r in warc.read_records(index, payloads=False).collect()} == {None}


def test_archives_are_gzipped_records_and_index_points_at_them(spark, pages, tmp_path):
    index = warc.write_archives(pages, str(tmp_path / "a"), date=datetime(2024, 1, 2)).collect()
    files = sorted((tmp_path / "a").glob("*.warc.gz"))
    assert {r.file for r in index} == {str(f) for f in files}
    for f in files:
        text, places = gzip.decompress(f.read_bytes()), sorted((r.offset, r.length) for r in index if r.file == str(f))
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.endswith(b"\r\n\r\n")
        assert places[0][0] > 0 and places[-1][0] + places[-1][1] == f.stat().st_size
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    row = next(r for r in index if r.record_type == "revisit" and r.page_id == "3")
    data = Path(row.file).read_bytes()[row.offset : row.offset + row.length]
    head = gzip.decompress(data).decode().split("\r\n")
    assert {"WARC-Type: revisit", "WARC-Date: 2024-01-02T00:00:00Z", "WARC-Target-URI: http://a/1", "Refers-To-Page-ID: 1", "Content-Length: 100"} <= set(head)
    original = next(r for r in index if r.page_id == "1" and r.record_type == "response")
    answer = gzip.decompress(Path(original.file).read_bytes()[original.offset : original.offset + original.length]).decode()
    refers = next(x for x in head if x.startswith("WARC-Refers-To:")).split(": ")[1]
    assert f"WARC-Record-ID: {refers}\r\n" in answer


def test_chosen_records_in_few_requests(spark, pages, tmp_path, monkeypatch):
    index = warc.write_archives(pages.coalesce(1), str(tmp_path / "a"))
    chosen = index.where("page_id in ('8', '10') or page_id is null")
    wanted = Counter(r for r in records(PAGES) if r[0] in (8, 10, None))
    for gap, span in ((0, 1), (50, 1000), (1 << 20, 1 << 20)):
        assert Counter(found(warc.read_records(chosen, gap=gap, span=span))) == wanted
    twice = warc.read_records(chosen.unionByName(chosen))
    assert Counter(found(twice)) == wanted + wanted
    whole = warc.read_records(warc.resolved(index.where("page_id in ('3', '9')"), index)).collect()
    assert sorted(bytes(r.payload).decode() for r in whole) == sorted([BIG, MANY])


def test_coalescing():
    places = [(0, 10), (10, 5), (20, 5), (40, 5), (45, 100), (145, 5), (150, 5)]
    assert list(warc.coalesced(places, gap=5, span=30)) == [places[:3], [places[3]], [places[4]], places[5:]]
    assert list(warc.coalesced([], 1, 1)) == []
    assert list(warc.coalesced([(0, 5), (0, 5)], 0, 5)) == [[(0, 5), (0, 5)]]


def test_index_of_archives_without_one(spark, pages, tmp_path, monkeypatch):
    index = warc.write_archives(pages, str(tmp_path / "a"))
    files = [r.file for r in index.select("file").distinct().collect()]
    again = warc.index_archives(spark, files)
    columns = [c for c in index.columns if c != "url"]
    assert sorted(map(str, again.select(columns).collect())) == sorted(map(str, index.select(columns).collect()))
    assert sorted(map(str, again.select("url").collect())) == sorted(str(r) for r in index.selectExpr("nullif(url, '') as url").collect())
    for step in (1, 50):  # members that end within and at the ends of what is read at once
        rows = [r for b in warc._scanned(files[0], step) for r in b.to_pylist()]
        assert len(rows) == index.where(index.file == files[0]).count()
    assert warc.index_archives(spark, []).collect() == []


def test_damage_is_an_error(spark, pages, tmp_path):
    index = warc.write_archives(pages, str(tmp_path / "a"))
    row = index.where("page_id = '8'").first()
    place = Path(row.file)
    data = bytearray(place.read_bytes())
    content = gzip.decompress(bytes(data[row.offset : row.offset + row.length])).replace(b"wort", b"word", 1)
    with pytest.raises(ValueError, match="damaged"):
        warc._described(warc.parse_record(content))
    with pytest.raises(ValueError):
        warc.parse_record(content[:-9])
    place.write_bytes(data[:-9])
    with pytest.raises(ValueError, match="cut off"):
        list(warc._scanned(row.file))


def test_archives_roll_over(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    index = warc.write_archives(pages, str(tmp_path / "a"))
    assert index.select("file").distinct().count() == len(PAGES)
    assert Counter(found(warc.read_records(index))) == Counter(records(PAGES))


def test_empty_table(spark, pages, tmp_path):
    index = warc.write_archives(pages.where("false"), str(tmp_path / "a"))
    assert index.collect() == [] and warc.read_records(index).collect() == []


def test_given_pages_equal_sql(spark, tmp_path):
    found = spark_result(queries.op13_warc(spark, SF))
    assert difference(found, duck_result(connect(SF), oracles.ORACLES["op13_warc"])) is None
    copies = spark.read.parquet(f"{SF}/pages.parquet")
    copies = copies.unionByName(copies.withColumn("page_id", warc.F.col("page_id") + 1_000_000))
    copies.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    found = spark_result(queries.op13_warc(spark, str(tmp_path)))
    con = connect(SF)
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert difference(found, duck_result(con, oracles.ORACLES["op13_warc"])) is None
