import hashlib

from hyetos.llm import warc
from hyetos.session import work_dir

BIG = "x\r\n\r\nWARC/1.1\r\n" + "é" * 600


def round_trip(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    path = work_dir(spark, "warc")
    warc.write(warc.resolve(pages), path, per_file=2)
    read = warc.read(spark, path)
    return {(r.page_id, r.url): r for r in warc.with_originals(read).collect()}


def test_revisits_refer_to_the_largest_page(spark):
    rows = [(i, f"http://a/{i}", BIG, "clash") for i in (1, 5, 3)]
    rows += [(7, "http://b\r\n/7", "small", None), (8, None, "small", None), (9, "u", None, None)]
    found = round_trip(spark, rows)
    assert len(found) == 6
    digest = hashlib.sha1(BIG.encode()).hexdigest()
    for page, kind, origin in ((1, "revisit", 5), (3, "revisit", 5), (5, "response", None)):
        row = found[page, f"http://a/{page}"]
        assert (row.record_type, row.refers_to) == (kind, origin)
        assert (row.payload_digest, row.payload_bytes) == (digest, len(BIG.encode()))
    assert bytes(found[5, "http://a/5"].payload).decode() == BIG
    assert found[7, "http://b%0A/7"].record_type == found[8, None].record_type == "response"
    assert found[9, "u"].payload_bytes == 0


def test_ties_and_missing_ids(spark):
    rows = [(2, "u", BIG, None), (2, "u", BIG, None), (None, "n", BIG, None), (None, "m", "t", None)]
    found = round_trip(spark, rows)
    assert found[2, "u"].record_type == "response"
    assert found[None, "n"].refers_to == 2
    only = round_trip(spark, [(None, "a", BIG, None), (None, "b", BIG, None)])
    assert {r.record_type for r in only.values()} == {"response"}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = work_dir(spark, "warc")
    warc.write(warc.resolve(pages), path)
    assert warc.with_originals(warc.read(spark, path)).count() == 0
