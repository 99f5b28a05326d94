import hashlib
import io

import duckdb

from rivalry.llm import warc
from rivalry.llm.store import filesystem

LONG = "<p>é" + "x" * 200


def test_query_equals_sql(spark, small_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{small_dir}/pages.parquet')")
    want = con.execute(warc.ORACLE)
    names = [d[0] for d in want.description]
    got = warc.op3_warc(spark, small_dir)
    assert sorted(got.columns) == sorted(names)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_odd_pages_and_payloads(spark):
    rows = [(5, "http://a/é x", LONG, 1), (3, "http://a/2\r\nX: y", LONG, 1), (9, None, LONG, 1), (None, "u", LONG, 1),
            (3, "again", LONG, 1), (1, "short", "<p>", 1), (2, "short", "<p>", 1), (7, "n", None, 1), (8, "", "", 1),
            (10, "z", "\x00\r\n\r\nWARC/1.1\r\n" * 20, 1), (None, "only null", LONG + "n", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_id int")
    found = warc.captures(warc.records(spark, warc.write(pages)))
    out = {(r.page_id, r.url): r for r in warc.resolve(found).collect()}
    assert len(out) == len(rows)
    for page_id, url, html, _ in rows:
        r, body = out[(page_id, url)], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        copy = html == LONG and page_id != 3
        assert (r.record_type, r.refers_to) == (("revisit", 3) if copy else ("response", None))
    nested = found.collect()
    assert all(r.request is not None and r.metadata is not None for r in nested)
    held = {r.payload for r in nested if r.response.warc_type == "response"}
    assert held == {(html or "").encode() for _, _, html, _ in rows}


def test_archives_are_plain_gzip_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", LONG)], "page_id long, url string, html string")
    (name,) = warc.write(pages)
    fs, path = filesystem(name)
    with fs.open_input_stream(path, compression=None) as f:
        got = list(warc.stream_records(io.BytesIO(f.read())))
    assert [h["warc-type"] for h, _ in got] == ["warcinfo", "response", "request", "metadata"]
    assert got[2][0]["warc-concurrent-to"] == got[3][0]["warc-concurrent-to"] == got[1][0]["warc-record-id"]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.resolve(warc.captures(warc.records(spark, warc.write(pages)))).collect() == []
