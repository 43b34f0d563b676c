import base64
import gzip
import hashlib
import random

import duckdb
import pyarrow as pa

from payx.llm import queries, warc


def expected(pages, smallest=0):
    """{page_id: (bytes, digest, type, refers_to)} of [(page_id, html)] with distinct ids."""
    first = {}
    for i, html in pages:
        body = (html or "").encode()
        if len(body) >= smallest:
            first[body] = max(i, first.get(body, i))
    out = {}
    for i, html in pages:
        body = (html or "").encode()
        other = first.get(body, i)
        out[i] = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if other == i else "revisit", None if other == i else other)
    return out


def got(df):
    return {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()}


ODD = [(1, None), (2, ""), (3, "a\r\n\r\nWARC/1.1\r\n\r\nb"), (4, "a\r\n\r\nWARC/1.1\r\n\r\nb"), (5, "é漢🙂\x00"), (6, "x" * 300_000), (7, "x" * 300_000), (8, "\r\n\r\n"), (9, "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc")]


def frame(spark, rows):
    return spark.createDataFrame([(i, f"http://example.org/{i} \r\nX: y", h, "clash", "clash") for i, h in rows], "page_id long, url string, html string, payload_digest string, body string")


def test_odd_payloads(spark):
    df = warc.page_captures(frame(spark, ODD))
    assert got(df) == expected(ODD)
    assert all(r["has_request"] and r["has_metadata"] for r in df.collect())


def test_payloads_survive_the_archive(spark):
    path = warc.write(frame(spark, ODD))
    records = warc.read(spark, path)
    found = {bytes(r["payload"]) for r in records.where("record_type = 'response'").collect()}
    assert found == {(h or "").encode() for _, h in ODD}
    assert records.where("not digest_ok").count() == 0
    assert records.groupBy("record_type").count().where("record_type in ('request', 'metadata')").agg({"count": "min"}).first()[0] == len(ODD)


def test_each_record_is_a_member_and_files_are_bounded_in_bytes(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000 if i % 50 == 0 else 40))) for i in range(300)]
    schema = ["request", "response", "metadata"]
    batch = pa.RecordBatch.from_arrays([pa.array([b"q"] * 300), pa.array([h.encode() for _, h in rows]), pa.array([b"m"] * 300)], schema)
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    runs = [x.as_py() for b in warc._files(iter([batch])) for x in b.column(0)]
    assert len(runs) > 3 and max(map(len, runs)) < 50_000 + 60_000
    nothing = warc.NOTHING.encode("latin-1")
    assert [x for r in runs for x in warc.unzipped(r + nothing) if x] == [x for _, h in rows for x in (b"q", h.encode(), b"m")]
    path = warc.write(frame(spark, ODD).repartition(1))
    (content,) = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    records = [x for x in warc.unzipped(content) if x]
    assert len(records) == 3 * len(ODD) and all(x.startswith(b"WARC/1.1\r\n") and x.endswith(b"\r\n\r\n") for x in records)
    assert gzip.decompress(content) == b"".join(records)


def test_smaller_payloads_are_responses(spark):
    rows = [(1, "ab"), (2, "ab"), (3, "abcdef"), (4, "abcdef")]
    path = warc.write(frame(spark, rows), smallest=3)
    assert sorted(r["record_type"] for r in warc.read(spark, path).collect() if r["record_type"] in ("response", "revisit")) == ["response", "response", "response", "revisit"]


def test_one_payload_in_most_rows(spark):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(400)]
    assert got(warc.page_captures(frame(spark, rows))) == expected(rows)


def test_repeated_rows_missing_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, None, "b")], "page_id long, url string, html string")
    assert {(r["page_id"], r["record_type"]) for r in warc.page_captures(df).collect()} == {(1, "response"), (None, "response")}
    assert warc.page_captures(df.limit(0)).count() == 0


def test_one_row_for_each_row(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (1, "v", "a"), (2, "u", "a"), (2, "u", "a"), (0, "u", "a"), (None, "u", "a"), (None, "u", None), (None, "v", None), (None, "v", ""), (3, "u", "b"), (3, "u", "b"), (4, "u", "c"), *[(None, "u", "many")] * 100]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).persist()
    con = duckdb.connect()
    con.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = con.sql(queries.OP2_SQL)
    at = [want.columns.index(c) for c in ("page_id", "payload_bytes", "payload_digest", "refers_to", "has_request", "has_metadata")]
    key = lambda rows: sorted(str(tuple(rows)) for rows in rows)
    got = warc.page_captures(df).collect()
    assert key([r[i] for i in at] for r in want.fetchall()) == key([r[want.columns[i]] for i in at] for r in got)
    assert len(warc.read(spark, warc.write(df)).select("record_id").distinct().collect()) == 3 * len(rows)
    small = warc.write(df, smallest=100)
    assert warc.read(spark, small).select("record_id").distinct().count() == 3 * len(rows)


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    rows = con.sql(queries.OP2_SQL).fetchall()
    df = queries.op2_warc(spark, sf_dir)
    columns = con.sql(queries.OP2_SQL).columns
    assert sorted(map(str, rows)) == sorted(str(tuple(r[c] for c in columns)) for r in df.collect())


def test_assembly_of_foreign_archives(spark):
    rows = [
        ("r1", "response", [], None), ("q1", "request", ["r1"], None), ("m1", "metadata", ["q1"], None),
        ("r2", "response", ["q2"], None), ("q2", "request", [], None), ("m2", "metadata", ["r2"], None), ("m3", "metadata", ["r2"], None),
        ("q9", "request", ["gone"], None), ("w", "warcinfo", [], None), ("c1", "metadata", ["r1"], None), *[(f"c{i}", "metadata", [f"c{i - 1}"], None) for i in range(2, 6)],
    ]
    full = [(i, t, c, None, None, 1, "d", True, {}, None) for i, t, c, _ in rows]
    records = spark.createDataFrame(full, warc.RECORDS)
    by = {r["capture_id"]: r for r in warc.assemble(records).collect()}
    assert by["r1"]["request"]["record_id"] == "q1" and by["r1"]["metadata"]["record_id"] == "c1" and by["r1"]["n_metadata"] == 6
    assert by["r2"]["request"]["record_id"] == "q2" and by["r2"]["metadata"]["record_id"] == "m2" and by["r2"]["n_metadata"] == 2
    assert by["q9"]["response"] is None and "w" in by and len(by) == 4
    assert warc.members(records).count() == len(rows)
