"""Ingest of landed batches: replays change nothing, the cursor never falls, lost candidates halt."""

import json
import re

import pytest
from pyspark.sql import functions as F

from payx.operators import classify
from payx.operators.cube import daily_cube, velocity, velocity_of, wide_cube
from payx.schema import AUTHORIZATION_USED, PAYMENT, TOKEN, TRANSFER
from payx.sources import batches
from payx.streaming import ingest, minutes
from tests.test_pairing import address, word


def batch(blocks, paired=True):
    logs, txs = [], []
    for b in blocks:
        tx = word(b)
        logs.append({"address": TOKEN, "topic0": AUTHORIZATION_USED, "topic1": word(1), "topic2": word(b), "topic3": "", "data": "0x", "block_number": b, "transaction_hash": tx, "transaction_index": 0, "log_index": 0})
        if paired:
            logs.append({"address": TOKEN, "topic0": TRANSFER, "topic1": word(1), "topic2": word(5), "data": word(1_000_000), "block_number": b, "transaction_hash": tx, "transaction_index": 0, "log_index": 1})
        txs.append({"hash": tx, "block_number": b, "from": address(9), "to": address(7), "input": "0xe3ee160e", "type": 2, "nonce": "0x0", "gas_used": "0x5208", "effective_gas_price": "0x1"})
    return {"data": [{"logs": logs[:2], "transactions": txs[:1], "blocks": [{"number": b, "timestamp": hex(1_700_000_000 + b), "hash": word(b)} for b in blocks]}, {"logs": logs[2:], "transactions": txs[1:], "blocks": []}], "archive_height": 999, "next_block": max(blocks) + 1}


def land(path, name, content):
    (path / name).write_text(json.dumps(content))


def read(spark, path):
    return spark.read.schema(ingest.LANDED).option("multiLine", "true").json(str(path)).withColumn("file", F.col("_metadata.file_name"))


def test_replay_is_a_no_op(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    land(src, "a.json", batch([10, 11]))
    ingest.ingest(spark, str(src), base).awaitTermination()
    assert ingest.stored(spark, base).count() == 2 and ingest.cursor(spark, base) == 11
    land(src, "b.json", batch([11, 12]))
    land(src, "c.json", batch([9]))
    ingest.ingest(spark, str(src), base).awaitTermination()
    got = ingest.stored(spark, base)
    assert sorted(r["block_number"] for r in got.collect()) == [9, 10, 11, 12] and ingest.cursor(spark, base) == 12
    ingest.ingest(spark, str(src), base).awaitTermination()
    assert ingest.stored(spark, base).count() == 4


def test_lost_candidates_halt(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    land(src, "a.json", batch([10], paired=False))
    raw = read(spark, src)
    with pytest.raises(ingest.CandidatesLost):
        ingest.write_batch(raw, 0, base)
    assert ingest.cursor(spark, base) == 0
    ingest.write_batch(raw, 0, base, allow_loss=True)
    assert ingest.cursor(spark, base) == 10


def test_a_stuck_cursor_halts(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    land(src, "a.json", batch([10]) | {"next_block": 10})
    raw = read(spark, src)
    with pytest.raises(ingest.CursorStuck):
        ingest.write_batch(raw, 0, base)
    assert ingest.cursor(spark, base) == 0


def counts(spark, base):
    return {r["name"]: r["n"] for r in ingest.status(spark, base).collect()}


def test_malformed_rows_are_quarantined_and_large_amounts_kept_apart(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    content = batch([10, 11, 12, 13])
    logs = content["data"][0]["logs"] + content["data"][1]["logs"]
    logs[3]["data"] = word(2**200)  # the transfer of block 11
    content["data"][0]["transactions"][0]["to"] = "0x12"
    content["data"][1]["transactions"][2]["gas_used"] = "0xZZ"
    land(src, "a.json", content)
    raw = read(spark, src)
    for i in range(2):  # the second changes nothing
        ingest.write_batch(raw, i, base)
    assert counts(spark, base) == {"cursor": 13, "payments": 1, "oversized": 1, "cancellations": 0, "rejects": 2, "missing_blocks": 0}
    row = ingest.stored(spark, base, "oversized").first()
    assert row["amount_raw"] is None and int(row["value_hex"], 16) == 2**200
    allow = spark.createDataFrame([("base", address(9), 1, None)], "chain string, address string, since_version int, until_version int")
    wide = wide_cube(classify.with_membership(ingest.every_payment(spark, base), allow)).first()
    assert wide["txn_count"] == 2 and wide["volume_usdc"] == f"{(2**200 + 10**6) // 10**6}.{(2**200 + 10**6) % 10**6:06d}"
    assert sorted(map(tuple, ingest.stored(spark, base, "rejects").collect())) == [("transaction", word(10), "bad to"), ("transaction", word(13), "bad gas_used")]
    assert [r["block_number"] for r in ingest.stored(spark, base).collect()] == [12]


@pytest.mark.parametrize(("what", "reason"), [("block", "bad timestamp"), ("log", "bad data"), ("name", "bad hash"), ("none", "no transaction_hash")])
def test_what_is_rejected_takes_its_transaction_along(spark, tmp_path, what, reason):
    content = batch([10, 11])
    if what == "block":
        content["data"][0]["blocks"][0]["timestamp"] = "0x"  + "f" * 17
    elif what == "log":
        content["data"][0]["logs"][1]["data"] = "0x123"
    elif what == "name":
        content["data"][0]["transactions"][0]["hash"] = word(10)[:-1]
        for log in content["data"][0]["logs"]:
            log["transaction_hash"] = word(10)[:-1]
    else:
        for log in content["data"][0]["logs"]:
            log["transaction_hash"] = None
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    land(src, "a.json", content)
    ingest.write_batch(read(spark, src), 0, base)
    assert [r["block_number"] for r in ingest.stored(spark, base).collect()] == [11]
    assert {r["reason"] for r in ingest.stored(spark, base, "rejects").collect()} >= {reason}


def test_a_batch_of_rejects_alone_halts(spark, tmp_path):
    content = batch([10])
    content["data"][0]["transactions"][0]["input"] = "0xz"
    land(tmp_path, "a.json", content)
    with pytest.raises(ingest.CandidatesLost):
        ingest.write_batch(read(spark, tmp_path), 0, str(tmp_path / "out"))


@pytest.mark.parametrize("content", ['{"data": [{"logs": [{"address": "0x83', '{"data": [], "archive_height": 5}'])
def test_a_file_that_is_no_batch_halts_or_leaves_a_hole(spark, tmp_path, content):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    land(src, "a.json", batch([9]))
    ingest.ingest(spark, str(src), base).awaitTermination()
    (src / "b.json").write_text(content)
    land(src, "c.json", batch([12]) | {"from_block": 12})
    with pytest.raises(Exception, match="Malformed"):
        ingest.ingest(spark, str(src), base).awaitTermination()
    assert counts(spark, base) == {"cursor": 9, "payments": 1, "oversized": 0, "cancellations": 0, "rejects": 0, "missing_blocks": 0}
    ingest.ingest(spark, str(src), base, skip_files=True).awaitTermination()
    assert counts(spark, base) == {"cursor": 9, "payments": 2, "oversized": 0, "cancellations": 0, "rejects": 1, "missing_blocks": 2}
    assert ingest.stored(spark, base, "rejects").first()["key"] == "b.json"
    land(src, "d.json", batch([10, 11]))  # what was meant, landed again
    ingest.ingest(spark, str(src), base).awaitTermination()
    assert counts(spark, base)["cursor"] == 12 and counts(spark, base)["missing_blocks"] == 0


STEPS = ["rejects", "payments", "log"]


@pytest.mark.parametrize("step", STEPS)
def test_a_batch_that_breaks_off_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch, step):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    content = batch([10, 11, 12])
    content["data"][0]["transactions"][0]["to"] = "0x12"
    content["data"][0]["logs"][0]["topic0"] = AUTHORIZATION_USED
    land(src, "a.json", content)
    raw = read(spark, src)
    write, append = ingest.commits.write, ingest.commits.append
    nothing = {"cursor": 0, "payments": 0, "oversized": 0, "cancellations": 0, "rejects": 0, "missing_blocks": 0}
    seen = []

    def failing_write(rows, base_, name, commit, partition=None):
        write(rows, base_, name, commit, partition)
        seen.append(counts(spark, base))  # a reader between two writes
        if name == step:
            raise OSError("lost")

    def failing_append(*args):
        if step == "log":
            raise OSError("lost")
        append(*args)

    with monkeypatch.context() as m:
        m.setattr(ingest.commits, "write", failing_write)
        m.setattr(ingest.commits, "append", failing_append)
        with pytest.raises(OSError, match="lost"):
            ingest.write_batch(raw, 0, base)
    assert all(c == nothing for c in [*seen, counts(spark, base)])
    whole = {"cursor": 12, "payments": 2, "oversized": 0, "cancellations": 0, "rejects": 1, "missing_blocks": 0}
    for i in (0, 1):  # read again, and replayed
        ingest.write_batch(raw, i, base)
    assert counts(spark, base) == whole


def test_the_cursor_waits_at_a_hole(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    land(src, "a.json", batch([10, 11]) | {"from_block": 5})
    ingest.ingest(spark, str(src), base).awaitTermination()
    assert ingest.cursor(spark, base) == 11
    for name, blocks in (("z.json", [20, 21]), ("y.json", [15]), ("x.json", [21, 22])):  # shuffled and overlapping
        land(src, name, batch(blocks))
    ingest.ingest(spark, str(src), base, files=2).awaitTermination()
    assert ingest.cursor(spark, base) == 11
    assert [tuple(r) for r in ingest.commits.holes(spark, base).collect()] == [(12, 15), (16, 20)]
    land(src, "b.json", batch([13, 14]) | {"from_block": 12})
    ingest.ingest(spark, str(src), base).awaitTermination()
    assert ingest.cursor(spark, base) == 15
    land(src, "c.json", {"data": [{"logs": [], "transactions": [], "blocks": []}], "archive_height": 999, "from_block": 16, "next_block": 20})
    ingest.ingest(spark, str(src), base).awaitTermination()
    assert ingest.cursor(spark, base) == 22
    land(src, "d.json", batch([2]))  # older than the start: covered, but not where the cursor is
    ingest.ingest(spark, str(src), base).awaitTermination()
    assert ingest.cursor(spark, base) == 22 and ingest.stored(spark, base).count() == 9


def test_islands(spark):
    import random

    rng = random.Random(3)
    for _ in range(5):
        ranges = [(a, a + rng.randrange(5)) for a in (rng.randrange(40) for _ in range(12))] + [(None, 3), (7, None)]
        have = sorted({b for a, z in ranges if a is not None and z is not None for b in range(a, z)})
        want = [b for b in have if b - 1 not in have], [b + 1 for b in have if b + 1 not in have]
        got = sorted(map(tuple, ingest.commits.islands(spark.createDataFrame(ranges, "from_block long, to_block long").repartition(3)).collect()))
        assert got == list(zip(*want, strict=True))


def test_the_log_grows_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest.commits, "LINES", 2)
    monkeypatch.setattr(ingest.commits, "NAMED", 3)
    for i in range(5):
        (tmp_path / str(i)).mkdir()
        land(tmp_path / str(i), "a.json", batch([10 + i]))
        ingest.write_batch(read(spark, tmp_path / str(i)), i, str(tmp_path / "out"))
    assert counts(spark, str(tmp_path / "out"))["payments"] == 5 and ingest.cursor(spark, str(tmp_path / "out")) == 14
    assert len(list((tmp_path / "out" / "commits").glob("part=*"))) == 3


def test_stored_files_are_in_block_order(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    content = batch(range(1000, 1100))
    names = {word(b): word((b * 7919) % 10007 << 40) for b in range(1000, 1100)}  # in no order
    for chunk in content["data"]:
        for log in chunk["logs"]:
            log["transaction_hash"] = names[log["transaction_hash"]]
        for tx in chunk["transactions"]:
            tx["hash"] = names[tx["hash"]]
        for block in chunk["blocks"]:
            block["timestamp"] = hex(1_700_000_000 + block["number"] % 2 * 86_400)
    land(src, "a.json", content)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest.ingest(spark, str(src), base).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    days = sorted(glob.glob(f"{base}/payments/commit=*/day=*"))
    files = [sorted(glob.glob(f"{d}/*.parquet")) for d in days]
    assert len(days) == 2 and max(map(len, files)) > 1
    for day in files:
        blocks = [b for f in day for b in pq.read_table(f, columns=["block_number"]).column(0).to_pylist()]
        assert len(blocks) == 50 and blocks == sorted(blocks)


def test_the_cube_follows_the_ingest(spark, tmp_path):
    src, base, cube = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cube")
    src.mkdir()
    allow = spark.createDataFrame([("base", address(9), 1, None)], "chain string, address string, since_version int, until_version int")
    for name, blocks in (("a.json", [10, 11]), ("b.json", [12])):
        land(src, name, batch(blocks))
        ingest.ingest(spark, str(src), base, cube=cube, allowlist=allow).awaitTermination()
    got = spark.read.parquet(cube).groupBy("membership").sum("txn_count").collect()
    assert [tuple(r) for r in got] == [("known", 3)]


def test_stored_payments_are_read_by_day(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    land(src, "a.json", batch([10, 100_010, 200_010]))
    ingest.ingest(spark, str(src), base).awaitTermination()
    every = ingest.stored(spark, base)
    days = sorted({str(r["day"]) for r in every.select("day").collect()})
    some = every.where(f"day = '{days[1]}'")
    assert len(days) == 3 and some.count() == 1
    filters = re.search(r"PartitionFilters: \[[^\]]*\]", some._jdf.queryExecution().toString()).group()
    assert "(day" in filters and "commit" in filters
    stored = {f.name: f.dataType for f in every.schema}
    assert stored == {f.name: f.dataType for f in spark.createDataFrame([], PAYMENT).schema}


def test_cursor_gaps(spark, tmp_path):
    ok, bad = batch([10]), batch([10]) | {"next_block": 10}
    land(tmp_path, "a.json", ok)
    land(tmp_path, "b.json", bad)
    raw = read(spark, tmp_path)
    assert [tuple(r) for r in ingest.cursor_gaps(raw).collect()] == [(10, 10)]


def test_refresh_touches_changed_days_only(spark, tmp_path, sf_dir):
    from payx.catalog import Inputs

    p = Inputs(spark, sf_dir).p.where("day < '1995-03-01'").persist()
    path = str(tmp_path / "cube")
    daily_cube(p).write.partitionBy("day").parquet(path)
    before = spark.read.parquet(path).count()
    ingest.refresh_days(p, p.where("day = '1995-01-20'"), path)
    assert spark.read.parquet(path).count() == before


def test_minutes_take_late_and_repeated_payments_once(spark, tmp_path):
    import datetime

    start = datetime.datetime(2024, 1, 1, 12)
    row = lambda i, seconds, known=True: ("base", f"0x{i}", 0, start + datetime.timedelta(seconds=seconds), (start + datetime.timedelta(seconds=seconds)).date(), known)
    files = [
        [row(1, 5), row(2, 50), row(3, 61, False), row(1, 5)],
        [row(4, 300), row(2, 50), row(5, 20)],  # one again, one late
        [row(6, 3000), row(4, 300), row(7, 290)],  # closes the first minutes
        [row(8, 30), row(9, 2990), row(6, 3000)],  # one too late
        [row(10, 86_500)],
    ]
    like = "chain string, tx_hash string, log_index int, block_timestamp timestamp, day date, facilitator_known boolean"
    src, path = str(tmp_path / "in"), str(tmp_path / "minutes")
    dropped = 0
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, like).coalesce(1).write.mode("append").parquet(src)
        query = minutes.follow(spark.readStream.schema(like).parquet(src), path, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        dropped += minutes.late_rows(query)
    every = spark.createDataFrame([r for rows in files for r in rows], like).dropDuplicates(minutes.KEY).persist()
    on_time = every.where("tx_hash <> '0x8'")
    velocity_rows = lambda df: sorted(map(tuple, df.collect()))
    assert velocity_rows(velocity_of(minutes.read(spark, path))) == velocity_rows(velocity(on_time))
    assert dropped >= 1
    minutes.again(every, spark.createDataFrame([(start.date(),)], "day date"), path)
    assert velocity_rows(velocity_of(minutes.read(spark, path))) == velocity_rows(velocity(every))
