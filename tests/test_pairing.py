"""Pairing against a plain loop, on random logs and on hand-made cases."""

import random

from pyspark.sql import functions as F

from payx.functions import hexes
from payx.operators import decode, pairing
from payx.schema import AUTHORIZATION_CANCELED, AUTHORIZATION_USED, PAYMENT, TOKEN, TRANSFER

LOGS = "address string, topics array<string>, data string, block_number long, transaction_hash string, log_index int"
TX = "hash string, block_number long, `from` string, `to` string, input string, type int, nonce string, gas_used string, effective_gas_price string, max_fee_per_gas string, max_priority_fee_per_gas string, value string, gas string, l1_fee string"


def address(n):
    return f"0x{n:040x}"


def word(n):
    return f"0x{n:064x}"


def auth(tx, index, payer, nonce=1, event=AUTHORIZATION_USED):
    return (TOKEN, [event, word(payer), word(nonce)], "0x", 100, tx, index)


def move(tx, index, sender, receiver, value, token=TOKEN):
    return (token, [TRANSFER, word(sender), word(receiver)], word(value), 100, tx, index)


def transaction(tx, sender=9, call="0xe3ee160e"):
    return (tx, 100, address(sender), address(77), call, 2, "0x1", "0x5208", "0x3b9aca00", None, None, "0x0", "0xffff", None)


def run(spark, logs, transactions, blocks=((100, "0x65000000", word(1)),)):
    return pairing.assembled(spark.createDataFrame(logs, LOGS), spark.createDataFrame(transactions, TX), spark.createDataFrame(list(blocks), "number long, timestamp string, hash string"))


def outcomes(df):
    return sorted((r["tx_hash"], r["log_index"], r["outcome"], int(r["amount_raw"]) if r["outcome"] == "kept" else None) for r in df.collect())


def loop(logs):
    out = []
    for tx in {x[4] for x in logs}:
        mine = sorted((x for x in logs if x[4] == tx), key=lambda x: x[5])
        used = set()
        for a in mine:
            if a[1][0] != AUTHORIZATION_USED:
                continue
            first = next((t for t in mine if t[1][0] == TRANSFER and t[0] == TOKEN and t[5] > a[5] and t[5] not in used), None)
            if first and first[1][1] == a[1][1]:
                used.add(first[5])
                out.append((tx, a[5], "kept", int(first[2], 16)))
            else:
                out.append((tx, a[5], "dropped", None))
    return sorted(out)


def test_random_logs(spark):
    rng = random.Random(3)
    logs = []
    for t in range(120):
        for i in range(rng.randint(1, 9)):
            tx = word(t)
            logs.append(auth(tx, i, rng.randint(1, 2), i) if rng.random() < 0.5 else move(tx, i, rng.randint(1, 2), 5, rng.randint(1, 99), TOKEN if rng.random() < 0.9 else address(3)))
    got = outcomes(run(spark, logs, [transaction(word(t)) for t in range(120)]))
    assert got == loop(logs)


def test_shared_payer_takes_a_transfer_once(spark):
    logs = [auth(word(1), 0, 1), auth(word(1), 1, 1, 2), move(word(1), 2, 1, 5, 7)]
    assert outcomes(run(spark, logs, [transaction(word(1))])) == [(word(1), 0, "kept", 7), (word(1), 1, "dropped", None)]


def test_dropped_authorization_takes_nothing(spark):
    logs = [auth(word(1), 0, 2), auth(word(1), 1, 1), move(word(1), 2, 1, 5, 7)]
    assert outcomes(run(spark, logs, [transaction(word(1))])) == [(word(1), 0, "dropped", None), (word(1), 1, "kept", 7)]


def test_missing_parts(spark):
    logs = [auth(word(1), 0, 1), move(word(1), 1, 1, 5, 7), auth(word(2), 0, 1), move(word(2), 1, 1, 5, 7), auth(word(3), 0, 1), move(word(3), 1, 1, 5, 7)]
    df = run(spark, logs, [transaction(word(1), call="0x12"), transaction(word(3))], blocks=[(99, "0x1", word(1))])
    assert outcomes(df) == [(word(1), 0, "denied", None), (word(2), 0, "dropped", None), (word(3), 0, "dropped", None)]
    stats = pairing.assembly_stats(df)
    assert tuple(stats.first()) == (3, 1, 0, 2)
    assert pairing.all_lost(stats).count() == 1


def test_payment_columns(spark):
    call = "0xef55bec6" + word(0)[2:] * 3 + word(5)[2:] + word(2**200)[2:] + word(0)[2:]
    row = pairing.payments(run(spark, [auth(word(1), 0, 1, 15), move(word(1), 1, 1, 9, 1_000_000)], [transaction(word(1), call=call)])).first()
    assert (row["payer"], row["payee"], str(row["amount_usdc"]), row["settlement_kind"], row["self_settled"]) == (address(1), address(9), "1.000000", "receive", True)
    assert row["valid_after"].timestamp() == 5 and row["valid_before"] is None
    assert row["gas_cost_wei"] == 21000 * 10**9 and row["l1_fee"] is None and row["auth_nonce"] == word(15)[2:]


def test_payments_have_the_stored_schema_and_order(spark):
    logs = [x for t in range(30) for x in (auth(word(t), 2 * t, 1, t), move(word(t), 2 * t + 1, 1, 5, 7))]
    paid = pairing.payments(run(spark, logs, [transaction(word(t)) for t in range(30)]))
    want = spark.createDataFrame([], PAYMENT).schema
    assert [(f.name, f.dataType) for f in paid.schema] == [(f.name, f.dataType) for f in want]
    places = [(r["p"], r["block_number"], r["log_index"]) for r in pairing.ordered(paid).withColumn("p", F.spark_partition_id()).collect()]
    assert places == sorted(places) and [x[1:] for x in places] == sorted(x[1:] for x in places) and len(places) == 30


def test_probe_counts_all_logs(spark):
    logs = [auth(word(1), 0, 1), move(word(1), 1, 1, 5, 7), auth(word(2), 0, 1), auth(word(3), 0, 1)]
    df = pairing.probe_report(spark.createDataFrame(logs, LOGS), spark.createDataFrame([transaction(word(1)), transaction(word(2), call="0x12")], TX), spark.createDataFrame([(100, "0x1", word(1))], "number long, timestamp string, hash string"))
    assert tuple(df.first()) == (4, 3, 2, 1, 1, 0.333333, 100)


def test_cancellations_need_their_transaction_and_block(spark):
    logs = spark.createDataFrame([auth(word(1), 0, 1, event=AUTHORIZATION_CANCELED), auth(word(2), 0, 1, event=AUTHORIZATION_CANCELED)], LOGS)
    tx = spark.createDataFrame([transaction(word(1))], TX)
    blocks = spark.createDataFrame([(100, "0x65000000", word(1))], "number long, timestamp string, hash string")
    assert [(r["authorizer"], r["transaction_from"]) for r in pairing.cancellations(logs, tx, blocks).collect()] == [(address(1), address(9))]


def test_logs_and_calls_are_read_once(spark, tmp_path):
    """Neither pairing nor what is quarantined reads or shuffles logs again."""
    logs = [x for t in range(9) for x in (auth(word(t), 0, t % 3), move(word(t), 1, 1, 5, 7))]
    tables = {}
    for name, rows, schema in (("logs", logs, LOGS), ("transactions", [transaction(word(t)) for t in range(9)], TX), ("blocks", [(100, "0x65000000", word(1))], "number long, timestamp string, hash string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [address")
    done = pairing.assembled(*tables.values())
    assert scans(done) == 1 and sorted(r["outcome"] for r in done.collect()) == ["dropped"] * 6 + ["kept"] * 3
    assert scans(decode.quarantined(*tables.values())) == 1
    shuffled = [line for line in pairing.assembly_stats(done)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in line]
    assert len(shuffled) == 1 and "input" not in shuffled[0]


def test_logs_without_a_name_stay_apart(spark):
    logs = [auth(None, i, 1, i) for i in range(40)] + [move(None, 41, 1, 5, 7), auth(word(1), 0, 1), move(word(1), 1, 1, 5, 7)]
    frames = [spark.createDataFrame(logs, LOGS), spark.createDataFrame([transaction(word(1)), transaction(None)], TX), spark.createDataFrame([(100, "0x65000000", word(1))], "number long, timestamp string, hash string")]
    assert pairing.by_transaction(frames[0]).select(F.max(F.size("a"))).first()[0] == 1
    out = pairing.assembled(*frames)
    assert sorted((r["outcome"], r["tx_hash"] is None) for r in out.collect()) == [("dropped", True)] * 40 + [("kept", False)]
    out = pairing.assembled(*frames, decode.quarantined(*frames))
    assert {(r["outcome"], r["reason"]) for r in out.collect()} == {("quarantined", "log: no transaction_hash"), ("kept", None)}


def test_many_pairs_of_one_transaction(spark):
    logs = [x for i in range(300) for x in (auth(word(1), i, 1 + i % 2, i), move(word(1), 300 + i, 1 + i % 2, 5, i + 1))]
    assert outcomes(run(spark, logs, [transaction(word(1))])) == loop(logs)


def test_addresses_of_topics(spark):
    good = word(0xABCDEF)
    df = spark.createDataFrame([(t,) for t in (good, good.upper().replace("0X", "0x"), good[:-1], good + "0", "0x" + "g" * 64, good[2:] + "00", None)], "t string")
    assert [r[0] for r in df.select(hexes.topic_address(F.col("t"))).collect()] == [address(0xABCDEF)] * 2 + [None] * 5
