import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import pytest

from payx.llm import queries, repair

SOUND = re.compile(r"(s?(ua)+)?\Z")


def brute_edits(rows):
    """[(role, text, doomed, cut)] -> (cost, audit, lines) by trying all edits; few rows only."""
    best = None

    def step(i, initials, cost, audit, lines):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows) and SOUND.match(initials):
            best = min(x for x in (best, (cost, audit, lines)) if x)
        if audit[-2:] != "II" and (initials == "" or initials[-1] in "sua"):
            for name in ("user", "assistant"):
                if re.match(r"s?(ua)*u?\Z", initials + name[0]):
                    step(i, initials + name[0], cost + 2, audit + "I", (*lines, name + ":"))
        if i == len(rows):
            return
        role, text, doomed, cut = rows[i]
        step(i + 1, initials, cost + 3, audit + "D", lines)
        if not doomed:
            for e, name, c in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                if re.match(r"s?(ua)*u?\Z", initials + (name[:1] or "-")):
                    step(i + 1, initials + name[:1], cost + c + cut, audit + e, (*lines, f"{name}:{text}"))

    step(0, "", 0, "", ())
    return best


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def brute(given, damaged):
    result = {}
    for conv in {r[0] for r in given}:
        rows = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in rows:
            core = text.rstrip(repair.BLANKS)
            faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [r[2][:1] for r in rows]
        cost, audit, lines = brute_edits([(r[2], r[3], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults, strict=True)])
        result[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def got(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def some(n, conversations, seed):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "", "u2", "tool", None, "User"], ["One.", "Two!", "cut", "", " \t", "Three?", None, "Ends. \n", "é."]
    return [(rng.choice([*range(conversations), None]), rng.choice([*range(5), None, -3]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts)) for _ in range(n)]


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(4))
def test_edits_equal_all_edits(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), "x", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(6))]
        kinds = [repair.row_edits(r[:1], d, c)[0] for r, _, d, c in rows]
        states = repair.crossings([*kinds, repair.END], 0, 0)
        out = repair.edits(rows, 0, states[-2]) + [("I", r, t, 2) for r, t in repair.inserted(states[-2], repair.CLOSING[states[-2]])]
        assert (sum(e[3] for e in out), "".join(e[0] for e in out), tuple(f"{e[1]}:{e[2]}" for e in out if e[0] != "D")) == brute_edits(rows)


@pytest.mark.parametrize(("run", "fan"), [(1024, 512), (2, 2), (1, 3)])
def test_digests_equal_brute_force(spark, monkeypatch, run, fan):
    monkeypatch.setattr(repair, "RUN", run)
    given = some(120, 24, 7)
    df = spark.createDataFrame(given, CONV).repartition(3)
    assert got(repair.audited(df, repair.damaged(df), fan)) == brute(given, damage(given))
    assert got(repair.audited(df, fan=fan)) == brute(given, [(c, t, *(" " if x is None else x for x in (r, s))) for c, t, r, s in given])


def test_long_conversation_in_runs_equals_one_run(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"{i}{rng.choice(['.', '', '!'])}" if rng.random() < 0.9 else "") for i in range(3000)]
    df = spark.createDataFrame(rows, CONV)
    whole = [(r, t, not t, t[-1:] not in ".!?") for _, _, r, t in rows]
    kinds = [repair.row_edits(r[:1], d, c)[0] for r, _, d, c in whole]
    states = repair.crossings([*kinds, repair.END], 0, 0)
    out = repair.edits(whole, 0, states[-2])
    audit = "".join(e[0] for e in out) + "I" * repair.CLOSING[states[-2]]
    monkeypatch.setattr(repair, "RUN", 64)
    one = got(repair.audited(df, fan=4))[1]
    assert one[6] == audit and one[5] == audit.count("I") * 2 + sum(e[3] for e in out if e[0] != "I")
    turns = repair.repaired(df, fan=4).orderBy("part", "seq", "number").collect()
    assert "".join(t["edit"] for t in turns) == audit
    kept = [t for t in turns if t["edit"] != "D"]
    assert SOUND.match("".join(t["role"][0] for t in kept))
    assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in kept).encode()).hexdigest() == one[7]


def test_empty_table_and_lost_conversations(spark):
    empty = spark.createDataFrame([], CONV)
    assert got(repair.audited(empty)) == {}
    assert repair.repaired(empty).count() == 0
    given = spark.createDataFrame([(5, 1, "user", "a."), (None, None, None, None)], CONV + "")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(repair.audited(given, empty)) == {5: nothing, None: nothing}


def test_other_columns_and_repeated_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], CONV + ", key string, part string")
    assert got(repair.audited(df))[1][:7] == (0, 0, 1, 0, 1, 3, "KDK")


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf_dir, size):
    sf = os.path.join(os.path.dirname(sf_dir), size)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.sql(queries.oracle_sql()["op13_repair"])
    assert want.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(queries.op13_repair(spark, sf)) == {r[0]: r[1:] for r in want.fetchall()}


def test_sql_on_odd_rows(spark):
    given = some(150, 30, 3)
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", given)
    assert {r[0]: r[1:] for r in con.sql(repair.SQL).fetchall()} == brute(given, damage(given))
