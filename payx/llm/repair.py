"""Conversation repair by divide and conquer over four states (Hirschberg's scheme).

A sound conversation is empty, or an optional system turn and then user and assistant in turn, ending with assistant.
Its automaton has four states: at the start, and after system, user, assistant. A row is kept, given another role, or
deleted, and empty turns may be inserted anywhere. The cheapest edits are wanted; of those with equal cost, the ones
whose initials, the audit, come first in ASCII order.

Costs from every state to every state over some rows are a 4 x 4 matrix, and beside each cost stands the rank of its
audit among the sixteen. Audits over the same rows end with the edit of the last row, so none begins another and ranks
of two stretches tell the order of their joined audits. A forward vector from the first state and a backward vector
from the last one meet in the middle; the crossing with least cost, then least audit, parts the rows, and each half is
solved alike. That needs no table of all rows and states.

The same holds over stretches of rows. A conversation is cut into runs of at most `RUN` rows wherever they lie after a
sort by ranges; a run has one matrix, `FAN` runs have one again, and so on up, so that a conversation of any length
meets in small groups only. From the top the crossings go down: first the states between groups, then those between
runs, then those between rows. A text is passed on with its run and never compared with those of other runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payx.llm.common import groups, materialise, salted, small_batches

#: Rows and bytes of text of a run (a longer text is a run of its own), and runs that meet in one group.
RUN, RUN_BYTES, FAN = 1024, 4 << 20, 512
NEVER = 1 << 60
BLANKS = " \t\n\x0b\x0c\r"
#: States: 0 at the start, 1 after system, 2 after user, 3 after assistant. What may follow each, by initial.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Inserted turns that lead from a state to another, at least one where it is the same, and to a sound end.
INSERTS = {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1, (2, 2): 2, (3, 3): 2}
CLOSING = (0, 2, 1, 0)
Matrix = tuple[tuple[int, ...], tuple[int, ...]]  # costs and ranks of the audits, by 4 * from + to


def _ranked(costs: list, keys: list) -> Matrix:
    """Costs with dense ranks of keys; a cell without a way has neither."""
    order = {k: i for i, k in enumerate(sorted({k for c, k in zip(costs, keys, strict=True) if c < NEVER}))}
    return tuple(costs), tuple(order.get(k, 0) if c < NEVER else 0 for c, k in zip(costs, keys, strict=True))


@cache
def row_edits(initial: str, doomed: bool, cut: bool) -> tuple[Matrix, tuple[str, ...]]:
    """The matrix of one row with this initial of its role, and the least audit of each cell.

    A doomed row (blank or seen before) must be deleted; a row cut off costs one more unless deleted.
    """
    costs, audits = [], []
    for p in range(4):
        for q in range(4):
            ways = []
            for via, k in [(p, 0), *[(to, n) for (of, to), n in INSERTS.items() if of == p]]:
                if via == q:
                    ways.append((2 * k + 3, "I" * k + "D"))
                if not doomed:
                    if FOLLOWS[via].get(initial) == q:
                        ways.append((2 * k + cut, "I" * k + "K"))
                    if any(FOLLOWS[via].get(i) == q for i in "ua"):
                        ways.append((2 * k + 2 + cut, "I" * k + "R"))
            cost, audit = min(ways, default=(NEVER, ""))
            costs.append(cost)
            audits.append(audit)
    return _ranked(costs, audits), tuple(audits)


#: The end as one more stretch, to state 0: the turns that are inserted last.
END: Matrix = _ranked([2 * CLOSING[p] if q == 0 else NEVER for p in range(4) for q in range(4)], [CLOSING[p] for p in range(4) for q in range(4)])


@lru_cache(1 << 16)
def join(a: Matrix, b: Matrix) -> Matrix:
    """The matrix of two stretches, one after the other."""
    costs, keys = [], []
    for p in (0, 4, 8, 12):
        for r in range(4):
            c, x, y = min((a[0][p + q] + b[0][4 * q + r], a[1][p + q], b[1][4 * q + r]) for q in range(4))
            costs.append(min(c, NEVER))
            keys.append((x, y))
    return _ranked(costs, keys)


@lru_cache(1 << 16)
def _forward(v: Matrix, m: Matrix) -> Matrix:
    best = [min((v[0][p] + m[0][4 * p + q], v[1][p], m[1][4 * p + q]) for p in range(4)) for q in range(4)]
    return _ranked([min(b[0], NEVER) for b in best], [b[1:] for b in best])


@lru_cache(1 << 16)
def _backward(m: Matrix, v: Matrix) -> Matrix:
    best = [min((m[0][4 * p + q] + v[0][q], m[1][4 * p + q], v[1][q]) for q in range(4)) for p in range(4)]
    return _ranked([min(b[0], NEVER) for b in best], [b[1:] for b in best])


def crossings(stretches: list[Matrix], start: int, end: int) -> list[int]:
    """The states before, between and after the stretches on the cheapest way, of these the least in its audit."""
    states = [start] * len(stretches) + [end]
    todo = [(0, len(stretches))]
    one = lambda s: (tuple(0 if p == s else NEVER for p in range(4)), (0, 0, 0, 0))
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        f, b = one(states[lo]), one(states[hi])
        for m in stretches[lo:mid]:
            f = _forward(f, m)
        for m in reversed(stretches[mid:hi]):
            b = _backward(m, b)
        states[mid] = min(range(4), key=lambda q: (f[0][q] + b[0][q], f[1][q], b[1][q]))
        todo += [(lo, mid), (mid, hi)]
    return states


def inserted(state: int, n: int) -> list[tuple[str, str]]:
    """n turns inserted after a state."""
    out = []
    for _ in range(n):
        out.append(("assistant" if state == 2 else "user", ""))
        state = 3 if state == 2 else 2
    return out


def edits(rows: list[tuple[str, str, bool, bool]], start: int, end: int) -> list[tuple[str, str | None, str | None, int]]:
    """(edit, role, text, cost) in order for (role, text, doomed, cut) rows between two states; deleted rows have neither."""
    kinds = [row_edits(r[:1], doomed, cut) for r, _, doomed, cut in rows]
    states = crossings([m for m, _ in kinds], start, end)
    out = []
    for (role, text, _, cut), (_, audits), p, q in zip(rows, kinds, states[:-1], states[1:], strict=True):
        audit = audits[4 * p + q]
        out += [("I", r, t, 2) for r, t in inserted(p, len(audit) - 1)]
        if audit[-1] == "D":
            out.append(("D", None, None, 3))
        else:
            new = role if audit[-1] == "K" else ("user" if q == 2 else "assistant")
            out.append((audit[-1], new, text, (0 if audit[-1] == "K" else 2) + cut))
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults that crc32 of `conv_id:turn` asks for; nulls count as one space there
    and in role and text."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    x = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("fault"))
    x = x.where("fault <> 0").withColumn("copies", F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return x.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode("copies").alias("copy")).drop("copy")


RUNS = "conv_id long, part int, seq int, first_turn long, last_turn long, turns long, lowest long, blank long, duplicate long, truncated long, illegal long, opening string, closing string, roles array<string>, texts array<string>, faults array<string>, cost array<long>, rank array<long>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one conversation in order, with what must be known of them; the ends of turns tell what they share."""
    part, seq = TaskContext.get().partitionId(), 0
    open_: list[tuple] = []
    size, before = 0, None

    def closed() -> pa.RecordBatch:
        nonlocal seq
        seq += 1
        turns = [r[1] for r in open_ if r[1] is not None]
        initials = [r[2][:1] for r in open_]
        faults = [r[4] for r in open_]
        kinds = [row_edits(r[2][:1], f in ("blank", "duplicate"), f == "truncated")[0] for r, f in zip(open_, faults, strict=True)]
        whole = kinds[0]
        for m in kinds[1:]:
            whole = join(whole, m)
        row = {
            "conv_id": open_[0][0], "part": part, "seq": seq, "first_turn": open_[0][1], "last_turn": open_[-1][1], "turns": len(set(turns)), "lowest": min(turns, default=None), "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "opening": initials[0], "closing": initials[-1], "roles": [r[2] for r in open_], "texts": [r[3] for r in open_], "faults": faults, "cost": whole[0], "rank": whole[1],
        }
        return pa.RecordBatch.from_pylist([row], SCHEMA)

    for batch in batches:
        for conv, turn, role, text, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = (conv, turn, role, text)
            if open_ and (open_[0][0] != conv or len(open_) == RUN or size + len(text) > RUN_BYTES):
                yield closed()
                open_, size = [], 0
            core = text.rstrip(BLANKS)
            fault = "blank" if not core else "duplicate" if seen or row == before else "truncated" if core[-1] not in ".!?" else ""
            open_.append((*row, fault))
            size += len(text)
            before = row
    if open_:
        yield closed()


SCHEMA = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}[t]) for n, t in (x.split(" ") for x in RUNS.split(", "))])


def runs(rows: DataFrame) -> DataFrame:
    """Sorted runs of rows (conv_id, turn, role, text): by turn, nulls first, then role and text, equal rows together.

    Ranges of conversation and turn are dealt to tasks, so a conversation may span many. Whether a row was seen in an
    earlier turn is looked up by a 128-bit key, only for keys that occur twice.
    """
    x = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    key = F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    x = x.withColumn("key", key)
    order = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"))
    again = materialise(x.groupBy("key").agg(F.min(order).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1"), "again")
    x = salted(x, again.drop("n"), "key", "turn", again.select("key", "n"), rows.count(), "left")
    x = x.select("conv_id", "turn", "role", "text", F.coalesce(F.col("earliest") < order, F.lit(False)).alias("seen"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = x.repartitionByRange(n, "conv_id", "turn", F.substring("role", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    return materialise(small_batches(dealt).mapInArrow(_runs, RUNS), "runs")


def _matrices(costs, ranks) -> list[Matrix]:
    return [(tuple(map(int, c)), tuple(map(int, r))) for c, r in zip(costs, ranks, strict=True)]


@F.pandas_udf(T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("cost", "rank")]))
def joined(costs: pd.Series, ranks: pd.Series) -> pd.DataFrame:
    out = []
    for c, r in zip(costs, ranks, strict=True):
        whole, *rest = _matrices(c, r)
        for m in rest:
            whole = join(whole, m)
        out.append((list(whole[0]), list(whole[1])))
    return pd.DataFrame(out, columns=["cost", "rank"])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def met(costs: pd.Series, ranks: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    """States around the members of each group; without an end the conversation ends here."""
    out = []
    for c, r, s, e in zip(costs, ranks, start, end, strict=True):
        m = _matrices(c, r)
        out.append(crossings([*m, END], int(s), 0)[:-1] if e < 0 else crossings(m, int(s), int(e)))
    return pd.Series(out)


def states(runs_: DataFrame, fan: int = FAN) -> DataFrame:
    """(part, seq, start, end, last) of every run; a node is known by its first run."""
    position = F.row_number().over(Window.partitionBy("conv_id").orderBy("part", "seq")) - 1
    levels = [runs_.select("conv_id", "part", "seq", "cost", "rank").withColumn("i", position)]
    member = F.sort_array(F.collect_list(F.struct("part", "seq", "cost", "rank"))).alias("m")
    group = ["conv_id", F.floor(F.col("i") / fan).alias("g")]
    while (levels[-1].agg(F.max("i")).first()[0] or 0) >= fan:
        up = levels[-1].groupBy(*group).agg(member).select("conv_id", F.col("m")[0]["part"].alias("part"), F.col("m")[0]["seq"].alias("seq"), joined("m.cost", "m.rank").alias("x"), F.col("g").alias("i"))
        levels.append(materialise(up.select("conv_id", "part", "seq", "x.cost", "x.rank", "i"), "stretches"))
    known = None
    for level in reversed(levels):
        x = level.groupBy(*group).agg(member).withColumns({"part": F.col("m")[0]["part"], "seq": F.col("m")[0]["seq"]})
        x = x.withColumns({"start": F.lit(0), "end": F.lit(-1), "last": F.lit(True)}) if known is None else x.join(known, ["part", "seq"])
        x = x.withColumn("s", met("m.cost", "m.rank", "start", "end"))
        x = x.select("last", "m", "s", F.posexplode("m").alias("i", "node"))
        x = x.select("node.part", "node.seq", F.col("s")[F.col("i")].alias("start"), F.col("s")[F.col("i") + 1].alias("end"), (F.col("last") & (F.col("i") == F.size("m") - 1)).alias("last"))
        known = materialise(x, "states")
    return known


def _solved(r: dict) -> list[tuple]:
    rows = [(role, text, f in ("blank", "duplicate"), f == "truncated") for role, text, f in zip(r["roles"], r["texts"], r["faults"], strict=True)]
    out = edits(rows, r["start"], r["end"])
    return out + [("I", role, text, 2) for role, text in inserted(r["end"], CLOSING[r["end"]])] if r["last"] else out


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            out = _solved(r)
            if out:
                e, role, text, cost = zip(*out, strict=True)
                k = len(out)
                yield pa.RecordBatch.from_arrays([pa.array([r["conv_id"]] * k, pa.int64()), pa.array([r["part"]] * k, pa.int32()), pa.array([r["seq"]] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array(e), pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(cost, pa.int64())], EDITS.replace(",", "").split()[::2])


EDITS = "conv_id long, part int, seq int, number int, edit string, role string, text string, cost long"


def repaired(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """The edits of every conversation with the turns that they leave, in order of part, seq and number.

    rows: conv_id, turn, role, text; null roles and texts are one space, rows of equal turn go by role and text, rows
    without an id are one conversation, other columns are left out, an empty table gives nothing.
    """
    x = runs(rows)
    return x.join(states(x, fan), ["part", "seq"]).mapInArrow(_each, EDITS)


AUDITED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation from its runs in order; texts pass through the digest run by run."""
    for conv, own in groups(batches):
        n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns", "cost"), 0)
        audit, digest, before, lowest, some = [], hashlib.sha256(), None, None, False
        for r in own:
            for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
                n[k] += r[k]
            if before is not None:
                n["illegal"] += before["closing"] + r["opening"] not in ("su", "ua", "au")
                n["turns"] -= before["last_turn"] is not None and before["last_turn"] == r["first_turn"]
            lowest = r["lowest"] if lowest is None else lowest
            before = {k: r[k] for k in ("closing", "last_turn")}
            for e, role, text, cost in _solved(r):
                audit.append(e)
                n["cost"] += cost
                if e != "D":
                    digest.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
        gaps = 0 if lowest is None else before["last_turn"] - lowest + 1 - n["turns"]
        row = {"conv_id": conv, "gaps": gaps, **{k: n[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")}, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
        yield pa.RecordBatch.from_pylist([row], pa.schema([(c, pa.string() if t == "string" else pa.int64()) for c, t in (x.split(" ") for x in AUDITED.split(", "))]))


def audited(conversations: DataFrame, rows: DataFrame | None = None, fan: int = FAN) -> DataFrame:
    """One row for each conv_id of conversations: its gaps, faults and illegal neighbours, the cost and audit of its
    cheapest repair, and the digest of what that leaves. rows: what is repaired, conversations itself if None.

    Conversations without a row have zeros, no edits and the digest of nothing. All runs of one conversation pass
    through one task for the digest, one after another.
    """
    x = runs(conversations if rows is None else rows)
    columns = [c for c in x.columns if c not in ("cost", "rank", "conv_id")]
    solved = x.select("conv_id", *columns).join(states(x, fan), ["part", "seq"]).select("conv_id", *columns, "start", "end", "last")
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = solved.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_audits, AUDITED)
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    none = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    out = ids.join(done, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("id").alias("conv_id"), *[F.coalesce(F.col(c), none.get(c, F.lit(0).cast("long"))).alias(c) for c in AUDITED.replace(",", "").split()[2::2]])


SQL = r"""
    WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v FROM range(256) r(i))),
    given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    hashed AS (SELECT given.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(t[((xor(c, b) & 255) + 1)::INT], c >> 8))) % 20 AS f FROM given, tab),
    hurt AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM hashed, range(2) r(i) WHERE f <> 0 AND (i = 0 OR f = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM hurt),
    counted AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) AS nth FROM placed),
    r AS (SELECT *, role[1] AS ini, CASE WHEN core = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY rn) AS prev FROM counted),
    faults AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (rn > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
    ins(p, q, k) AS (VALUES (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (0, 3, 2), (1, 2, 1), (1, 3, 2), (2, 3, 1), (3, 2, 1), (2, 2, 2), (3, 3, 2)),
    act(p, q, e, c, i) AS (VALUES (0, 0, 'D', 3, NULL), (1, 1, 'D', 3, NULL), (2, 2, 'D', 3, NULL), (3, 3, 'D', 3, NULL), (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'), (3, 2, 'K', 0, 'u'), (0, 2, 'R', 2, NULL), (1, 2, 'R', 2, NULL), (3, 2, 'R', 2, NULL), (2, 3, 'R', 2, NULL)),
    way AS (SELECT ins.p, act.q, 2 * k + c AS c, repeat('I', k) || e AS a, e, i FROM ins JOIN act ON act.p = ins.q),
    st AS (SELECT conv_id, 0::BIGINT AS rn, 0 AS q, {'c': 0::BIGINT, 'a': ''} AS best FROM faults
      UNION ALL SELECT st.conv_id, st.rn + 1, way.q, min({'c': best.c + way.c + CASE WHEN fault = 'truncated' AND e <> 'D' THEN 1 ELSE 0 END, 'a': best.a || way.a}) FROM st JOIN r ON r.conv_id IS NOT DISTINCT FROM st.conv_id AND r.rn = st.rn + 1 JOIN way ON way.p = st.q
        WHERE (e = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (i IS NULL OR i = ini) GROUP BY st.conv_id, st.rn, way.q),
    fin AS (SELECT st.conv_id, min({'c': best.c + 2 * k, 'a': best.a || repeat('I', k)}) AS best FROM st JOIN faults ON faults.conv_id IS NOT DISTINCT FROM st.conv_id AND st.rn = n JOIN (VALUES (0, 0), (1, 2), (2, 1), (3, 0)) z(p, k) ON p = q GROUP BY st.conv_id),
    chars AS (SELECT conv_id, unnest(range(1, len(best.a) + 1)) AS j, best.a AS a FROM fin),
    marked AS (SELECT conv_id, j, a[j] AS e, len(replace(a[1:j], 'I', '')) AS rn, len(replace(a, 'D', '')) - len(replace(a[1:j], 'D', '')) AS after FROM chars),
    turns AS (SELECT m.conv_id, j, CASE WHEN e = 'K' THEN role WHEN after % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line FROM marked m LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM m.conv_id AND r.rn = m.rn WHERE e <> 'D'),
    texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS body FROM turns GROUP BY conv_id)
    SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN faults ON faults.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
