"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its distinct word shingles. Its sketch is the k smallest of them. For two
sets of similarity J, each of the smallest values of their union lies in both with probability J. Two tests follow,
each of which overlooks a single true link with a probability of at most `MISS`:

* Of the k smallest values of the union at least c are in both sketches (a binomial tail). Retained values are put in
  one order, the rarest first. If two sketches share c values, the first of these is among the first k - c + 1 of
  either, so inverted lists hold only that many of each sketch: values that many documents share, as those of a
  passage they have in common, are in no list unless nearly all of a sketch consists of such.
* The union sketch of a candidate pair, all values up to the smaller of the two sketches' largest, must have at least
  the share that such a tail allows. Sizes must be compatible, which is exact.

What is left is confirmed on full sets.

Equal sets are one class, found by a 128-bit sum over the set before any list is built, so groups of exact copies
never meet in a list. Lists link every member first to the list's smallest and largest member, then those outside the
list's largest component to a member of it; only members that are still in different components are compared further.
Short lists compare by a join. Long lists are dealt out by size, in bands whose next but one is too large to be alike,
and in blocks within; each pair of blocks is one small group. It compares sketches, a pair in the first list that both
are in, and full sets only of members that have a likely partner in the group.

Joins on a value, a set's key or the centre of many pairs are dealt by a salt too wherever one key has many rows
(`salted`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payx.llm.common import binomial_floor, materialise, salted, small_batches
from payx.llm.kernels import U, mix, shingle_sets, utf8_batches

MISS = 1e-9
SHORT_LIST = 24
#: A block holds about so many documents and shingles (a single larger document is a block).
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 1 << 18
#: So many edges of 16 bytes may be joined by one task.
FEW_EDGES = 1 << 20


def _sketcher(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, off in utf8_batches(batch.column(1)):
                row, value = shingle_sets(data, off, width)
                n = len(off) - 1
                size = np.bincount(row, minlength=n)
                begin = np.concatenate([[0], np.cumsum(size)])
                keys = []
                for salt in (0x1B873593, 0xCC9E2D51):
                    run_sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value.view(np.uint64) + U(salt)), dtype=np.uint64)])
                    keys.append((run_sum[begin[1:]] - run_sum[begin[:-1]]).view(np.int64))
                keep = np.arange(len(value)) - begin[row] < k
                ends = np.concatenate([[0], np.cumsum(np.minimum(size, k))]).astype(np.int32)
                sketch = pa.ListArray.from_arrays(pa.array(ends), pa.array(value[keep]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(size.astype(np.int64)), pa.array(keys[0]), pa.array(keys[1]), sketch], ["doc_id", "n_shingles", "key_a", "key_b", "sketch"])

    return run


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """doc_id, n_shingles, 128-bit set key and bottom-k sketch of every row. Null or wordless text: an empty set."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(_sketcher(width, k), "doc_id long, n_shingles long, key_a long, key_b long, sketch array<long>")


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, off in utf8_batches(batch.column(1)):
                row, value = shingle_sets(data, off, width)
                n = len(off) - 1
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.ListArray.from_arrays(pa.array(ends), pa.array(value))], ["rep", "members"])

    return run


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of every node that is not its component's smallest, from edges (a, b).

    Alternates large-star and small-star steps; every round is one written table, so the plan stays short.
    """
    e = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen, size = None, e.count()
    if not size:
        return e.toDF("node", "component")

    def joined(df: DataFrame, low: DataFrame) -> DataFrame:
        """df with the smallest neighbour of each u; a centre's edges are dealt out where there are many."""
        return df.join(low.drop("n"), "u") if size < FEW_EDGES else salted(df, low.drop("n"), "u", "v", low.select("u", "n"), 2 * size)

    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = joined(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = joined(large, large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = near.select("u", F.col("m").alias("v")).unionByName(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = materialise(small.distinct(), "cc")
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or state[0] == 0:
            break
        seen, size = state, state[0]
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _relabel(df: DataFrame, labels: DataFrame, column: str, to: str) -> DataFrame:
    x = labels.select(F.col("node").alias(column), F.col("component").alias("__c"))
    return df.join(x, column, "left").withColumn(to, F.coalesce("__c", column)).drop("__c")


def _compose(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (node, component), a written table, after further edges (a, b): components of those that they join."""
    upper = _relabel(_relabel(edges, labels, "a", "x"), labels, "b", "y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = components(upper)
    if joined.isEmpty():
        return labels
    moved = joined.toDF("component", "__c")
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    old = salted(labels, moved, "component", "node", sizes, labels.count(), "left").select("node", F.coalesce("__c", "component").alias("component"))
    return old.unionByName(joined)  # a joined component's own smallest node had no label yet


def _similar(size_a: Column, size_b: Column, both: Column, percent: int) -> Column:
    return 100 * both >= percent * (size_a + size_b - both)


def _compatible(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _both_sides(pairs: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """pairs (a, b), a written table, with column `name` of right (rep, name) for a and for b."""
    left, centre = right.toDF("a", f"{name}_a"), right.toDF("b", f"{name}_b")
    sizes, total = lambda c: pairs.groupBy(c).agg(F.count(F.lit(1)).alias("n")), pairs.count()
    return salted(salted(pairs, left, "a", "b", sizes("a"), total), centre, "b", "a", sizes("b"), total)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = _both_sides(materialise(pairs.select("a", "b"), "pairs"), sets.select("rep", "members"), "m")
    return both.where(_similar(F.size("m_a"), F.size("m_b"), F.size(F.array_intersect("m_a", "m_b")), percent)).select("a", "b")


def floors(percent: int, k: int) -> list[int]:
    """Smallest number of values in both sketches that a true link has, by the size of the union sketch, 0 to 2k.

    Up to k values the sketches are whole sets, and the number exact. Above, the union sketch ends where one sketch
    does, at a size between k and 2k that the values themselves decide, so the chance of a miss is shared out over all.
    """
    return [-(-percent * u // 100) if u <= k - 1 else binomial_floor(u, percent / 100, MISS / (k + 1)) for u in range(2 * k + 1)]


def _likely(pairs: DataFrame, sketch: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose union sketch has enough values in both, with their share (likeness)."""
    x = _both_sides(materialise(pairs.select("a", "b"), "pairs"), sketch, "s")
    end = lambda c: F.when(F.size(c) < k, F.lit(2**63 - 1)).otherwise(F.element_at(c, -1))
    x = x.withColumn("end", F.least(end("s_a"), end("s_b"))).withColumn("both", F.size(F.array_intersect("s_a", "s_b")))
    upto = lambda c: F.size(F.filter(c, lambda v: v <= F.col("end")))
    x = x.withColumn("union", upto("s_a") + upto("s_b") - F.col("both"))
    least = F.get(F.array(*[F.lit(f) for f in floors(percent, k)]), F.col("union"))
    return x.where(F.col("both") >= least).select("a", "b", (F.col("both") / F.col("union")).alias("likeness"))


def _mixed(entries: DataFrame, total: int, labels: DataFrame) -> DataFrame:
    """Entries of lists whose members are in several components, with comp and the list's largest (main)."""
    x = _relabel(entries, labels, "rep", "comp")
    counts = x.groupBy("v", "comp").agg(F.count(F.lit(1)).alias("here"))
    mixed = counts.groupBy("v").agg(F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("here", "comp")).alias("main"), F.sum("here").alias("n")).where("comps > 1")
    mixed = materialise(mixed, "lists")
    return materialise(salted(x, mixed.select("v", "main"), "v", "rep", mixed.select("v", "n"), total), "open")


def _askers(percent: int, k: int):
    least = np.array(floors(percent, k))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The members of one pair of blocks that have a likely partner on the other side, in another component.

        Pairs that share an earlier long list, in everyone's order, are left to that.
        """
        ask, have = pdf[pdf["open"]], pdf[~pdf["open"]]
        if ask.empty or have.empty:
            return pdf.iloc[:0].drop(columns=["sketch", "earlier"])
        one, two = [np.asarray(x) for x in ask["sketch"]], [np.asarray(x) for x in have["sketch"]]
        both = _overlaps(one, two)
        n, m = ask["n"].to_numpy()[:, None], have["n"].to_numpy()[None, :]
        apart = ask["comp"].to_numpy()[:, None] != have["comp"].to_numpy()[None, :]
        new = _overlaps([np.asarray(x, np.int64) for x in ask["earlier"]], [np.asarray(x, np.int64) for x in have["earlier"]]) == 0
        q, x = np.nonzero((both > 0) & apart & new & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
        end = lambda s: np.array([v[-1] if len(v) >= k else 2**63 - 1 for v in s], np.int64)
        wide = lambda s: np.array([np.pad(v, (0, k - len(v)), constant_values=2**63 - 1) for v in s], np.int64)
        sizes, ends, rows = [np.array([len(v) for v in s]) for s in (one, two)], (end(one), end(two)), (wide(one), wide(two))
        likely_a, likely_b = np.zeros(len(one), bool), np.zeros(len(two), bool)
        for lo in range(0, len(q), 1 << 14):
            i, j = q[lo : lo + (1 << 14)], x[lo : lo + (1 << 14)]
            rest = ~(likely_a[i] & likely_b[j])  # the others are told already
            i, j = i[rest], j[rest]
            stop = np.minimum(ends[0][i], ends[1][j])[:, None]
            a = np.minimum((rows[0][i] <= stop).sum(1), sizes[0][i])  # padding does not count
            b = np.minimum((rows[1][j] <= stop).sum(1), sizes[1][j])
            shared = both[i, j].astype(np.int64)
            ok = shared >= least[a + b - shared]
            likely_a[i[ok]], likely_b[j[ok]] = True, True
        return pd.concat([ask[likely_a], have[likely_b]]).drop(columns=["sketch", "earlier"])

    return run


def _block_links(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links between the open members and the others of one pair of blocks; one for each open member and component."""
        ask, have = pdf[pdf["open"]], pdf[~pdf["open"]]
        if ask.empty or have.empty:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        both = _overlaps([np.asarray(x) for x in ask["members"]], [np.asarray(x) for x in have["members"]])
        union = np.array([len(x) for x in ask["members"]])[:, None] + np.array([len(x) for x in have["members"]])[None, :] - both
        q, x = np.nonzero((100 * both >= percent * union) & (ask["comp"].to_numpy()[:, None] != have["comp"].to_numpy()[None, :]))
        out = pd.DataFrame({"a": ask["rep"].to_numpy()[q], "b": have["rep"].to_numpy()[x], "c": have["comp"].to_numpy()[x]})
        return out.drop_duplicates(["a", "c"])[["a", "b"]]

    return run


def _overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Number of values that each of some sets shares with each of some others."""
    shared = np.intersect1d(np.concatenate(one), np.concatenate(two))
    both = np.zeros((len(one), len(two)), np.float32)
    for lo in range(0, len(shared), 4096):  # some columns of the membership matrices at a time
        part = shared[lo : lo + 4096]
        both += _held(one, part) @ _held(two, part).T
    return both


def _held(sketches_: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """0 or 1: whether a sketch (row) has a value (column)."""
    row = np.repeat(np.arange(len(sketches_)), [len(s) for s in sketches_])
    every = np.concatenate(sketches_)
    at = np.minimum(np.searchsorted(values, every), len(values) - 1)
    hit = values[at] == every
    out = np.zeros((len(sketches_), len(values)), np.float32)
    out[row[hit], at[hit]] = 1
    return out


def _long_links(open_: DataFrame, sketch: DataFrame, sets: DataFrame, total: int, percent: int, k: int) -> DataFrame:
    """Links (a, b) within long lists, of members outside a list's largest component to members of other components.

    Lists have one order. Where all open members of a list are in an earlier one too, that one compares them with all
    that the two lists share, so of this list only the others take part.
    """
    width = 1.001 * max(math.log(100 / percent), 1e-3)
    order = Window.partitionBy("rep").orderBy("m", "v")
    earlier = F.collect_list("v").over(order.rowsBetween(Window.unboundedPreceding, -1))
    is_open = F.col("comp") != F.col("main")
    long = open_.withColumns({"band": F.floor(F.log("n") / width).cast("int"), "earlier": earlier, "asks": is_open})
    long = materialise(long.drop("main"), "long")
    asks = long.where("asks").groupBy("v").agg(F.count(F.lit(1)).alias("all"))
    shared = long.where("asks").select("v", F.explode("earlier").alias("u")).groupBy("v", "u").agg(F.count(F.lit(1)).alias("n"))
    covers = shared.join(asks, "v").where("n = all").groupBy("v").agg(F.collect_list("u").alias("covers"))
    counts = materialise(long.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "counts")
    covers = materialise(counts.select("v").join(covers, "v", "left"), "covers")
    long = salted(long, covers, "v", "rep", counts, total).withColumn("has", ~F.coalesce(F.arrays_overlap("earlier", "covers"), F.lit(False))).where("has or asks").drop("covers")
    # Sets of one band have nearly one size, so blocks are bounded in documents and in shingles.
    parts = lambda n: F.ceil(n * F.greatest(F.lit(1 / BLOCK_DOCS), F.exp((F.col("band") + 1) * width) / BLOCK_SHINGLES)).cast("int")
    long = materialise(long, "long")
    bands = long.groupBy("v", "band").agg(F.count_if("has").alias("have"), F.count_if("asks").alias("ask"), F.count(F.lit(1)).alias("all"))
    blocks = F.struct("band", F.struct(parts(F.col("have")).alias("blocks"), parts(F.col("ask")).alias("asks")))
    lists = bands.groupBy("v").agg(F.map_from_entries(F.collect_list(blocks)).alias("bands"), F.sum("all").alias("rows"), F.sum("have").alias("have"))
    lists = materialise(lists.where("have > 0"), "bands")
    long = salted(long, lists.select("v", "bands"), "v", "rep", lists.select("v", F.col("rows").alias("n")), total)
    own = lambda field: F.struct("band", F.pmod(F.xxhash64("rep"), F.col("bands")[F.col("band")][field]).cast("int").alias("part"))
    near = F.filter(F.array(*[F.col("band") + d for d in (-1, 0, 1)]), lambda b: F.map_contains_key("bands", b))

    def every(field: str) -> Column:
        """The blocks of a kind in the bands around a member's own."""
        parts = lambda b: F.filter(F.sequence(F.lit(0), F.col("bands")[b][field]), lambda i: i < F.col("bands")[b][field])
        return F.explode(F.flatten(F.transform(near, lambda b: F.transform(parts(b), lambda i: F.struct(b.alias("band"), i.alias("part"))))))

    group, about = ["v", "hb", "hp", "ab", "ap"], ["rep", "n", "comp", "open"]
    place = [F.col("have.band").alias("hb"), F.col("have.part").alias("hp"), F.col("ask.band").alias("ab"), F.col("ask.part").alias("ap")]
    side = lambda df, is_open, have, ask: df.withColumns({"open": F.lit(is_open), "have": have}).withColumn("ask", ask).select("v", *place, *about, "earlier")
    dealt = side(long.where("has"), False, own("blocks"), every("asks")).unionByName(side(long.where("asks"), True, every("blocks"), own("asks")))
    schema = "v long, hb int, hp int, ab int, ap int, rep long, n long, comp long, open boolean"
    askers = materialise(dealt.join(sketch, "rep").groupBy(group).applyInPandas(_askers(percent, k), schema), "askers")
    return askers.join(sets, "rep").groupBy(group).applyInPandas(_block_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    Documents are linked if 100 * shared shingles >= percent * shingles in either. Other columns of docs are ignored.
    Null, empty and wordless texts have no shingles and are linked with nothing. Rows that share a doc_id are one
    node; a null doc_id is its own component (null) and kept, unless its set equals that of a document with an id.
    """
    small_batches(docs)
    c = max(1, binomial_floor(k, percent / 100, MISS))
    need = F.least(F.lit(c), F.ceil(F.col("n") * percent / 100).cast("int"))
    every = materialise(sketches(docs, width, k), "sketches")
    classes = every.where("n_shingles > 0").groupBy("key_a", "key_b").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialise(classes, "classes")
    known = classes.where("rep is not null")
    sketch = known.select("rep", "sketch")

    # Lists of the first of each class's shared values, the rarest first; values that no other class has come before.
    rows = known.select("rep", "n", F.explode("sketch").alias("v"))
    values = materialise(rows.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "values")
    total = known.agg(F.coalesce(F.sum(F.size("sketch")), F.lit(0))).first()[0]
    shared = salted(rows, values, "v", "rep", values.select("v", F.col("m").alias("n")), total)
    shared = shared.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("m", "v"))).alias("shared"))
    first = F.size("shared") - need + 1
    entries = materialise(shared.where(first > 0).select("rep", "n", F.explode(F.slice("shared", 1, first)).alias("x")).select("rep", "n", "x.v"), "prefixes")
    lists = materialise(entries.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("m > 1"), "lists")
    total = entries.count()
    entries = materialise(salted(entries, lists, "v", "rep", lists.select("v", F.col("m").alias("n")), total), "entries")

    # Full sets of the classes in lists, from the texts again.
    wanted = entries.select(F.col("rep").alias("doc_id")).distinct()
    sets = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).join(wanted, "doc_id", "left_semi").mapInArrow(_full_sets(width), "rep long, members array<long>")
    sets = materialise(sets, "sets")

    # First links: to the list's ends met most often.
    ends = entries.select(F.col("rep").alias("a"), F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("lo").alias("b")), F.struct(F.lit(1).alias("side"), F.col("hi").alias("b")))).alias("e"))
    ends = ends.select("a", "e.side", "e.b").where("a <> b").groupBy("a", "side", "b").agg(F.count(F.lit(1)).alias("times"))
    stars = ends.groupBy("a", "side").agg(F.max_by("b", F.struct("times", "b")).alias("b")).select("a", "b").distinct()
    labels = materialise(components(_confirm(stars, sets, percent)), "labels")

    # Second links: members outside a list's largest component to a member of it, the likeliest over all lists.
    entries = entries.select("v", "rep", "n", "m")
    open_lists = _mixed(entries, total, labels)
    inside = materialise(open_lists.where("comp = main").groupBy("v").agg(F.min_by("rep", F.xxhash64("rep", "v")).alias("b")), "inside")
    outside = open_lists.where("comp <> main").select("v", F.col("rep").alias("a"))
    sizes = outside.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    pairs = salted(outside, inside, "v", "a", sizes, total).select("a", "b").distinct()
    best = _likely(pairs, sketch, k, percent).groupBy("a").agg(F.max_by("b", F.struct("likeness", "b")).alias("b"))
    labels = materialise(_compose(labels, _confirm(best, sets, percent)), "labels")

    # All pairs that are left, in lists whose members are still in several components.
    open_lists = _mixed(entries, total, labels)
    short = open_lists.where(F.col("m") <= SHORT_LIST).select("v", "rep", "comp", "n")
    x, y = short.toDF("v", "a", "ca", "na"), short.toDF("v", "b", "cb", "nb")
    near = x.join(y, "v").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _compatible(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct()
    far = _long_links(open_lists.where(F.col("m") > SHORT_LIST), sketch, sets, total, percent, k)
    more = materialise(_confirm(_likely(near, sketch, k, percent), sets, percent).unionByName(far), "links")
    labels = materialise(_compose(labels, more), "labels")

    # Of components, then of every document.
    merged = _relabel(known.select("key_a", "key_b", "rep"), labels, "rep", "component_id").select("key_a", "key_b", "component_id")
    merged = materialise(merged, "merged")
    full = every.where("n_shingles > 0").select("doc_id", "n_shingles", F.struct("key_a", "key_b").alias("key"), F.monotonically_increasing_id().alias("row"))
    copies = classes.select(F.struct("key_a", "key_b").alias("key"), F.col("copies").alias("n"))
    full = salted(full, merged.select(F.struct("key_a", "key_b").alias("key"), "component_id"), "key", "row", copies, every.count(), "left").select("doc_id", "n_shingles", "component_id")
    out = full.unionByName(every.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull()))
