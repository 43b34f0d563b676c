"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each with a cost. Documents are taken by falling length; one goes into the
open bin that it leaves with least room, else into a new bin. A new bin's size is the one with the least cost for each
token it can expect to hold: all it can take if enough is left to fill it, else what is left. At the end every bin is
downsized to the smallest permitted length that holds its contents.

A document longer than the largest length is cut: full pieces fill bins of their own, the rest is packed. Pieces are
dealt by a hash of their row's number into groups of about GROUP pieces, packed independently, so one group fits one
task however skewed the input is; a group loses at most the room of its last few bins.

Lengths are token ids of a public vocabulary with an end mark (`tokens_and_end`), or any other column. A piece is an
exact span of its document's ids, and `sequences` lists the spans of every bin in order.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payx.llm.common import WORD, materialise, small_batches
from payx.llm.tokens import token_count

CAPACITIES = (512, 1024, 2048, 4096, 8192)
GROUP = 2000


def default_cost(capacity: int) -> float:
    """Work of one sequence: a share in its length and one in its square, and a fixed one."""
    return capacity * (1 + capacity / 65536) + 64


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, cost=default_cost) -> list[tuple[int, int, int]]:
    """(bin, capacity, offset) of every length; each is between 0 and the largest capacity."""
    sizes = sorted(capacities)
    left = sum(lengths)
    bins: list[list[int]] = []  # capacity, used
    rooms: list[tuple[int, int]] = []  # (room, bin), in order
    where: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            fits = sizes[bisect_left(sizes, n) :]
            b, room = len(bins), min(fits, key=lambda c: (cost(c) / max(1, min(c, left)), c))
            bins.append([room, 0])
        where[i] = (b, bins[b][1])
        bins[b][1] += n
        left -= n
        insort(rooms, (room - n, b))
    final = [sizes[bisect_left(sizes, used)] for _, used in bins]
    return [(b, final[b], offset) for b, offset in where]


def words_and_end(text: Column) -> Column:
    """Length of a document in a sequence, in words and an end mark."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long") + 1


def tokens_and_end(text: Column, tokenizer: str) -> Column:
    """The same in ids of a vocabulary; null text is empty."""
    return token_count(text, tokenizer) + 1


def packed(docs: DataFrame, length: Column, capacities: tuple[int, ...] = CAPACITIES, cost=default_cost) -> DataFrame:
    """doc_id, piece, start, length, bin_id, capacity, bin_offset: every piece of every row, and its place.

    length is a column of docs; null and negative lengths count as 0, and such a document still has one empty piece.
    bin_id is unique over all groups. Rows that share a doc_id, or have none, are packed on their own, and are dealt to
    groups like all others; ties of length keep the order of rows. Other columns of docs are ignored; no rows give none.
    """
    largest = max(capacities)
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("n"), F.monotonically_increasing_id().alias("row"))
    # Lengths are found once; the number of groups follows from that of pieces.
    rows = materialise(rows.withColumn("pieces", F.greatest(F.ceil(F.col("n") / largest), F.lit(1)).cast("long")), "lengths")
    groups = max(1, -(-(rows.agg(F.sum("pieces")).first()[0] or 0) // GROUP))
    items = rows.select("doc_id", "n", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    items = items.select("doc_id", "row", "piece", (F.col("piece") * largest).alias("start"), F.least(F.col("n") - F.col("piece") * largest, F.lit(largest)).alias("length"))
    items = items.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("long"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "piece"], kind="stable", ignore_index=True)
        got = np.array(pack(pdf["length"].tolist(), capacities, cost), np.int64).reshape(-1, 3)
        return pd.DataFrame({"doc_id": pdf["doc_id"], "piece": pdf["piece"], "start": pdf["start"], "length": pdf["length"], "bin_id": int(key[0]) << 32 | got[:, 0], "capacity": got[:, 1], "bin_offset": got[:, 2]})

    items = items.withColumn("doc_id", F.col("doc_id").cast("string"))  # a null would turn whole numbers into floats
    return items.groupBy("group").applyInPandas(run, "doc_id string, piece long, start long, length long, bin_id long, capacity long, bin_offset long").withColumn("doc_id", F.col("doc_id").cast("long"))


def sequences(packed_: DataFrame) -> DataFrame:
    """bin_id, capacity, used, spans (doc_id, start, length, in order) of every sequence; a span is of the document's ids."""
    spans = F.sort_array(F.collect_list(F.struct("bin_offset", "doc_id", "piece", "start", "length")))
    x = packed_.groupBy("bin_id").agg(F.max("capacity").alias("capacity"), F.sum("length").alias("used"), spans.alias("s"))
    return x.select("bin_id", "capacity", "used", F.transform("s", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"))).alias("spans"))
