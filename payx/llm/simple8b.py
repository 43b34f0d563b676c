"""Token ids in Simple-8b, a word-aligned code, in files of their own.

A 64-bit word holds a selector in its top four bits and, below, as many ids as fit at one width (COUNTS, WIDTHS).
Selector 0 is the escape: the next word is one id as it is. The ids of a range are cut in blocks of BLOCK, whose words
are coded apart; up to SEGMENT blocks in a row make a record of the file. A record states the offset of each of its
blocks, in words and in ids, so any block is found at once and decodes on its own, all its words together.

A record, little-endian: magic, range, number of the record in the range, number of blocks, of document parts (uint32
each), ids of the range before it (int64); a row for each block (uint32 first word, uint32 words, uint32 first id,
uint32 ids); the parts (int64 document id, int64 place of the document in its range, uint32 ids of it in this record,
uint32 flags: 1 first part, 2 last part, 4 no document id); the words. Records are written in order with Spark's text
sink, whose line separator, one newline, ends each; RECORDS of them are a file at most.

A range is what one partition of Spark's range partitioning by document id holds; ranges and what they hold ascend.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payx.llm.common import materialise, shared_dir, small_batches
from payx.llm.tokens import library

# Fixed values of the format: ids for each word and bits for each id, by selector.
COUNTS = np.array([0, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"PXS8"
BLOCK, SEGMENT, RECORDS = 1 << 14, 64, 16
_HEAD = struct.Struct("<4sIIIIq")
_BLOCKS = np.dtype([("word", "<u4"), ("words", "<u4"), ("id", "<u4"), ("ids", "<u4")])
_PART = np.dtype([("doc", "<i8"), ("place", "<i8"), ("ids", "<u4"), ("flags", "<u4")])
_STEP = np.maximum(np.append(COUNTS, 1), 1)  # an id without a selector takes a word like one that has the escape
_SHIFT, _MASK = WIDTHS.astype(np.uint64), np.array([(1 << int(w)) - 1 for w in WIDTHS], np.uint64)
_LIMITS = np.array([1 << int(w) for w in WIDTHS[1:]], np.uint64)
# The narrowest width that holds an id, as the selector that has it (16: none), for small ids.
_SELECTOR = (np.searchsorted(_LIMITS, np.arange(1 << 17, dtype=np.uint64), "right") + 1).astype(np.uint8)


def _pick(ids: np.ndarray) -> np.ndarray:
    """Selector of a word that would start at each id: the one with most ids, all of which fit; 16 where none does.

    Where a selector fits, all with fewer and wider ids fit too, so it follows from the number of those that fit.
    """
    n = len(ids)
    most = np.take(_SELECTOR, ids) if int(ids.max()) < len(_SELECTOR) else (np.searchsorted(_LIMITS, ids, "right") + 1).astype(np.uint8)
    pick, width = np.full(n, 16, np.uint8), 1
    for s in range(15, 0, -1):  # most: the largest need of the next COUNTS[s] ids, from one count to the next
        count = int(COUNTS[s])
        if count > n:
            break
        while width < count:
            more = min(count - width, width)
            most, width = np.maximum(most[: len(most) - more], most[more:]), width + more
        pick[: len(most)] -= (most <= s).view(np.uint8)
    return pick


def _starts(step: np.ndarray) -> np.ndarray:
    """First ids of the words, each where the word before ends; 16 words are taken in each step of the loop."""
    n = len(step)
    one = np.append(np.arange(n) + step, n)
    leap = one
    for _ in range(4):
        leap = np.take(leap, leap)
    view, bases, i = memoryview(leap), [], 0
    while i < n:
        bases.append(i)
        i = view[i]
    line = np.empty((16, len(bases)), np.int64)
    line[0] = bases
    for j in range(1, 16):
        np.take(one, line[j - 1], out=line[j], mode="clip")
    starts = line.T.ravel()
    return starts[: int(np.searchsorted(starts, n))]


def pack(ids: np.ndarray) -> np.ndarray:
    """The words of a sequence of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids)
    if not len(ids):
        return np.empty(0, np.uint64)
    pick = _pick(ids)
    starts = _starts(np.take(_STEP, pick))
    sel = np.take(pick, starts).astype(np.int64) & 15
    # Bits below an id in its word: its place there times the width.
    first = np.repeat(starts, _STEP[sel])
    below = (np.arange(len(ids)) - first) * np.repeat(WIDTHS[sel], _STEP[sel])
    words = np.bitwise_or.reduceat(ids.astype(np.uint64) << below.view(np.uint64), starts) | sel.astype(np.uint64) << np.uint64(60)
    escape = sel == 0
    if not escape.any():
        return words
    words[escape] = 0
    return np.insert(words, np.flatnonzero(escape) + 1, ids[starts[escape]])


def unpack(words: np.ndarray) -> np.ndarray:
    """The ids of the words of one block."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # words that follow an escape
    for i in np.flatnonzero(sel == 0).tolist():
        if not raw[i]:
            raw[i + 1] = True
    if raw.any():
        value, at = words[raw], np.flatnonzero(raw) - 1
        words, sel = np.where(np.isin(np.arange(len(words)), at), 0, words), np.where(raw, -1, sel)
        keep = ~raw
        words, sel = words[keep], sel[keep]
    count = _STEP[sel]
    begin = np.cumsum(count) - count
    inside = np.arange(int(count.sum())) - np.repeat(begin, count)
    shift, mask = np.repeat(_SHIFT[sel], count), np.repeat(_MASK[sel], count)
    out = np.repeat(words, count) >> np.minimum(inside.astype(np.uint64) * shift, np.uint64(63)) & mask
    if raw.any():
        out[begin[sel == 0]] = value
    return out


def segments(docs: Iterable[tuple[int | None, np.ndarray]], number: int = 0, block: int = BLOCK, most: int = SEGMENT) -> Iterator[bytes]:
    """Records of one range from (document id, ids) in order; they hold up to `most` blocks of ids in memory."""
    size = block * most
    record, before, place, room, parts, held = 0, 0, 0, size, [], []

    def made() -> bytes:
        ids = np.concatenate(held) if held else np.empty(0, np.uint32)
        words = [pack(ids[i : i + block]) for i in range(0, len(ids), block)]
        table = np.zeros(len(words), _BLOCKS)
        table["words"] = [len(w) for w in words]
        table["word"] = np.cumsum(table["words"]) - table["words"]
        table["id"] = np.arange(len(words)) * block
        table["ids"] = np.minimum(len(ids) - table["id"], block)
        head = _HEAD.pack(MAGIC, number, record, len(words), len(parts), before)
        return b"".join([head, table.tobytes(), np.array(parts, _PART).tobytes(), *(w.astype("<u8").tobytes() for w in words)])

    for doc, ids in docs:
        at = 0
        while True:
            take = min(room, len(ids) - at)
            end = at + take == len(ids)
            parts.append((doc if doc is not None else 0, place, take, (at == 0) | end << 1 | (doc is None) << 2))
            held.append(ids[at : at + take])
            at, room = at + take, room - take
            if room == 0 or len(parts) >= size:
                yield made()
                record, before, room, parts, held = record + 1, before + size - room, size, [], []
            if end:
                break
        place += 1
    if parts:
        yield made()


def records(content: bytes) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(range, record number, ids before, blocks, parts, words) of the records of one file."""
    at = 0
    while at < len(content):
        magic, number, record, blocks, parts, before = _HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a record of token ids")
        at += _HEAD.size
        table = np.frombuffer(content, _BLOCKS, blocks, at)
        at += table.nbytes
        rows = np.frombuffer(content, _PART, parts, at)
        at += rows.nbytes
        words = np.frombuffer(content, "<u8", int(table["words"].sum()), at)
        at += words.nbytes + 1
        yield number, record, before, table, rows, words


def decoded(table: np.ndarray, words: np.ndarray, block: int | None = None) -> np.ndarray:
    """Ids of one block of a record, or of all, by the blocks' offsets."""
    some = table if block is None else table[block : block + 1]
    parts = [unpack(words[b["word"] : b["word"] + b["words"]]) for b in some]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def write(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None, rows_per_range: int = 20_000, block: int = BLOCK, segment: int = SEGMENT, file_records: int = RECORDS) -> str:
    """Write the ids of every text, each document followed by end_id, in ascending order of doc_id; returns the folder.

    Rows without an id come first; rows of one id are in the order of their place in docs. Null text is empty. Ranges
    are Spark's, by id and place, so that rows of one id are dealt out too.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "ids")
    # Ids travel as text, as a null would turn whole numbers into floats.
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // rows_per_range))
    order = [F.col("id").asc_nulls_first(), F.col("row")]
    rows = docs.repartitionByRange(n, *order).sortWithinPartitions(*order).select(F.col("id").cast("string").alias("doc_id"), "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, end = library(tokenizer), np.array([end_id], "<u4")

        def documents():
            for pdf in frames:
                ids = [None if i is None else int(i) for i in pdf["doc_id"].tolist()]
                for i, x in zip(ids, known.in_turn(pdf["text"].tolist()), strict=True):
                    yield i, np.concatenate([x, end])

        for record in segments(documents(), TaskContext.get().partitionId(), block, segment):
            yield pd.DataFrame({"value": [record]})

    rows.mapInPandas(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", file_records).text(path)
    return path


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the one of CRC-32, bits reversed as there."""
    out = 0
    for i in range(31, -1, -1):
        if b >> i & 1:
            out ^= a
        a = a >> 1 ^ (0xEDB88320 if a & 1 else 0)
    return out


def joined_crc(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings in a row, from theirs and the size of the second."""
    square, shift, n = 0x80000000 >> 8, 0x80000000, size  # x to the 8th, 1
    while n:
        if n & 1:
            shift = _times(shift, square)
        square, n = _times(square, square), n >> 1
    return _times(first, shift) ^ second


_ROWS = "range int, place long, doc_id string, whole boolean, record int, start long, n_tokens long, ids_crc32 long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """range, place, doc_id, start (in the range), n_tokens, ids_crc32 of every document of the files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _ROWS.split(", ")]
        for pdf in frames:
            for content in pdf["content"]:
                for number, record, before, table, parts, words in records(content):
                    low = decoded(table, words).astype("<u4")
                    ends = np.cumsum(parts["ids"], dtype=np.int64)
                    out = []
                    for doc, place, take, flags, end in zip(parts["doc"].tolist(), parts["place"].tolist(), parts["ids"].tolist(), parts["flags"].tolist(), ends.tolist(), strict=True):
                        out.append((number, place, None if flags & 4 else str(doc), flags & 3 == 3, record, before + end - take, take, zlib.crc32(low[end - take : end])))
                    yield pd.DataFrame(out, columns=names)

    @F.pandas_udf("long")
    def joined(parts: pd.Series) -> pd.Series:
        out = []
        for row in parts:
            crc = 0
            for p in row:
                crc = joined_crc(crc, p["crc"], 4 * p["n"])
            out.append(crc)
        return pd.Series(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = materialise(files.mapInPandas(run, _ROWS).withColumn("doc_id", F.col("doc_id").cast("long")), "index")
    whole = found.where("whole").select("range", "place", "doc_id", "start", "n_tokens", "ids_crc32")
    # Documents that span records, in the order of those.
    parts = F.sort_array(F.collect_list(F.struct("record", F.col("n_tokens").alias("n"), F.col("ids_crc32").alias("crc"))))
    cut = found.where("not whole").groupBy("range", "place").agg(F.max("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), parts.alias("parts"))
    return whole.unionByName(cut.withColumn("ids_crc32", joined("parts")).drop("parts"))


def document_index(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of docs, from files that are written and read back.

    start counts the ids of all documents before it: those before it in its range, which the files state, and the sums
    of the ranges before, of which there is one row each. Null, empty and very long texts, repeated rows and ids that
    are null have a row like any other; other columns of docs are ignored; no rows give none.
    """
    from pyspark.sql import Window

    found = read(docs.sparkSession, write(docs, tokenizer, end_id))
    totals = found.groupBy("range").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("base"))
    return found.join(before, "range").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
