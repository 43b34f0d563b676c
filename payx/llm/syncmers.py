"""Document fingerprints from closed syncmers.

A k-mer of code points is selected if the smallest hash among its inner s-mers lies at its first or last place. That
depends on the k-mer alone, so equal passages select equal k-mers wherever they stand. `anchors` returns the selected
k-mers with their places.

* A fingerprint is a sample of the distinct anchor hashes, 12 hex digits each: all below a fixed bound, one of SHARE,
  and at least the KEEP smallest. So a long text keeps a share of its anchors that does not fall with its length.
  Likeness estimates the Jaccard similarity of two texts' anchor sets from two fingerprints.
* `aligned` matches anchors by place: the share of a text's anchors, all of them, that the other text has too, at the
  displacement that most of those have in common. Anchors need no context, so a passage matches where it was moved to.

Null text counts as empty. An empty text has the empty fingerprint; two of them are alike to 1, one and another text
to 0. A text shorter than k is one anchor; a longer one that selects nothing gets its smallest k-mer. Repeated rows
each have a row; other columns than doc_id and text are ignored; no rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payx.llm.common import range_buckets, small_batches
from payx.llm.kernels import U, mix

K, S, KEEP, SHARE = 24, 6, 128, 8
_BOUND = (1 << 48) // SHARE
_B = 0xC2B2AE3D27D4EB4F | 1


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """A polynomial hash of every n-gram, by doubling."""
    out, size, have = np.zeros(len(codes) - n + 1, np.uint64), 0, codes
    width, left = 1, n
    while left:
        if left & 1:
            out += have[size : size + len(out)] * U(pow(_B, size, 1 << 64))
            size += width
        left >>= 1
        if left:
            have = have[: len(have) - width] + have[width:] * U(pow(_B, width, 1 << 64))
            width *= 2
    return mix(out)


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[: len(x) - width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def syncmers(text: str | None, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors of one text."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    codes = mix(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + U(1))
    if len(codes) < k:
        return np.zeros(1, np.int64), _grams(codes, len(codes))
    inner, span = _grams(codes, s), k - s + 1
    low = _sliding_min(inner, span)
    at = np.flatnonzero((inner[: len(low)] == low) | (inner[span - 1 :] == low))
    hashes = _grams(codes, k)
    if not len(at):
        at = np.array([int(np.argmin(hashes))])
    return at, hashes[at]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The sample of a text's anchor hashes, cut to 48 bits, in order."""
    values = np.unique(hashes >> U(16))
    return values[: max(KEEP, int(np.searchsorted(values, U(_BOUND))))]


def fingerprint(values: np.ndarray) -> str:
    return "".join(f"{v:012x}" for v in values.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of values in both samples among those of either, up to where both are whole."""
    if not len(a) and not len(b):
        return 1.0
    end = min((max(int(x[-1]), _BOUND - 1) for x in (a, b) if len(x) >= KEEP), default=1 << 48)
    a, b = a[: np.searchsorted(a, U(end), "right")], b[: np.searchsorted(b, U(end), "right")]
    both = len(np.intersect1d(a, b, True))
    return both / (len(a) + len(b) - both)


def aligned(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, int]:
    """(share of a's distinct anchors that b has at one displacement, that displacement); an anchor counts where it is
    first. Two texts without anchors are aligned to 1, one without to 0; ties go to the smallest displacement."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0])), 0
    x, at = np.unique(a[1], return_index=True)
    y, to = np.unique(b[1], return_index=True)
    _, i, j = np.intersect1d(x, y, True, return_indices=True)
    if not len(i):
        return 0.0, 0
    moved, times = np.unique(b[0][to[j]] - a[0][at[i]], return_counts=True)
    return float(times.max() / len(x)), int(moved[times.argmax()])


def anchors(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """doc_id, place, hash of every anchor of every text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for i, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                at, h = syncmers(text, k, s)
                yield pd.DataFrame({"doc_id": np.full(len(at), i), "place": at, "hash": h.view(np.int64)})

    return docs.where("doc_id is not null").select("doc_id", "text").mapInPandas(run, "doc_id long, place long, hash long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(sketch(syncmers(t)[1])) for t in texts])

    return docs.select("doc_id", run(F.col("text")).alias("fingerprint"))


_OUT = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, aligned_edited double, aligned_next double, shift_next long"


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows in order, each followed by its next; those of a range end with the head of the following range."""
    held = None
    for bucket, guest, doc_id, text in rows:
        found = syncmers(text)
        now = (bucket, doc_id, text, found, sketch(found[1]))
        if held is not None and held[0] == bucket:
            n = len(held[2])
            cut = n // 3
            edited = held[2][: n - cut] + text[:cut]
            anew = syncmers(edited)
            e = sketch(anew[1])
            share, shift = aligned(held[3], found)
            yield (held[1], n, hashlib.sha256(edited.encode()).hexdigest(), fingerprint(held[4]), fingerprint(e), likeness(held[4], e), likeness(held[4], now[4]), aligned(held[3], anew)[0], share, shift)
        held = None if guest else now


def edited_fingerprints(docs: DataFrame, rows_per_range: int = 2000) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third replaced by the start of the next document.

    Documents follow each other by descending doc_id, equal ids by text; rows without an id come last. The last is
    followed by the first. Texts are shuffled once, into contiguous ranges of ids; the head of every range also
    goes to the range before it. Heads are one id for each range, found from the id column alone.
    """
    spark = docs.sparkSession
    docs = small_batches(docs).select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bucket, count = range_buckets(docs, "doc_id", rows_per_range)
    own = docs.select(bucket.cast("int").alias("bucket"), F.lit(0).alias("guest"), "doc_id", "text")
    heads = own.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()
    heads = [(r["bucket"], r["head"]) for r in sorted(heads, key=lambda r: -r["bucket"])]
    # Each range is followed by the next lower one, the lowest by the highest. Of equal heads one row is taken.
    follow = [(b, heads[(i + 1) % len(heads)][1]) for i, (b, _) in enumerate(heads)]
    asked = F.broadcast(spark.createDataFrame(follow, "bucket int, head long"))
    found = docs.join(asked, docs["doc_id"].eqNullSafe(asked["head"])).groupBy("bucket").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
    guests = found.select("bucket", F.lit(1).alias("guest"), "doc_id", "text")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // 4)
    dealt = own.unionByName(guests).repartition(n, "bucket").sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "text")
    dealt = dealt.select("bucket", "guest", F.col("doc_id").cast("string"), "text")  # a null would turn whole numbers into floats

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in frames:
                yield from zip(pdf["bucket"].tolist(), pdf["guest"].tolist(), pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True)

        names, out = [c.split()[0] for c in _OUT.split(", ")], []
        for row in _edited(rows()):
            out.append(row)
            if len(out) == 500:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return dealt.mapInPandas(run, _OUT).withColumn("doc_id", F.col("doc_id").cast("long"))
