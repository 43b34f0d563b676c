"""Spelling variants of words by search schemes on bidirectional FM-indexes.

Two words are near if one code point inserted, deleted or replaced makes one of the other. Such an error lies in one
half of a word, so the other half is there unchanged. The scheme has two searches: one matches the first half behind a
delimiter exactly and extends to the right over the second, the other matches the second half before a delimiter and
extends to the left over the first; each allows one error where it extends. Both walk intervals of suffix ranks, kept
in step for the text and for the text reversed: extending to one side narrows the interval of that side's index, and
the numbers of smaller characters move the other's. A wavelet matrix over either transformed text gives these numbers
for many states at once.

The index is over a vocabulary, its words delimited. It is cut into shards. A word's near words share its first three
or its last four code points, as words have seven at least; all words of a group that does so are in one shard, once
for each side, and each is searched there. A group with more than `CAP` words is dealt anew, by length and whole half,
and then by that half and a part of the other, so that no group grows with the vocabulary. Which of the groups they
share reports a pair is settled by the words alone, so every pair is counted once.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payx.llm.common import materialise

LEAST = 7
HEAD, TAIL = LEAST // 2, LEAST - LEAST // 2
#: Words of a shard, about, and of a group that is dealt whole; levels of dealing anew.
SHARD, CAP, LEVELS = 40_000, 40_000, 6
#: Words that search at once.
QUERIES = 8192


def rotations(codes: np.ndarray, bits: int) -> np.ndarray:
    """Starts of all rotations of a text in their order; they are distinct. Ranks over k characters give those over 2 k."""
    n, at = len(codes), np.arange(len(codes))
    k = 62 // bits
    key = np.zeros(n, np.int64)
    for j in range(k):
        key = key << bits | codes[(at + j) % n]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        key = rank * n + rank[(at + k) % n]
        k *= 2


class Wavelet:
    """Ranks in a transformed text: of a character, and of those smaller, in many intervals at once."""

    def __init__(self, x: np.ndarray, bits: int):
        self.bits, self.zeros, self.n0 = bits, [], []
        for b in range(bits - 1, -1, -1):
            one = (x >> b & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            self.n0.append(int(self.zeros[-1][-1]))
            x = np.concatenate([x[~one], x[one]])
        every = np.arange(1 << bits)
        self.base = np.zeros(1 << bits, np.int64)
        self.base = self.one(every, np.zeros(len(every), np.int64), np.zeros(len(every), np.int64))[0]

    def one(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of c before lo, in lo..hi, number of smaller ones in lo..hi)"""
        less = np.zeros(len(c), np.int64)
        for level, (z, n0) in enumerate(zip(self.zeros, self.n0, strict=True)):
            up = (c >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = z[lo], z[hi]
            less += np.where(up, b - a, 0)
            lo, hi = np.where(up, n0 + lo - a, a), np.where(up, n0 + hi - b, b)
        return lo - self.base[c], hi - lo, less

    def every(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, character, number before lo, number within, number of smaller ones) of all that occur."""
        own, c, less = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for z, n0 in zip(self.zeros, self.n0, strict=True):
            a, b = z[lo].astype(np.int64), z[hi].astype(np.int64)
            zero, one = b > a, hi - lo > b - a
            own, less = np.concatenate([own[zero], own[one]]), np.concatenate([less[zero], (less + b - a)[one]])
            c = np.concatenate([c[zero] << 1, c[one] << 1 | 1])
            lo, hi = np.concatenate([a[zero], (n0 + lo - a)[one]]), np.concatenate([b[zero], (n0 + hi - b)[one]])
        return own, c, lo - self.base[c], hi - lo, less


class Index:
    """A bidirectional index over distinct words in ascending order, each behind a delimiter, the text closed to a ring."""

    def __init__(self, words: list[str]):
        points = np.frombuffer(("\0" + "\0".join(words)).encode("utf-32-le"), np.uint32)
        alphabet = np.unique(points)
        self.codes = np.searchsorted(alphabet, points).astype(np.int64)
        self.start = np.flatnonzero(points == 0)
        self.size = np.diff(np.append(self.start, len(points))) - 1
        bits = max(1, int(len(alphabet) - 1).bit_length())
        self.less = np.concatenate([[0], np.cumsum(np.bincount(self.codes, minlength=1 << bits))])
        self.order = rotations(self.codes, bits)
        self.left = Wavelet(self.codes[self.order - 1], bits)
        back = self.codes[::-1]
        self.right = Wavelet(back[rotations(back, bits) - 1], bits)

    def near(self, q: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """(place in q, near word) of all near words with the first half of a word, or else with the second, unchanged."""
        found = [self._near(q[a : a + QUERIES], first) for a in range(0, len(q), QUERIES)]
        own = np.concatenate([o + i * QUERIES for i, (o, _) in enumerate(found)] or [np.empty(0, np.int64)])
        return own, np.concatenate([w for _, w in found] or [np.empty(0, np.int64)])

    def _near(self, q: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(self.codes), self.size[q]
        at = self.start[q] + 1  # of a word's first character
        half = size // 2
        char = lambda own, pos: self.codes[(at[own] + pos) % n]

        def extended(index: Wavelet, c, near, far, wide):
            """States one character further on the side of `index`; near is its interval, far the other's."""
            before, wide, smaller = index.one(c, near, near + wide)
            return self.less[c] + before, far + smaller, wide

        own = np.arange(len(q))
        f, r, wide = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), n)
        # The half that stays, to the left: from its last character, or the delimiter behind it, to its end.
        pos, stop = (half - 1, np.full(len(q), -1)) if first else (size.copy(), half)
        while len(on := np.flatnonzero(pos >= stop)):
            f[on], r[on], wide[on] = extended(self.left, char(on, pos[on]), f[on], r[on], wide[on])
            pos[on] -= 1
        # The other half: near is the interval of the side to which it extends, as is `last` its delimiter's place.
        index, way, pos = (self.right, 1, half.copy()) if first else (self.left, -1, half - 1)
        near, far = (r, f) if first else (f, r)
        last = size if first else np.full(len(q), -1)
        empty = np.empty(0, np.int64)
        pool, hits = [empty] * 5, []  # own, pos, near, far, wide of states with an error
        while len(own) or len(pool[0]):
            if len(own):
                here, x, before, count, smaller = index.every(near, near + wide)
                to, across, o, p = self.less[x] + before, far[here] + smaller, own[here], pos[here]
                want = char(o, p)
                inner = p != last[o]
                other = (x != want) & (x != 0)
                replaced, put_in, kept = other & inner, other, (x == want) & inner
                parts = [pool, [o[replaced], p[replaced] + way, to[replaced], across[replaced], count[replaced]], [o[put_in], p[put_in], to[put_in], across[put_in], count[put_in]]]
                gone = (pos != last[own]) & (char(own, pos) != char(own, pos + way))  # of a run of one character its last
                parts.append([own[gone], pos[gone] + way, near[gone], far[gone], wide[gone]])
                pool = [np.concatenate(x) for x in zip(*parts, strict=True)]
                own, pos, near, far, wide = o[kept], p[kept] + way, to[kept], across[kept], count[kept]
            o, p, a, b, w = pool
            a, b, w = extended(index, char(o, p), a, b, w)
            end = p == last[o]
            done = end & (w > 0)
            hits.append((o[done], (b if first else a)[done]))
            on = ~end & (w > 0)
            pool = [o[on], p[on] + way, a[on], b[on], w[on]]
        own = np.concatenate([h[0] for h in hits] or [empty])
        word = np.searchsorted(self.start, self.order[np.concatenate([h[1] for h in hits] or [empty])])
        pairs = np.unique(own * len(self.start) + word)
        return pairs // len(self.start), pairs % len(self.start)


def halves(start: int, end: int, middle: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """What stays at the start and at the end if the error lies in the second or in the first half of the middle."""
    return (start + middle // 2, end), (start, end + middle - middle // 2)


def kept(length: int, side: str, level: int, part: int) -> tuple[int, int]:
    """Code points at the start and at the end of a searching word of this length that stay in the groups of a part."""
    way = (length // 2, 0) if side == "p" else (0, length - length // 2)
    for bit in range(level - 2, -1, -1):
        way = halves(*way, length - sum(way))[part >> bit & 1]
    return way


def reports(a: str, b: str, side: str, level: int, part: int) -> bool:
    """Whether this of the groups that near words a and b share is the one that reports b for a: at each level the first."""
    if side == "s" and a[: len(a) // 2] == b[: len(a) // 2]:
        return False
    own = 0
    for k in range(2, level + 1):
        start, end = kept(len(a), side, k, 2 * own)
        own = 2 * own + (not (b.startswith(a[:start]) and b.endswith(a[len(a) - end :])))
    return own == part


GROUPS = "word string, n long, side string, level int, part int, off int, key string"


def _split(level: int):
    """Groups of the next level for words whose group is too large, each with the lengths of the words that search."""

    def run(batches):
        for batch in batches:
            out = []
            for word, n, side, part, off in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for p, o in [(0, 0), (0, -1), (0, 1)] if level == 1 else [(2 * part, off), (2 * part + 1, off)]:
                    if (length := len(word) + o) >= LEAST:
                        start, end = kept(length, side, level, p)
                        out.append((word, n, side, level, p, o, f"{side}{level}.{p}\0{length}\0{word[:start]}\0{word[len(word) - end :]}"))
            names = GROUPS.replace(",", "").split()[::2]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * len(names), kinds, strict=True)], names)

    return run


def dealt(words: DataFrame, cap: int = CAP) -> DataFrame:
    """(word, n, side, level, part, off, key): every word in its groups, those of more than cap words split.

    A word searches where off is 0; elsewhere it is only found, by words that are longer by off.
    """
    zero = F.lit(0).cast("int")
    sides = words.select("word", "n", F.explode(F.array(F.lit("p"), F.lit("s"))).alias("side"))
    ends = F.when(F.col("side") == "p", F.substring("word", 1, HEAD)).otherwise(F.right("word", F.lit(TAIL)))
    x, ready = sides.select("word", "n", "side", zero.alias("level"), zero.alias("part"), zero.alias("off"), F.concat("side", ends).alias("key")), []
    for level in range(1, LEVELS + 1):
        hot = materialise(x.groupBy("key").count().where(F.col("count") > cap).select("key"), "hot")
        if hot.isEmpty():
            break
        ready.append(x.join(hot, "key", "left_anti").select(x.columns))
        rest = x.join(hot, "key", "left_semi").select("word", "n", "side", "part", "off")
        x = materialise(rest.mapInArrow(_split(level), GROUPS), "groups")
    return reduce(DataFrame.unionByName, [*ready, x])


NEAR = "word string, near long, form_n long, form string"


def _search(table: pa.Table) -> pa.Table:
    """Of every word that searches in a shard and finds some: how many, and the most frequent, the first among equals."""
    text = table.column("word").to_pylist()
    words = sorted(set(text))
    number = {w: i for i, w in enumerate(words)}
    at = np.array([number[w] for w in text])
    count = np.zeros(len(words), np.int64)
    count[at] = table.column("n").to_numpy()
    index = Index(words)
    side, level, part, off = (table.column(c).to_numpy(zero_copy_only=False) for c in ("side", "level", "part", "off"))
    out = []
    for first in (True, False):
        mine = "p" if first else "s"
        rows = np.flatnonzero((off == 0) & (side == mine))
        own, near = index.near(at[rows], first)
        rows = rows[own]
        ok = np.ones(len(rows), bool)
        for i in np.flatnonzero(level[rows] > 1) if first else range(len(rows)):
            r = rows[i]
            ok[i] = reports(words[at[r]], words[near[i]], mine, int(level[r]), int(part[r]))
        out.append((at[rows[ok]], near[ok]))
    own, near = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((near, -count[near], own))  # words are in code-point order
    own, near = own[order], near[order]
    begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.empty(0, np.int64)
    total = np.diff(np.append(begin, len(own)))
    return pa.table({"word": pa.array([words[i] for i in own[begin]], pa.string()), "near": pa.array(total, pa.int64()), "form_n": pa.array(count[near[begin]], pa.int64()), "form": pa.array([words[i] for i in near[begin]], pa.string())})


def neighbours(words: DataFrame, shard: int = SHARD, cap: int = CAP) -> DataFrame:
    """(word, n_near, best_n, best) of words (word, n), distinct and of seven code points at least, that have near words."""
    x = materialise(dealt(words, cap), "groups")
    shards = max(1, -(-x.count() // shard))
    x = x.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    found = x.groupBy("shard").applyInArrow(_search, NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("k"), F.col("form").alias("w"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("best.k")).alias("best_n"), F.col("best.w").alias("best"))


def vocabulary(docs: DataFrame, least_n: int = 2, damage: int = 31) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z in lower case, of seven code points and more, at least so often.

    Where `damage` divides the crc32 of `doc_id:run`, the run's code point at that number modulo its length is gone.
    """
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    run = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(rf"[a-zÀ-ÿ]{{{LEAST},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    x = run.withColumn("h", h).withColumn("p", (F.col("h") % F.length("run")).cast("int"))
    word = F.when(F.col("h") % damage == 0, F.concat(F.left("run", F.col("p")), F.substring("run", F.col("p") + 2, F.length("run")))).otherwise(F.col("run"))
    return x.select(word.alias("word")).where(F.length("word") >= LEAST).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where forms lead in the end. Ways double in length each round."""
    x = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = x.join(x.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left")
        y = materialise(on.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        if y.where("moved").isEmpty():
            return x
        x = y.select("word", "root")


def grouped(words: DataFrame, ratio: int = 10, shard: int = SHARD, cap: int = CAP) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (word, n).

    A word's form is its most frequent near word, the first in code-point order among equals, if that occurs `ratio`
    times as often or more; the root is where forms lead. Words are distinct and have seven code points at least.
    """
    words = materialise(words.select("word", F.col("n").cast("long").alias("n")), "words")
    near = materialise(neighbours(words, shard, cap), "near")
    x = words.join(near, "word", "left").withColumn("ok", F.col("best_n") >= ratio * F.col("n"))
    x = materialise(x.select("word", F.when(F.col("ok"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("ok"), F.col("best_n")).alias("form_n")), "variants")
    to = roots(x.where("form is not null"))
    return x.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelled(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of all texts, texts damaged as `vocabulary` says.

    Null and empty texts have no words, repeated rows count as often as they are there, an id that is null counts as
    the empty text, other columns are left out, and no rows give none.
    """
    return grouped(vocabulary(docs))


#: Near words by what is left of them without one code point: those left alike at one place, or equal to a word.
SQL = r"""
    WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v FROM range(256) r(i))),
    runs AS (SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{7,}')) AS run FROM documents) GROUP BY ALL),
    hashed AS (SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(b)), lambda i: ('0x' || substr(hex(b), (2 * i + 1)::INT, 2))::BIGINT)), lambda c, b: xor(t[((xor(c, b) & 255) + 1)::INT], c >> 8))) AS h FROM (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b FROM runs), tab),
    words AS (SELECT word, sum(times)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, times FROM hashed) WHERE len(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
    less AS (SELECT word, n, i, word[1:i] || word[i + 2:] AS cut FROM (SELECT word, n, unnest(range(len(word))) AS i FROM words)),
    near AS (SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
      UNION SELECT less.word, w.word, w.n FROM less JOIN words w ON cut = w.word
      UNION SELECT w.word, less.word, less.n FROM less JOIN words w ON cut = w.word),
    best AS (SELECT word, count(*) AS n_near, min({'k': -n, 'w': other}) AS b FROM near GROUP BY word),
    forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.k >= 10 * n THEN b.w END AS form, CASE WHEN -b.k >= 10 * n THEN -b.k END AS form_n FROM words LEFT JOIN best USING (word)),
    ways(word, root) AS (SELECT word, word FROM forms UNION ALL SELECT ways.word, form FROM ways JOIN forms ON forms.word = root WHERE form IS NOT NULL)
    SELECT forms.word, forms.form, root, forms.n, forms.n_near, forms.form_n FROM forms JOIN ways ON ways.word = forms.word JOIN forms f ON f.word = root AND f.form IS NULL
"""
