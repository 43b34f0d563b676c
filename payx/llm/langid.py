"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds a sample of its labelled text. A text is parsed against it greedily: each
phrase is the longest match from where the last one ended, or one unseen character. Phrases per character estimate
the cross-entropy; the language that needs fewest phrases wins.

A greedy parse only walks forward in the automaton, whose transitions lie in one table (see `displaced`). Texts are cut
into segments of SEGMENT characters that are parsed side by side, one character of every segment at a time. A segment
starts with a phrase of its own; then the parse of the segment before is carried on into it until both start a phrase
at one character, from which on they agree, so the number of phrases is exactly that of one parse over the whole text.
Text is put in lower case, and every run of other than letters becomes one blank.

Learning is bounded by the number of labelled rows: of every language the DOCS rows with the smallest hash of their id
make the sample and the next CHECKS the limit of its rate, or fewer in equal parts where all languages together would
have over ALL_DOCS; of each row PIECES windows of WIDTH characters are taken, spread over the whole text. There is no
bound on the number of languages.

Null and empty texts, and those without a letter, are `und`. Repeated rows are judged alike, each; only the text, and
for learning the id and lang, are looked at, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payx.llm.common import small_batches, spread_windows

DOCS, CHECKS, ALL_DOCS, PIECES, WIDTH = 96, 32, 20_000, 2, 160
SEGMENT = 384
UNKNOWN = "und"
#: Texts with more phrases after the first for each letter than the winning language's limit are in none of the learned
#: languages. The limit is MARGIN times the highest rate among the language's own rows that were kept for it, at least
#: LEAST_LIMIT.
LEAST_LIMIT, MARGIN = 0.45, 1.25
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}").search


class Sample(NamedTuple):
    """What is known of a language: normal text, and the highest rate of a text in it."""

    lang: str
    text: str
    limit: float = LEAST_LIMIT


def normal(text: str | None) -> str:
    """Lower case, every run of other than letters and their marks one blank; empty if there is no letter."""
    if not text:
        return ""
    out = _OTHER.sub(" ", text.lower()).strip()
    return out if _LETTER(out) else ""


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the states of the suffix automaton of text; state 0 is the root."""
    go, link, length = [{}], [-1], [0]
    last = 0
    for c in text:
        cur = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return go


def displaced(go: list[dict[str, int]], code: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(place of each state, table): the transition of state s by character c is table[place[s] + code[c]].

    An entry is the state it belongs to, times 2**32, plus the next state; one of another state, or -1, means that
    there is no transition. States with most transitions are placed first, each where all of its entries are free. The
    root, state 0, has no entries.
    """
    room = 1 << (2 * sum(map(len, go)) + 64).bit_length()
    taken, place, entries = bytearray(room + len(code) + 1), np.zeros(len(go), np.int64), []
    for s in sorted(range(1, len(go)), key=lambda s: -len(go[s])):
        codes, at = [code[c] for c in go[s]], s * 0x9E3779B1 % room
        for _ in range(200):
            if not any(taken[at + c] for c in codes):
                break
            at = (at + 2 * s + 1) % room
        else:  # beyond what is in use so far
            at = len(taken)
            taken.extend(bytes(len(code) + 1))
        place[s] = at
        for c, t in zip(codes, go[s].values(), strict=True):
            taken[at + c] = 1
            entries.append((at + c, s << 32 | t))
    table = np.full(len(taken), -1, np.int64)
    if entries:
        at, value = zip(*entries, strict=True)
        table[list(at)] = value
    return place, table


class Parser:
    """Counts the phrases of many texts at once."""

    def __init__(self, samples: tuple[Sample, ...]):
        self.langs = [s.lang for s in samples]
        letters = sorted({c for s in samples for c in s.text} | {" "})
        top = max(map(ord, letters)) + 1
        self.code = np.zeros(top + 1, np.int64)  # 0: a character of no sample
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        at = {c: i for i, c in enumerate(letters, 1)}
        self.automata = []
        for sample in samples:
            go = suffix_automaton(sample.text)
            root = np.zeros(len(letters) + 1, np.int64)
            for c, s in go[0].items():
                root[at[c]] = s
            self.automata.append((root, *displaced(go, at)))

    def codes(self, text: str) -> np.ndarray:
        x = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return self.code[np.minimum(x, len(self.code) - 1)]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """(text, language) -> number of phrases; texts are normal."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        start = 0
        while start < len(texts):
            stop, room = start, 0
            while stop < len(texts) and (stop == start or room < 500_000):
                room += len(texts[stop])
                stop += 1
            self._some(texts[start:stop], out[start:stop])
            start = stop
        return out

    def _some(self, texts: list[str], out: np.ndarray) -> None:
        sizes = np.array([len(t) for t in texts])
        lanes = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), lanes)
        if not len(owner):
            return
        flat = self.codes("".join(texts))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = begin[owner] + place * SEGMENT
        length = np.minimum(begin[owner + 1] - first, SEGMENT)
        order = np.argsort(-length, kind="stable")
        live = np.searchsorted(-length[order], -np.arange(int(length.max())), "left")  # lanes longer than i
        step = np.minimum(first[order][None, :] + np.arange(len(live))[:, None], len(flat) - 1)
        codes = flat[step]  # a row for each place in a segment, a column for each lane
        lane = np.empty_like(order)
        lane[order] = np.arange(len(order))
        later = np.flatnonzero(place > 0)  # segments that have one before them
        segments = _Segments(codes, live, length[order], lane[later - 1], lane[later])
        for k, automaton in enumerate(self.automata):
            out[:, k] += np.bincount(owner[order], segments.phrases(*automaton), minlength=len(out)).astype(np.int64)


class _Segments:
    """Segments as columns of codes, `live[i]` of them longer than i; those in `after` follow those in `before`."""

    def __init__(self, codes: np.ndarray, live: np.ndarray, length: np.ndarray, before: np.ndarray, after: np.ndarray):
        self.codes, self.live, self.length, self.before, self.after = codes, live, length, before, after
        self.following = np.full(len(length), -1)
        self.following[before] = after

    def phrases(self, root: np.ndarray, place: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Phrases that start in each segment, as if all of a text were one."""
        state = np.zeros(len(self.length), np.int64)
        starts = np.zeros(self.codes.shape, bool)
        for i, n in enumerate(self.live):
            state[:n], starts[i, :n] = _step(state[:n], self.codes[i, :n], root, place, table)
        count = starts.sum(0)
        extra = np.zeros(len(count), np.int64)
        lane, now = self.after, state[self.before]
        while len(lane):
            lane, now = self._carry(lane, now, state, starts, extra, (root, place, table))
        return count + extra

    def _carry(self, lane, now, state, starts, extra, automaton):
        """Carry parses that end before some segments on into them: extra phrases there, and what is to do after that."""
        again = []
        extra[lane] = 0
        for i in range(len(self.codes)):
            over = self.length[lane] <= i
            if over.any():  # they never met; what follows has another parse before it if the state differs
                again.append((lane[over], now[over]))
                lane, now = lane[~over], now[~over]
            if not len(lane):
                break
            now, start = _step(now, self.codes[i, lane], *automaton)
            own = starts[i, lane]
            extra[lane] += start.astype(np.int64) - own
            apart = ~(start & own)
            lane, now = lane[apart], now[apart]
        again.append((lane, now))
        lane, now = np.concatenate([x for x, _ in again]), np.concatenate([x for _, x in again])
        other = (now != state[lane]) & (self.following[lane] >= 0)
        state[lane[other]] = now[other]
        return self.following[lane[other]], now[other]


def _step(state, code, root, place, table):
    """(next state, whether a phrase starts) for a character each."""
    entry = table[place[state] + code]
    start = (entry >> 32) != state
    return np.where(start, root[code], entry & 0xFFFFFFFF), start


@lru_cache(1)
def _parser(samples: tuple[Sample, ...]) -> Parser:
    return Parser(samples)


def learn(docs: DataFrame, key: str = "doc_id") -> tuple[Sample, ...]:
    """What is known of each language, from the rows of docs with text and lang; small, by the bounds above.

    Of rows with equal ids and texts one counts. Ties of the id's hash go by id, then by the windows drawn.
    """
    small_batches(docs)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    langs = rows.select("lang").distinct().count()
    most = max(1, min(DOCS + CHECKS, ALL_DOCS // max(langs, 1)))
    by = lambda *more: Window.partitionBy("lang").orderBy("h", *more)
    # The rows are found from their ids alone, and their texts then read.
    ids = rows.select("lang", F.xxhash64(key).alias("h"), F.col(key).alias("id"))
    ids = ids.withColumn("r", F.row_number().over(by("id"))).where(F.col("r") <= most).groupBy("lang").agg(F.max(F.struct("h", "id")).alias("last"))
    last = F.broadcast(ids.select(F.col("lang").alias("l"), F.col("last.h").alias("top")))
    near = rows.select("lang", F.xxhash64(key).alias("h"), F.col(key).alias("id"), "text").join(last, F.col("lang") == F.col("l")).where("h <= top")
    drawn = near.select("lang", "h", "id", spread_windows(F.col("text"), PIECES, WIDTH).alias("w")).dropDuplicates(["lang", "h", "id", "w"])
    drawn = drawn.withColumn("r", F.row_number().over(by("id", "w"))).where(F.col("r") <= most).select("lang", "r", "w").collect()
    text: dict[str, list[list[str]]] = {}
    for r in sorted(drawn, key=lambda r: (r["lang"], r["r"])):
        text.setdefault(r["lang"], []).append([normal(w) for w in r["w"]])
    samples, checks = [], []
    for lang, rows_ in sorted(text.items()):
        used = -(-len(rows_) * DOCS // (DOCS + CHECKS))
        sample = " ".join(w for row in rows_[:used] for w in row if w)
        if sample.strip():
            samples.append(Sample(lang, sample))
            checks.append([x for x in (" ".join(w for w in row if w) for row in rows_[used:]) if x])
    parser = Parser(tuple(samples)) if samples else None
    for k, own in enumerate(checks):
        if own:
            n = parser.phrases(own)[:, k]
            samples[k] = samples[k]._replace(limit=max(LEAST_LIMIT, MARGIN * float(np.max((n - 1) / [len(x) for x in own]))))
    return tuple(samples)


def judge(text: Column, samples: tuple[Sample, ...]) -> Column:
    """struct(lang_pred, score, rate, fits): score is how much fewer phrases the winner needs than the second (0 to 1),
    or 1 where only one language is known; rate is its phrases after the first for each character, and fits tells
    whether that is within its limit.

    A text that is null or has no letter is `und`, with score 0, a null rate, and does not fit. Ties go to the first
    language in order. Texts of any length are parsed whole.
    """
    limits = np.array([s.limit for s in samples])

    @F.pandas_udf("lang_pred string, score double, rate double, fits boolean")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(samples) if samples else None
        for part in parts:
            texts = [normal(t) for t in part]
            has = np.array([bool(t) for t in texts], bool)
            if parser is None:
                yield pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": np.zeros(len(texts)), "rate": [None] * len(texts), "fits": np.zeros(len(texts), bool)})
                continue
            n = parser.phrases(texts).astype(float)
            best = n.argmin(1)
            low = n[np.arange(len(n)), best]
            rest = n.copy()
            rest[np.arange(len(n)), best] = np.inf
            second = rest.min(1)
            score = np.where(np.isfinite(second), 1 - low / np.maximum(np.where(np.isfinite(second), second, 1), 1), 1.0)
            rate = np.maximum(low - 1, 0) / np.maximum([len(t) for t in texts], 1)
            yield pd.DataFrame({"lang_pred": np.where(has, np.array(parser.langs, object)[best], UNKNOWN), "score": np.where(has, score, 0.0), "rate": pd.Series(np.where(has, rate, np.nan)).astype("Float64").where(has), "fits": has & (rate <= limits[best])})

    return run(text)


def identify(docs: DataFrame, samples: tuple[Sample, ...], name: str = "language") -> DataFrame:
    """docs with a struct column (lang_pred, score, rate, fits)."""
    return docs.withColumn(name, judge(F.col("text"), samples))


def accept(language: str) -> Column:
    """Documents in one of the learned languages: with letters, and with no more phrases than such text has."""
    return F.col(f"{language}.fits")
