"""Plain Python versions of the training-data operators."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, width):
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def near_duplicates(docs, width, percent):
    """[(doc_id, text)] -> {doc_id: (n_shingles, component_id)}; ids are distinct."""
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for group in by.values():
        for a in group:
            for b in group:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        x, y = find(a), find(b)
                        parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(docs):
    """[(doc_id, text)] -> {doc_id: (n_chars, sha256 of the edited text, the edited text, the next id)}; ids are distinct."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for k, (i, text) in enumerate(order):
        text, (following, after) = text or "", order[(k + 1) % len(order)]
        cut = len(text) // 3
        new = text[: len(text) - cut] + (after or "")[:cut]
        out[i] = (len(text), hashlib.sha256(new.encode()).hexdigest(), new, following)
    return out


def base_rules(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    places = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(places) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places), failed


def id_index(docs, encode, end_id=2):
    """[(doc_id, text)] -> {doc_id: (start, n_tokens, crc32)}."""
    start, out = 0, {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        ids = [*encode(text or ""), end_id]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        out[i] = (start, len(ids), zlib.crc32(raw))
        start += len(ids)
    return out
