"""Plain versions of the operators' contracts, one text at a time."""

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def contaminated(text, items, size=10):
    """Words, hit words, ids found."""
    w, hit, ids = words(text), set(), set()
    for item, body in items:
        b = words(body)
        if not b:
            continue
        n = min(size, len(b))
        windows = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)}
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                hit.update(range(k, k + n))
                if item is not None:
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    many = Counter(grams)
    covered = {p for k, g in enumerate(grams) if many[g] > 1 for p in (k, k + 1, k + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def fingerprint(text, width=4):
    w = SPACED.findall(lower(text))
    shingles = [" ".join(w[k : k + width]) for k in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, distance=4):
    """Component of each position: the smallest position that it reaches."""
    values = np.array(fingerprints, dtype=np.uint64)
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ values[k]) <= distance):
            a, b = find(k), find(k + 1 + int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]
