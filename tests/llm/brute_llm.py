"""Plain versions of the operators, over lists."""

from __future__ import annotations

import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_statistics(text):
    text = text or ""
    found = words(text)
    windows = Counter(zip(found, found[1:], found[2:]))
    repeated = {i + j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        len(repeated),
    )


def simhash(text, n=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = words(lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + n]) for i in range(max(1, len(found) - n + 1))]
    hashes = [xxhash.xxh64(s.encode("utf-8", "surrogatepass"), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance):
    """Smallest index reachable from each over links of at most ``distance`` bits."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def ngram_hashes(text):
    """Hashes of all words and pairs of a text, in Python's own integers."""
    limit = (1 << 64) - 1
    found = []
    for word in words(text):
        value, factor = 0, 1
        for byte in word.encode("utf-8", "surrogatepass"):
            value = (value + (byte + 1) * factor) & limit
            factor = factor * 0x9E3779B97F4A7C15 & limit
        found.append(value)
    found += [(a * 0xC2B2AE3D27D4EB4F + b) & limit for a, b in zip(found, found[1:])]
    out = []
    for value in found:
        value = (value ^ value >> 32) * 0xD6E8FEB86659FD93 & limit
        out.append(value ^ value >> 32)
    return out


def log_ratios(texts, target, buckets, prior):
    """Mean log ratio of target over raw probability of every text; ``target`` has the trusted places."""
    grams = [[h % buckets for h in ngram_hashes(t)] for t in texts]
    raw, own = Counter(), Counter()
    for i, found in enumerate(grams):
        raw.update(found)
        if i in target:
            own.update(found)
    whole, chosen = sum(raw.values()) or 1, sum(own.values())
    score = {b: math.log((own[b] + prior) / (chosen * n / whole + prior)) for b, n in raw.items()}
    return [sum(score[b] for b in found) / len(found) if found else 0.0 for found in grams]
