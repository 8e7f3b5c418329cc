"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

SPACES = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text, shingle=3):
    words = re.findall(SPACES, lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(points, near):
    """Root number of each point when all pairs that are ``near`` are linked."""
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if near(points[i], points[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def repeats(sequences, width):
    """For each sequence, which places are covered by a window that starts earlier too."""
    seen, found = set(), []
    for tokens in sequences:
        covered = [False] * len(tokens)
        for j in range(len(tokens) - width + 1):
            window = tuple(tokens[j : j + width])
            if window in seen:
                covered[j : j + width] = [True] * width
            seen.add(window)
        found.append(covered)
    return found


def runs(covered):
    edges = [i for i in range(len(covered) + 1) if (covered[i - 1] if i else False) != (covered[i] if i < len(covered) else False)]
    return list(zip(edges[::2], edges[1::2]))


def contamination(text, items, window=13):
    words = re.findall(ALNUM, lower(text or ""))
    hit, names = set(), set()
    for name, item in items:
        own = re.findall(ALNUM, lower(item or ""))
        size = min(window, len(own))
        for i in range(max(0, len(own) - size + 1) if own else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[i : i + size]:
                    hit.update(range(at, at + size))
                    if name is not None:
                        names.add(str(name))
    return len(words), len(hit), sorted(names)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
