"""Fingerprints of the windows of token sequences, sampled by winnowing.

A window of ``width`` tokens is represented by its anchor: the run of ``gram``
tokens in it that hashes lowest, the leftmost of equals. The anchor's place in
the window depends on the window's content alone, so equal windows have equal
anchors at equal places, and consecutive windows mostly share one. A record
stands for all consecutive windows of an anchor: the anchor's hash, a hash of
everything those windows cover, the place of the first and their number.

Records with equal hashes stand for equal windows. Windows of which only the
anchors agree are left to a comparison of the windows themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.sources.sinks import materialise

_BASE = 0xD6E8FEB86659FD93
_GROUP = 1 << 18  # tokens taken at a time
_INDEX = np.uint64((1 << 20) - 1)
_SPACES = b" \t\n\r\x0b\x0c"
_PIECE = 1 << 20


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


class Powers:
    """Powers of the hash base and of its inverse, up to the length asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * _GROUP)
            steps = [np.full(size, np.uint64(b)) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
            for s in steps:
                s[0] = 1
            self.up, self.down = (np.cumprod(s, dtype=np.uint64) for s in steps)
        return self.up, self.down


class Rolling:
    """Hashes of any run of a token sequence, from running sums."""

    def __init__(self, tokens: np.ndarray, powers: Powers):
        up, self.down = powers(len(tokens))
        self.sums = np.empty(len(tokens) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(tokens * up[: len(tokens)], dtype=np.uint64, out=self.sums[1:])

    def all(self, n: int) -> np.ndarray:
        """Of the ``n`` tokens from each place."""
        found = self.sums[n:] - self.sums[:-n]
        found *= self.down[: len(found)]
        return found

    def some(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[first]) * self.down[first]


OTHER = np.uint64(0x632BE59BD9B4E019)  # for a second, independent hash
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_IS_SPACE = np.isin(np.arange(256), list(_SPACES))


def byte_tokens(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    return [_BYTE_VALUES[np.frombuffer(t, np.uint8)] for t in texts]


def word_tokens(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    """A hash for each word (between spaces and tabs to carriage returns) of each text."""
    found: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for t in texts:
        if len(t) > _PIECE:
            found += _words_together(group)
            found.append(np.concatenate(_words_together(_pieces(t))))
            group, size = [], 0
            continue
        group.append(t)
        size += len(t)
        if size > _PIECE:
            found += _words_together(group)
            group, size = [], 0
    return found + _words_together(group)


def _pieces(text: bytes) -> list[bytes]:
    """A long text cut at white space."""
    found, at = [], 0
    while len(text) - at > _PIECE:
        cut = max(text.rfind(bytes([s]), at, at + _PIECE) for s in _SPACES)
        if cut <= at:
            later = [c for s in _SPACES if (c := text.find(bytes([s]), at + _PIECE)) >= 0]
            cut = min(later, default=len(text))
        found.append(text[at:cut])
        at = cut
    return [*found, text[at:]]


def _words_together(texts: list[bytes]) -> list[np.ndarray]:
    if not texts:
        return []
    if sum(map(len, texts)) > 2 * _PIECE:
        return [w for t in texts for w in _words_together([t])] if len(texts) > 1 else _words_of(texts)
    return _words_of(texts)


def _words_of(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = np.concatenate([[False], ~_IS_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edges[::2], edges[1::2]
    sizes = end - first
    began = np.cumsum(sizes) - sizes
    letters = data[inside[1:-1]].astype(np.uint64)
    place = np.arange(len(letters)) - np.repeat(began, sizes)
    # a value for each letter at its place: unlike powers of one base, sums of these have no pattern
    values = mix(letters + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1))
    sums = np.add.reduceat(values, began) if len(began) else np.zeros(0, np.uint64)
    words = mix(sums + sizes.astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.split(words, np.searchsorted(first, ends[:-1]))


@dataclass
class Records:
    anchor: np.ndarray
    context: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    windows: np.ndarray

    def take(self, rows: np.ndarray) -> Records:
        return Records(*(getattr(self, f.name)[rows] for f in fields(self)))

    @staticmethod
    def join(parts: list[Records]) -> Records:
        return Records(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Records)))


def _scan(tokens: np.ndarray, sizes: np.ndarray, docs: np.ndarray, firsts: np.ndarray, width: int, gram: int, powers):
    """Records of stretches of tokens laid end to end; ``firsts``: where each stretch begins in its document."""
    ends = np.cumsum(sizes)
    rolled = Rolling(tokens, powers)
    grams = rolled.all(gram)
    keys = ((grams ^ (grams >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)) & ~_INDEX
    keys |= np.arange(len(keys), dtype=np.uint64)
    span, have = width - gram + 1, 1
    while 2 * have <= span:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    if have < span:
        keys = np.minimum(keys[: len(keys) - (span - have)], keys[span - have :])
    valid = np.ones(len(keys), bool)
    for end in ends[:-1]:
        valid[max(0, end - width + 1) : end] = False
    place = (keys & _INDEX).astype(np.int64)
    change = np.flatnonzero((place[1:] != place[:-1]) | (valid[1:] != valid[:-1])) + 1
    start = np.concatenate([[0], change])
    stop = np.concatenate([change, [len(keys)]])
    fine = valid[start]
    start, stop = start[fine], stop[fine]
    anchor = place[start]
    stretch = np.searchsorted(ends, start, side="right")
    count = stop - start
    context = rolled.some(start, stop - 1 + width)
    context = mix(context ^ (((anchor - start) << 32) + count).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    began = ends[stretch] - sizes[stretch]
    return Records(
        mix(grams[anchor]), context, docs[stretch], (start - began + firsts[stretch]).astype(np.int64), count
    )


def records(docs: np.ndarray, tokens: list[np.ndarray], width: int, gram: int, powers: Powers) -> Iterator[Records]:
    """Records of all windows of the documents. Long ones are taken in stretches that overlap by a window."""
    group: list[np.ndarray] = []
    owners: list[int] = []
    firsts: list[int] = []
    size = 0

    def scan() -> Records:
        return _scan(
            np.concatenate(group), np.array([len(g) for g in group]), np.array(owners, np.int64),
            np.array(firsts, np.int64), width, gram, powers,
        )

    for doc, own in zip(docs.tolist(), tokens):
        for first in range(0, len(own) - width + 1, _GROUP):
            group.append(own[first : first + _GROUP + width - 1])
            owners.append(doc)
            firsts.append(first)
            size += len(group[-1])
            if size >= _GROUP:
                yield scan()
                group, owners, firsts, size = [], [], [], 0
    if group:
        yield scan()


def union(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching stretches of each document as one, in order."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    fresh_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
    rank = np.cumsum(fresh_doc) - 1
    reach = np.maximum.accumulate(stop + rank * (1 << 40)) - rank * (1 << 40)
    fresh = fresh_doc | np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(doc) - 1]])
    return doc[fresh], start[fresh], reach[last]


SCHEMA = "key bigint, context bigint, doc bigint, start bigint, n bigint, done boolean"


def as_batch(key, context, doc, start, n, done: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), pa.array(doc), pa.array(start),
            pa.array(n.astype(np.int64)), pa.array(np.full(len(doc), done)),
        ],
        ["key", "context", "doc", "start", "n", "done"],
    )


def settle(found: Records, width: int) -> Iterator[pa.RecordBatch]:
    """Within one batch: the first record of each class goes on, what the others stand for is repeated for certain."""
    order = np.lexsort((found.start, found.doc, found.context, found.anchor))
    found = found.take(order)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (found.anchor[1:] != found.anchor[:-1]) | (found.context[1:] != found.context[:-1])
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(order) else np.zeros(0, np.int64)
    yield as_batch(*(getattr(found, n)[fresh] for n in ("anchor", "context", "doc", "start", "windows")), False)
    late = (found.doc != found.doc[first]) | (found.start != found.start[first])
    doc, start, stop = union(
        found.doc[late], found.start[late], found.start[late] + found.windows[late] + width - 1
    )
    yield as_batch(doc, np.zeros(len(doc), np.int64), doc, start, stop, True)


def sample(docs: DataFrame, tokens: Callable, width: int, gram: int, most: int = 1 << 18) -> DataFrame:
    """Records (``SCHEMA``) of ``docs`` with columns ``doc`` and ``text``.

    Rows with ``done`` are stretches ``start`` to ``n`` that are known to be
    repeated. Of equal records in one task's batch of ``most`` only the first
    goes on, so a passage that a third of all documents share arrives once a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                names = part.column(0).to_numpy(zero_copy_only=False)
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column(1)]
                for found in records(names, tokens(texts, powers), width, gram, powers):
                    held.append(found)
                    size += len(found.doc)
                    if size >= most:
                        yield from settle(Records.join(held), width)
                        held, size = [], 0
        if held:
            yield from settle(Records.join(held), width)

    return docs.select("doc", "text").mapInArrow(run, SCHEMA)


def numbered(docs: DataFrame, id: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc`` (in the order of the ids, which are whole numbers), ``text`` and the columns ``keep`` under the names c0, c1, ...

    ``doc`` is the id itself if ids are distinct and not null. Otherwise rows
    with one id are ordered by a hash of their texts (null ids come first), and
    rows with equal ids and texts share a number.
    """
    rows = docs.select(
        F.col(id).cast("long").alias("doc"), F.col(text).alias("text"),
        *[F.col(k).alias(f"c{i}") for i, k in enumerate(keep)],
    )
    if rows.filter(F.col("doc").isNull()).isEmpty() and rows.groupBy("doc").count().filter("count > 1").isEmpty():
        return rows
    hashed = rows.withColumn("h", F.xxhash64("text"))
    order = hashed.select("doc", "h").distinct().orderBy(F.col("doc").asc_nulls_first(), "h")
    number = materialise(order.select(F.col("doc").alias("d"), F.col("h").alias("h2"), F.monotonically_increasing_id().alias("n")))
    return hashed.join(number, F.col("doc").eqNullSafe(F.col("d")) & (F.col("h") == F.col("h2"))).select(
        F.col("n").alias("doc"), "text", *[f"c{i}" for i in range(len(keep))]
    )
