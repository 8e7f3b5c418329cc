"""Substring dedup by level-wise doubling.

Windows of a quarter of ``width`` words are counted first, then of half, then of
all of it; what is not repeated at one length is not looked at again. On the
lowest level the windows that winnowing picks are enough: every full window holds
one, at a place its content decides, and where that one is alone no full window
can be repeated. Where all the full windows around two of them agree at once (a
hash of the whole stretch), they are decided together. The rest are taken window
by window: those whose first half is repeated are extended to twice that length
and compared whole. No candidates are left after that: whatever is longer consists
of windows of full length.

Every comparison is one shuffle by hash and one pass over sorted rows that keeps
only the current group's first row, so a group may have any size; the hashes of
half and of full length travel together, so the last two levels share theirs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.repeats import resolve, unpack
from tagloom.llm.winnow import SCHEMA, Powers, Records, Rolling, mix, numbered, sample, settle, union, word_tokens
from tagloom.sources.sinks import materialise

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Pass:
    """State of a pass over rows sorted by key, context, document and start."""

    def __init__(self, width: int):
        self.width, self.key, self.context = width, None, None
        self.first = (0, 0)  # document and start of the current class's first row
        self.alone: tuple | None = None  # the only class of the current key so far: document, start, windows

    def __call__(self, key, context, doc, start, n):
        """Repeated stretches and open runs, as (doc, start, stop, key) arrays; key 0 with a mask for null."""
        size = len(key)
        fresh_key = np.concatenate([[key[0] != self.key], key[1:] != key[:-1]])
        fresh = fresh_key | np.concatenate([[context[0] != self.context], context[1:] != context[:-1]])
        at = np.maximum.accumulate(np.where(fresh, np.arange(size), -1))
        first_doc = np.where(at >= 0, doc[at], self.first[0])
        first_start = np.where(at >= 0, start[at], self.first[1])
        late = ~fresh & ((doc != first_doc) | (start != first_start))
        group = np.cumsum(fresh_key) - fresh_key[0]
        if fresh_key[0]:
            self.alone, several = None, False
        else:
            several = self.alone is None
        classes = np.bincount(group, fresh, group[-1] + 1).astype(np.int64)
        if not fresh_key[0]:
            classes[0] += 1 + several  # the class or classes of the batch before
        open_ = fresh & (classes[group] > 1)
        out_doc, out_start, out_n, out_key = doc[open_], start[open_], n[open_], key[open_]
        if not fresh_key[0] and not several and classes[0] > 1:
            d, s, w = self.alone
            out_doc, out_start = np.append(out_doc, d), np.append(out_start, s)
            out_n, out_key = np.append(out_n, w), np.append(out_key, key[0])
        if classes[-1] > 1:
            self.alone = None
        elif fresh_key[group == group[-1]].any() or group[-1] > 0:
            i = np.flatnonzero(group == group[-1])[0]
            self.alone = (doc[i], start[i], n[i])
        self.key, self.context = key[-1], context[-1]
        self.first = (first_doc[-1], first_start[-1])
        done = union(doc[late], start[late], start[late] + n[late] + self.width - 1)
        return done, (out_doc, out_start, out_n, out_key)


def compare_sorted(rows: DataFrame, width: int) -> DataFrame:
    """``doc``, ``start``, ``stop``, ``key`` (see ``resolve``) from records (``SCHEMA``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Pass(width)
        for batch in batches:
            key, context, doc, start, n, done = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield _stretches(doc[done], start[done], n[done], None)
            some = np.flatnonzero(~done)
            if len(some):
                late, (d, s, w, k) = state(key[some], context[some], doc[some], start[some], n[some])
                yield _stretches(*late, None)
                yield _stretches(d, s, w, k)

    spread = rows.repartition("key").sortWithinPartitions("key", "context", "doc", "start")
    return spread.mapInArrow(run, "doc bigint, start bigint, stop bigint, key bigint")


def _stretches(doc, start, stop, key) -> pa.RecordBatch:
    keys = pa.nulls(len(doc), pa.int64()) if key is None else pa.array(key, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), keys],
        ["doc", "start", "stop", "key"],
    )


def _single_windows(width: int):
    """A record for each window of the open runs of the documents given: the hash of its first half, and of all of it."""
    half = -(-width // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                docs = part.column(0).to_numpy(zero_copy_only=False)
                texts = [unpack(z, n.as_py()) for z, n in zip(part.column(1), part.column(2))]
                found = []
                for doc, tokens, runs in zip(docs, word_tokens(texts, powers), part.column(3)):
                    first = np.array([m["start"] for m in runs.as_py() if m["key"] is not None], np.int64)
                    count = np.array([m["stop"] for m in runs.as_py() if m["key"] is not None], np.int64)
                    places = np.unique(np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum()))
                    rolled = Rolling(tokens, powers)
                    found.append(Records(
                        mix(rolled.some(places, places + half)), mix(rolled.some(places, places + width)),
                        np.full(len(places), doc, np.int64), places, np.ones(len(places), np.int64),
                    ))
                if found:
                    yield from settle(Records.join(found), width)

    return run


def _cut(text: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[int, bytes]:
    words = text.split()
    if not len(start):
        return len(words), b" ".join(words)
    kept, at = [], 0
    for a, b in zip(start.tolist(), stop.tolist()):
        kept += words[at:a]
        at = b
    return len(words), b" ".join(kept + words[at:])


def _cut_in_layout(text: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[int, bytes]:
    """Kept words with the white space between them as it was; a space where words are missing."""
    if not len(start):
        return len(text.split()), text
    places = [m.span() for m in _WORD.finditer(text)]
    edges = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(places)]
    runs = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
    return len(places), b" ".join(text[places[a][0] : places[b - 1][1]] for a, b in runs)


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 20, keep: tuple[str, ...] = (),
    digest: bool = False, layout: bool = False,
) -> DataFrame:
    """Remove each word covered by ``width`` words in a row that also start earlier.

    Earlier is in a smaller id, or before in the same document; windows are judged
    on the input. Returns, for each row of ``docs``, ``doc_id``-like column ``id``,
    the columns ``keep``, ``n_words``, ``n_removed``, ``spans`` (removed runs, as
    word places from and up to) and ``kept``: the words kept, joined by single
    spaces, or with ``digest`` the SHA-256 of that text. With ``layout``, white space
    between kept words stays as it was, and texts that lose nothing are unchanged.

    A null text has no words, and words are what spaces and tabs to carriage
    returns divide. Rows that repeat an id are ordered by a hash of their text
    after rows without id; rows that repeat id and text count once and get equal
    results. Matches never cross rows. An empty table gives no rows.
    """
    rows = numbered(docs, id, text, (id, *keep))
    found = sample(rows, word_tokens, width, -(-width // 4))
    known = materialise(compare_sorted(found, width))

    def single(waiting: DataFrame) -> DataFrame:
        windows = waiting.select("doc", "z", "size", "marks").mapInArrow(_single_windows(width), SCHEMA)
        return compare_sorted(windows, width).filter(F.col("key").isNull())

    done = resolve(rows, known, _cut_in_layout if layout else _cut, digest, single)
    return done.select(
        F.col("c0").alias(id), *[F.col(f"c{i + 1}").alias(k) for i, k in enumerate(keep)], F.col("n").alias("n_words"),
        F.col("removed").alias("n_removed"), "spans", F.col("kept").cast("string").alias("kept"),
    )
