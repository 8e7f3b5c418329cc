"""Alignment of two tokenizers over a corpus.

Both tokenizers cut the same bytes, a space and the text. Where both end a token,
a group ends; tokens whose bytes overlap are linked. How many documents hold a
pair of ids linked is counted over the whole corpus, and every document learns
the counts of its own links.

A task encodes its documents in chunks. The pairs of a chunk, each with the
documents that hold it, are sorted by the first id (in a mixed order) and cut by
its leading bits into radixes: for each radix a run of zstd frames, pairs and
counts in one list of frames, documents in another. The runs are written to a
table once. Runs of one radix go to one or more parts, by the records they hold, so
that a part has a bounded size however often a pair occurs.

Counting merges the runs of a part by a heap of their frames; parts are added up
by pair, and the highest count of each first id is found among the sums. A second
merge of the same runs, in the same order, meets the sums of its pairs and streams
what each document gets back to its chunk, where it is added up.
"""

from __future__ import annotations

import heapq
import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import Encoder, vocabulary
from tagloom.sources.sinks import materialise

RADIX_BITS = 5
CHUNK_RECORDS = 1 << 21  # pairs of a chunk, each document's counted; a document is never split
CHUNK_DOCS = 1 << 16
PART_RECORDS = 1 << 22
FRAME_RECORDS = 1 << 16
_LINKS = 1 << 20  # links that are worked on at once
_CACHE = 200_000
_SPREAD = 0x9E3779B1  # odd: multiplying by it permutes the ids

FOUND = (
    "chunk bigint, place int, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "radix int, records bigint, heads array<binary>, tails array<binary>"
)


class ByteLevel:
    """Ids of a byte-level vocabulary (a file of the tokenizers library); names of special tokens are plain text."""

    def __init__(self, path: str):
        self.encode = Encoder(path)
        self.encode.whole.encode_special_tokens = True
        self.encode.special = []
        entries = self.encode.whole.get_vocab(with_added_tokens=True)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        self.bytes = [b""] * (max(entries.values()) + 1)
        for name, i in entries.items():
            self.bytes[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.whole_bytes = set(byte) <= set(entries)

    def __call__(self, text: str, data: bytes) -> np.ndarray | None:
        """Ids of a text that starts with a space, None if their bytes are not ``data``."""
        ids = np.frombuffer(self.encode(text), "<u4")
        if self.whole_bytes and self.sizes[ids].sum() == len(data):  # merging bytes changes none
            return ids
        return ids if b"".join(map(self.bytes.__getitem__, ids.tolist())) == data else None


class Pieces:
    """Ids of a sentencepiece model that puts a space before every text.

    If no piece has anything but spaces before a space, and none a line feed, what
    lies between them is encoded on its own, once, and looked up from then on.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.space = names.index("▁") if "▁" in names else None
        apart = self.space is not None and not any("▁" in n.lstrip("▁") or "\n" in n for n in names)
        self.split = re.compile(r" +[^ \n]*|\n+[^ \n]*").findall if apart else None
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def _whole(self, text: str) -> list[int]:
        return self.model.encode(text[1:])

    def _unit(self, unit: str) -> bytes | None:
        if unit == " ":
            ids = [self.space]
        elif unit[0] == " ":
            ids = self._whole(unit)
        else:
            ids = self.model.encode(unit)
            if ids[:1] != [self.space]:
                return None
            ids = ids[1:]
        return array("I", ids).tobytes() if b"".join(map(self.bytes.__getitem__, ids)) == unit.encode() else None

    def __call__(self, text: str, data: bytes) -> np.ndarray | None:
        if self.split is not None:
            units, known = self.split(text), self.known
            fresh = set(units).difference(known)
            if fresh:
                if len(known) > _CACHE:
                    self.older, self.known = known, {}
                    known = self.known
                    fresh = set(units)
                older = self.older
                for u in fresh:
                    known[u] = older[u] if u in older else self._unit(u)
            codes = list(map(known.__getitem__, units))
            if None not in codes:
                return np.frombuffer(b"".join(codes), "<u4")
        ids = self._whole(text)
        return np.array(ids, np.uint32) if b"".join(map(self.bytes.__getitem__, ids)) == data else None


def tokenizers(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    """The two tokenizers of this worker process, which keep what they have learned for the tasks that follow."""
    held = sys.modules.setdefault("_aligners_of_worker", types.ModuleType("_aligners_of_worker")).__dict__
    if (a, b) not in held:
        held[a, b] = ByteLevel(a), Pieces(b)
    return held[a, b]


class Aligner:
    """Groups and links of documents given as ids of both tokenizers."""

    def __init__(self, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.sizes = sizes_a, sizes_b
        self.bits = [max(1, int(len(s) - 1).bit_length()) for s in self.sizes]
        if sum(self.bits) > 47:
            raise ValueError("the two vocabularies have too many pairs of ids")
        ends = (b",", b"|"), (b",", b";")
        self.names = [str(i).encode() + e for s, both in zip(self.sizes, ends) for i in range(len(s)) for e in both]

    def mixed(self, a: np.ndarray) -> np.ndarray:
        return a.astype(np.uint64) * np.uint64(_SPREAD) & np.uint64((1 << self.bits[0]) - 1)

    def unmixed(self, a: np.ndarray) -> np.ndarray:
        inverse = pow(_SPREAD, -1, 1 << self.bits[0])
        return (a.astype(np.uint64) * np.uint64(inverse) & np.uint64((1 << self.bits[0]) - 1)).astype(np.int64)

    def __call__(self, docs_a: list[np.ndarray], docs_b: list[np.ndarray], first: int):
        """Numbers of groups and links and the written groups of each document; keys (pair, document) with how often."""
        n_a, n_b = (np.array([len(d) for d in docs]) for docs in (docs_a, docs_b))
        a, b = np.concatenate(docs_a), np.concatenate(docs_b)
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.concatenate([end_a, end_b])
        ends.sort(kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])]
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        common = (end_a[at_a] == ends) & (end_b[at_b] == ends)
        owner = np.repeat(np.arange(len(n_a)), n_a)
        doc = owner[at_a]
        links, groups = np.bincount(doc, minlength=len(n_a)), np.bincount(doc[common], minlength=len(n_a))

        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[at_a[common]] = last_b[at_b[common]] = True
        before_b = np.append(0, at_b[common] + 1)[np.cumsum(last_a) - last_a]
        upto_a = (at_a[common] + 1)[np.cumsum(last_b) - last_b]
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + before_b] = a.astype(np.int64) * 2 + last_a
        code[np.arange(len(b)) + upto_a] = (len(self.sizes[0]) + b.astype(np.int64)) * 2 + last_b
        names = list(map(self.names.__getitem__, code.tolist()))
        edges = np.append(0, np.cumsum(n_a + n_b)).tolist()
        written = [b"".join(names[s:e])[:-1] for s, e in zip(edges, edges[1:])]

        pair = self.mixed(a[at_a]) << np.uint64(self.bits[1]) | b[at_b].astype(np.uint64)
        key = pair << np.uint64(16) | (doc + first).astype(np.uint64)
        key.sort()
        fresh = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        return n_a, n_b, groups, links, written, key[fresh], np.diff(np.append(fresh, len(key)))


def _squeeze(*columns: np.ndarray) -> bytes:
    """Columns of integers from 0 as one zstd frame: the lowest byte of all numbers, the next one, up to the highest in use."""
    head, body = [], b""
    for c in columns:
        used = (int(c.max(initial=0)).bit_length() + 7) // 8
        head += [len(c), used]
        body += np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :used].T).tobytes()
    return np.array([len(body), *head], "<u4").tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _expand(frame: bytes, columns: int) -> list[np.ndarray]:
    length, *head = np.frombuffer(frame, "<u4", 2 * columns + 1).tolist()
    body = np.frombuffer(pa.decompress(frame[8 * columns + 4 :], length, codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for n, used in zip(head[::2], head[1::2]):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :used] = body[at : at + n * used].reshape(used, n).T
        out.append(wide.view("<u8").ravel().astype(np.int64))
        at += n * used
    return out


def write_runs(key: np.ndarray, times: np.ndarray, shift: int) -> Iterator[tuple[int, int, list[bytes], list[bytes]]]:
    """Sorted keys (pair, 16 bits of document) as runs: radix (the pair's bits from ``shift`` on), records, frames."""
    pair = key >> np.uint64(16)
    radix = (pair >> np.uint64(shift)).astype(np.int64)
    edges = np.append(np.flatnonzero(np.append(True, radix[1:] != radix[:-1])), len(key)) if len(key) else []
    for s, e in zip(edges[:-1], edges[1:]):
        start = s + np.flatnonzero(np.append(True, pair[s + 1 : e] != pair[s : e - 1]))
        sizes = np.diff(np.append(start, e))
        frame = (np.cumsum(sizes) - sizes) // FRAME_RECORDS
        cuts = np.append(np.flatnonzero(np.append(True, frame[1:] != frame[:-1])), len(start))
        heads, tails = [], []
        for f, t in zip(cuts[:-1], cuts[1:]):
            lo, hi = start[f], start[t] if t < len(start) else e
            own = pair[start[f:t]]
            doc = (key[lo:hi] & np.uint64(0xFFFF)).astype(np.int64)
            step = np.diff(doc, prepend=0)
            step[start[f:t] - lo] = doc[start[f:t] - lo]  # within a pair documents rise
            heads.append(_squeeze(np.diff(own, prepend=np.uint64(0)), sizes[f:t]))
            tails.append(_squeeze(step, times[lo:hi]))
        yield int(radix[s]), int(e - s), heads, tails


def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[list[tuple[int, tuple, object]]]:
    """Merge runs of blocks (columns, the first of them sorted pairs, and what belongs to the block) by a heap.

    Gives lists of (run, columns, what belongs to them), cut so that all rows of a
    pair come in one list and lists rise by pair. One block of each run is held.
    """
    heap, ends = [], []  # runs by the first and by the last pair of their block
    held: dict[int, tuple] = {}

    def load(i: int) -> None:
        block = next(runs[i], None)
        if block is not None:
            held[i] = block
            heapq.heappush(heap, (int(block[0][0][0]), i))
            heapq.heappush(ends, (int(block[0][0][-1]), i))

    for i in range(len(runs)):
        load(i)
    while heap:
        limit, out, used = ends[0][0], [], []
        while heap and heap[0][0] <= limit:
            used.append(heapq.heappop(heap)[1])
        for i in used:
            columns, more = held.pop(i)
            n = int(np.searchsorted(columns[0], limit, "right"))
            out.append((i, tuple(c[:n] for c in columns), more))
            if n < len(columns[0]):
                held[i] = tuple(c[n:] for c in columns), more
                heapq.heappush(heap, (int(columns[0][n]), i))
        while ends and ends[0][0] <= limit:
            load(heapq.heappop(ends)[1])
        yield out


def _heads(frames: list[bytes]) -> Iterator[tuple]:
    for f in frames:
        steps, sizes = _expand(f, 2)
        yield (np.cumsum(steps), sizes), None


def _sums(pairs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, values = pairs[order], values[order]
    fresh = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    return pairs[fresh], np.add.reduceat(values, fresh)


def _count_part(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Documents of each pair in the runs of one part."""
    heads = [_heads(frames) for frames in table.column("heads").to_pylist()]
    counted = [_sums(*(np.concatenate(c) for c in zip(*(block for _, block, _ in blocks)))) for blocks in merge_runs(heads)]
    pair, n = (np.concatenate(c) for c in zip(*counted))
    same = [pa.array(np.full(len(pair), k.as_py()), t) for k, t in zip(key, (pa.int32(), pa.int64()))]
    return pa.Table.from_arrays([*same, pa.array(pair), pa.array(n)], ["radix", "part", "pair", "n"])


def _give_back(key: tuple[pa.Scalar, ...], runs: pa.Table, sums: pa.Table) -> pa.Table:
    """For each chunk with a run in the part, what its documents get from the part's pairs."""
    chunks, docs = runs.column("chunk").to_pylist(), runs.column("docs").to_pylist()
    best_links, totals = ([np.zeros(n, np.int64) for n in docs] for _ in range(2))
    pair, total, best = (sums.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "total", "best"))
    order = np.argsort(pair)
    pair, total, best = pair[order], total[order], best[order]

    def blocks(heads: list[bytes], tails: list[bytes]) -> Iterator[tuple]:
        for ((pairs, sizes), _), tail in zip(_heads(heads), tails):
            step, times = _expand(tail, 2)
            start = np.cumsum(sizes) - sizes
            run = np.cumsum(step)
            doc = run - np.repeat(run[start] - step[start], sizes)
            yield (pairs, sizes, start), (doc, times)

    own = [blocks(h, t) for h, t in zip(runs.column("heads").to_pylist(), runs.column("tails").to_pylist())]
    for merged in merge_runs(own):
        for run, (pairs, sizes, start), (doc, times) in merged:
            at = np.repeat(np.searchsorted(pair, pairs), sizes)
            some = slice(start[0], start[-1] + sizes[-1])
            np.add.at(totals[run], doc[some], times[some] * total[at])
            np.add.at(best_links[run], doc[some], times[some] * best[at])
    return pa.Table.from_arrays([
        pa.array(chunks, pa.int64()), pa.array([_squeeze(b, t) for b, t in zip(best_links, totals)], pa.binary())], ["chunk", "got"])


def _add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of a chunk's documents over all parts."""
    got = None
    for frame in table.column("got").to_pylist():
        one = _expand(frame, 2)
        got = one if got is None else [a + b for a, b in zip(got, one)]
    n = len(got[0])
    return pa.Table.from_arrays([
        pa.array(np.full(n, key[0].as_py()), pa.int64()), pa.array(np.arange(n), pa.int32()), pa.array(got[0]), pa.array(got[1]),
    ], ["chunk", "place", "n_best", "count_sum"])


def _runs_of(docs: DataFrame, a: str, b: str, digest: bool, chunk_records: int) -> DataFrame:
    """``FOUND``: a row for each document and one for each run. ``docs`` has ``id`` and ``t``."""
    schema = pa.schema([
        ("chunk", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
        ("groups", pa.string()), ("radix", pa.int32()), ("records", pa.int64()), ("heads", pa.list_(pa.binary())),
        ("tails", pa.list_(pa.binary())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        from pyspark import TaskContext

        first, second = tokenizers(a, b)
        aligner = Aligner(first.sizes, second.sizes)
        shift = max(0, sum(aligner.bits) - RADIX_BITS)
        chunk, place, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def rows(names, places, numbers, groups):
            return pa.RecordBatch.from_arrays([
                pa.array([chunk] * len(names), pa.int64()), pa.array(places, pa.int32()), pa.array(names, pa.int64()),
                *(pa.array(n, pa.int64()) for n in numbers), pa.array(groups, pa.string()), *(pa.nulls(len(names), schema.field(i).type) for i in range(8, 12)),
            ], schema=schema)

        def close():
            nonlocal chunk, place, held, size
            if held:
                key = np.concatenate([k for k, _ in held])
                times = np.concatenate([t for _, t in held])
                order = np.argsort(key, kind="stable")
                for radix, records, heads, tails in write_runs(key[order], times[order], shift):
                    yield pa.RecordBatch.from_pylist([{"chunk": chunk, "place": place, "radix": radix, "records": records, "heads": heads, "tails": tails}], schema=schema)
            chunk, place, held, size = chunk + 1, 0, [], 0

        def flush(names, ids_a, ids_b):
            nonlocal place, size
            n_a, n_b, groups, links, written, key, times = aligner(ids_a, ids_b, place)
            held.append((key, times))
            size += len(key)
            texts = [sha256(w).hexdigest() for w in written] if digest else [w.decode() for w in written]
            batch = rows(names, range(place, place + len(names)), (n_a, n_b, groups, links), texts)
            place += len(names)
            return batch

        names, ids_a, ids_b, tokens = [], [], [], 0
        for batch in batches:
            bare = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                spaced = f" {text}" if text else ""
                data = spaced.encode()
                one = first(spaced, data) if text else None
                two = second(spaced, data) if one is not None else None
                if two is None:
                    bare.append(name)
                    continue
                names.append(name)
                ids_a.append(one)
                ids_b.append(two)
                tokens += len(one) + len(two)
                if tokens >= _LINKS or place + len(names) >= CHUNK_DOCS:
                    yield flush(names, ids_a, ids_b)
                    names, ids_a, ids_b, tokens = [], [], [], 0
                    if size >= chunk_records or place >= CHUNK_DOCS:
                        yield from close()
            if bare:
                yield rows(bare, [None] * len(bare), [[0] * len(bare)] * 4, [""] * len(bare))
        if names:
            yield flush(names, ids_a, ids_b)
        yield from close()

    return docs.mapInArrow(run, FOUND)


def align(
    docs: DataFrame, a: str | None = None, b: str | None = None, id: str = "doc_id", text: str = "text", digest: bool = False,
    chunk_records: int = CHUNK_RECORDS, part_records: int = PART_RECORDS,
) -> DataFrame:
    """Align the tokens of byte-level vocabulary ``a`` (space and text) and sentencepiece model ``b`` (which adds the space).

    Returns for each row of ``docs``: ``id`` (a whole number or null), ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``groups`` (ids as in ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that), ``n_best`` (links whose pair has the
    highest count of its first id) and ``count_sum`` (counts added over links). A pair's count is the number of rows
    that hold it linked; a row that repeats counts again. Null and empty texts, and texts whose tokens do not give back
    their bytes, have no tokens: zeros and empty groups. Other columns are not read. An empty table gives no rows.
    """
    a, b = a or vocabulary("byte_bpe_50k.json"), b or vocabulary("piece_bpe_32k.model")
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("t"))
    found = materialise(_runs_of(rows, a, b, digest, chunk_records))
    back = _contributions(found.filter("radix IS NOT NULL"), _bits_of_second(b), part_records)
    own = found.filter("radix IS NULL").select("chunk", "place", "id", "n_a", "n_b", "n_groups", "n_links", "groups")
    zero = F.lit(0).cast("long")
    return own.join(back, ["chunk", "place"], "left").select(
        F.col("id").alias(id), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups")


def _bits_of_second(b: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return max(1, (SentencePieceProcessor(model_file=b).vocab_size() - 1).bit_length())


def _contributions(runs: DataFrame, bits: int, part_records: int) -> DataFrame:
    """``n_best`` and ``count_sum`` by ``chunk`` and ``place``; ``bits`` of a pair belong to its second id."""
    # at most one row for each radix
    parts = runs.groupBy("radix").agg(F.ceil(F.sum("records") / part_records).alias("parts"))
    placed = runs.select("chunk", F.col("place").alias("docs"), "radix", "heads", "tails").join(F.broadcast(parts), "radix").withColumn(
        "part", F.pmod(F.xxhash64("chunk"), F.col("parts"))).drop("parts")
    key = ["radix", "part"]
    partial = materialise(placed.select(*key, "heads").groupBy(*key).applyInArrow(_count_part, "radix int, part bigint, pair bigint, n bigint"))
    sums = partial.groupBy("pair").agg(F.sum("n").alias("total"))
    first = F.shiftright("pair", bits).alias("first")
    highest = sums.groupBy(first).agg(F.max("total").alias("highest"))
    judged = sums.withColumn("first", first).join(highest, "first").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
    known = partial.select(*key, "pair").join(judged, "pair")
    given = placed.groupBy(*key).cogroup(known.groupBy(*key)).applyInArrow(_give_back, "chunk bigint, got binary")
    return given.groupBy("chunk").applyInArrow(_add_up, "chunk bigint, place int, n_best bigint, count_sum bigint")
