"""Token files of directly addressable codes.

Ids are cut into chunks of eight bits, lowest first. Level 0 has the first chunk
of every id, level 1 the second chunk of those ids that need one, and so on. A
bitmap for each level tells which of its ids go on, and a rank directory holds
the number of set bits before each block of 512, so the place of an id in the
next level is one directory entry and the bits of one block: any token is read
without decoding its neighbours.

A file holds whole documents in a row. Its layout, all little-endian:
magic ``DAC1``; counts of documents, ids and levels (8 bytes each); the start of
each document and the end of the last (8 bytes each); for each level the number
of its chunks (8 bytes), the chunks, the bitmap (least significant bit first)
and the directory (4 bytes an entry).

Files are rows of a table that Spark writes in the shared folder, so that a file
appears with the commit of its task and lives in any store Spark knows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.tokens import encoder
from tagloom.sources.sinks import scratch_path

BLOCK = 512
MAGIC = b"DAC1"
FILE_IDS = 1 << 20


def write_file(ids: np.ndarray, starts: np.ndarray) -> bytes:
    """The file of ``ids`` (32-bit) whose documents begin at ``starts``; the last entry is the number of ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.zeros(-(-len(rest) // BLOCK) * BLOCK, np.bool_)
        bits[: len(rest)] = more
        ranks = np.concatenate([[0], np.cumsum(bits.reshape(-1, BLOCK).sum(1))])[:-1].astype("<u4")
        levels.append(
            struct.pack("<q", len(rest)) + rest.astype(np.uint8).tobytes()
            + np.packbits(bits, bitorder="little").tobytes() + ranks.tobytes()
        )
        rest = rest[more] >> 8
        if not len(rest):
            break
    head = MAGIC + struct.pack("<qqq", len(starts) - 1, len(ids), len(levels))
    return b"".join([head, starts.astype("<i8").tobytes(), *levels])


class Reader:
    """Random access to the tokens of a file."""

    def __init__(self, file: bytes):
        if file[:4] != MAGIC:
            raise ValueError("not a token file")
        docs, self.size, levels = struct.unpack_from("<qqq", file, 4)
        at = 28
        self.starts = np.frombuffer(file, "<i8", docs + 1, at)
        at += 8 * (docs + 1)
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<q", file, at)
            blocks = -(-n // BLOCK)
            chunks = np.frombuffer(file, np.uint8, n, at + 8)
            bits = np.frombuffer(file, np.uint8, blocks * BLOCK // 8, at + 8 + n)
            at += 8 + n + len(bits)
            self.levels.append((chunks, bits, np.frombuffer(file, "<u4", blocks, at)))
            at += 4 * blocks

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place ``i``."""
        _, bits, ranks = self.levels[level]
        if i // BLOCK == len(ranks):
            i, extra = i - 1, int(bits[(i - 1) // 8] >> (i - 1) % 8 & 1) if i else 0
            return self._rank(level, i) + extra if i >= 0 else 0
        block = i // BLOCK * BLOCK // 8
        whole = int(np.bitwise_count(bits[block : i // 8]).sum())
        return int(ranks[i // BLOCK]) + whole + (int(bits[i // 8]) & ((1 << i % 8) - 1)).bit_count()

    def token(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not bits[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, first: int, end: int) -> np.ndarray:
        """Ids from ``first`` up to ``end``, touching only their own chunks."""
        found = np.zeros(end - first, "<u4")
        places = None  # of the ids that go on; at first all
        for level, (chunks, bits, _) in enumerate(self.levels):
            part = chunks[first:end].astype("<u4") << np.uint32(8 * level)
            low = first // 8
            more = np.unpackbits(bits[low : -(-end // 8)], bitorder="little")[first - low * 8 : end - low * 8] > 0
            if places is None:
                found |= part
                places = np.flatnonzero(more)
            else:
                found[places] |= part
                places = places[more]
            if not len(places):
                break
            first = self._rank(level, first)
            end = first + len(places)
        return found

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))

    def __len__(self) -> int:
        return len(self.starts) - 1


def write_corpus(
    docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", end_id: int = 0, file_ids: int = FILE_IDS,
    path: str | None = None,
) -> str:
    """Encode whole texts, end each with ``end_id``, and write files in ascending order of ``id``; returns their folder.

    Without ``path`` they go to the shared checkpoint folder, for this session only.

    Rows: ``part``, ``seq`` (files are in the order of both), ``ids`` (the document
    ids in the file), ``n_tokens``, ``file``. Null ids come first; rows that repeat
    an id are ordered by a hash of their text. A null text counts as empty. Files
    end with the document that reaches ``file_ids``, so only a single longer
    document makes a longer file. An empty table writes no files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        names, pieces, sizes, total = [], [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u4")
            file = write_file(ids, np.cumsum([0, *sizes]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()), pa.array([file], pa.binary()),
                ],
                ["part", "seq", "ids", "n_tokens", "file"],
            )

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                code = encode(value) + end
                names.append(name)
                pieces.append(code)
                sizes.append(len(code) // 4)
                total += sizes[-1]
                if total >= file_ids:
                    yield close()
                    seq += 1
                    names, pieces, sizes, total = [], [], [], 0
        if names:
            yield close()

    spark = docs.sparkSession
    order = [F.col("_id").asc_nulls_first(), F.col("_h")]
    rows = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_t"), F.xxhash64(text).alias("_h"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_t")
    path = path or scratch_path(spark)
    schema = "part int, seq int, ids array<bigint>, n_tokens bigint, file binary"
    ordered.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return path


def starts(files: DataFrame) -> DataFrame:
    """``part``, ``seq`` and ``first``: the number of ids in all files before each.

    The only window without a key runs over one row for each part.
    """
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    parts = sizes.select("part", so_far.alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return files.select("part", "seq", within.alias("within")).join(parts, "part").select(
        "part", "seq", (F.col("before") + F.col("within")).alias("first")
    )


def read_digests(files: DataFrame) -> DataFrame:
    """Each document read from its file: ``id``, ``start`` in the whole corpus, ``n_tokens``, ``crc32`` of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, names, file in zip(*batch.columns):
                reader = Reader(file.as_py())
                tokens, at = reader.tokens(0, reader.size), reader.starts.tolist()  # all are wanted: one pass over the file
                codes = [zlib.crc32(tokens[a:b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * len(reader), pa.int32()), pa.array([seq.as_py()] * len(reader), pa.int32()),
                        names.values, pa.array(reader.starts[:-1], pa.int64()), pa.array(np.diff(reader.starts), pa.int64()),
                        pa.array(codes, pa.int64()),
                    ],
                    ["part", "seq", "id", "at", "n_tokens", "crc32"],
                )

    schema = "part int, seq int, id bigint, at bigint, n_tokens bigint, crc32 bigint"
    read = files.select("part", "seq", "ids", "file").mapInArrow(run, schema)
    return read.join(starts(files.select("part", "seq", "n_tokens")), ["part", "seq"]).select(
        "id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "crc32"
    )
