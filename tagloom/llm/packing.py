"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest sequence are cut into pieces. Groups of about
equal weight are packed on their own; their number grows with the corpus, so no
task sees more than one group at a time. In a group, pieces go from the longest
to the shortest into the open bin with the least room that still holds them. A
piece that fits nowhere opens a new bin of the permitted length that promises the
least cost per token: each length is filled, for trial, with the longest pieces
still to come that fit, downsized, and its cost divided by its tokens. At the end
every bin is downsized to the smallest permitted length that holds its contents.

As a trial fill does not know which pieces older bins will take, the group is
also packed with bins of at least one fixed length, for each, and the packing of
the least total cost counts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import encoder
from tagloom.sources.sinks import materialise

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 64  # cost of a sequence beside its length
GROUP_WEIGHT = 1 << 24
_ROW_WEIGHT = 256


def pack(lengths: Sequence[int], capacities: Sequence[int], overhead: float) -> tuple[list[int], list[int], list[int]]:
    """Pack pieces given from the longest to the shortest: bin and offset of each, and the capacity of each bin."""
    best = None
    ways = [_least_cost(lengths, capacities, overhead), *(_at_least(c, lengths, capacities) for c in capacities)]
    for opened in ways:
        bins, offsets, used = best_fit(lengths, opened)
        sizes = downsized(used, capacities)
        cost = sum(sizes) + overhead * len(sizes)
        if best is None or cost < best[0]:
            best = cost, bins, offsets, sizes
    return best[1:]


def downsized(used: Sequence[int], capacities: Sequence[int]) -> list[int]:
    return [capacities[bisect_left(capacities, u)] for u in used]


def _at_least(least: int, lengths: Sequence[int], capacities: Sequence[int]) -> Callable[[int], int]:
    openable = [c for c in capacities if c >= least]
    return lambda at: openable[bisect_left(openable, lengths[at])]


def _least_cost(lengths: Sequence[int], capacities: Sequence[int], overhead: float) -> Callable[[int], int]:
    """The length of a new bin for the piece at a place; a trial takes about as many steps as a bin has pieces."""
    falling = [-n for n in lengths]
    end = bisect_left(falling, 0)  # pieces of length 0 fill nothing

    def opened(at: int) -> int:
        n = lengths[at]
        best_rate, best = None, capacities[bisect_left(capacities, n)]
        for capacity in capacities[bisect_left(capacities, max(n, 1)) :] if n else ():
            used, room, j = n, capacity - n, at + 1
            while room and (j := bisect_left(falling, -room, j, end) if j < end else end) < end:
                used, room, j = used + lengths[j], room - lengths[j], j + 1
            rate = (capacities[bisect_left(capacities, used)] + overhead) / used
            if best_rate is None or rate < best_rate:
                best_rate, best = rate, capacity
        return best

    return opened


def best_fit(lengths: Sequence[int], opened: Callable[[int], int]) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece and what each bin holds; ``opened`` gives the length of a new bin for a place."""
    rooms: list[int] = []  # sorted, each once
    with_room: dict[int, deque[int]] = {}  # bins, the first opened or refilled first
    bins, offsets, used = [], [], []
    for i, n in enumerate(lengths):
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            own = with_room[room].popleft()
            if not with_room[room]:
                del with_room[room], rooms[at]
        else:
            room, own = opened(i), len(used)
            used.append(0)
        bins.append(own)
        offsets.append(used[own])
        used[own] += n
        left = room - n
        if left not in with_room:
            insort(rooms, left)
            with_room[left] = deque()
        with_room[left].append(own)
    return bins, offsets, used


def token_counts(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", end: int = 1) -> DataFrame:
    """``id`` and ``n_tokens`` of each row: ids of the whole text and ``end`` more; a null text has none of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            counts = [len(encode(t.as_py())) // 4 + end for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["id", "n"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("t"))
    counted = rows.mapInArrow(run, rows.select("id").schema.add("n", "long"))
    return counted.select(F.col("id").alias(id), F.col("n").alias("n_tokens"))


def pack_documents(
    lengths: DataFrame, id: str = "doc_id", length: str = "n_tokens", capacities: Sequence[int] = CAPACITIES,
    overhead: float = OVERHEAD, group_weight: int = GROUP_WEIGHT,
) -> DataFrame:
    """Place every row of ``lengths`` (ids are whole numbers); a row longer than the largest capacity takes several pieces.

    Returns ``id``, ``piece`` (from 0), ``start`` (of the piece in its document),
    ``n_tokens``, ``bin``, ``capacity`` (of the bin) and ``offset`` (of the piece in
    the bin). Null and negative lengths count as 0, and pieces of length 0 take no
    room. Repeated rows are packed one by one, and equal lengths in the order of
    their ids. An empty table gives no rows. ``group_weight`` bounds the tokens and
    rows (at 256 each) of a group.
    """
    capacities = sorted(set(capacities))
    largest = capacities[-1]
    rows = materialise(lengths.select(
        F.col(id).cast("long").alias("id"), F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long").alias("n"),
        F.monotonically_increasing_id().alias("row"),
    ))
    weight = rows.agg(F.sum(F.col("n") + _ROW_WEIGHT)).first()[0] or 0
    groups = max(1, -(-int(weight) // group_weight))
    last = F.greatest((F.col("n") + largest - 1).cast("long"), F.lit(largest)) / largest
    pieces = rows.select("id", "n", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last) - 1)).alias("piece"))
    pieces = pieces.select(
        F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("long").alias("group"), "id", "row", "piece",
        (F.col("piece") * largest).alias("start"),
        F.least(F.col("n") - F.col("piece") * largest, F.lit(largest)).alias("n_tokens"),
    )

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "id", "row", "piece"], ascending=[False, True, True, True], ignore_index=True)
        bins, offsets, sizes = pack(rows["n_tokens"].tolist(), capacities, overhead)
        bins = np.array(bins, np.int64)
        return pd.DataFrame({
            "id": rows["id"].astype("Int64"), "piece": rows["piece"], "start": rows["start"], "n_tokens": rows["n_tokens"],
            "bin": (rows["group"].to_numpy() << 32) + bins, "capacity": np.array(sizes, np.int64)[bins], "offset": offsets,
        })

    schema = "id bigint, piece bigint, start bigint, n_tokens bigint, bin bigint, capacity bigint, offset bigint"
    return pieces.groupBy("group").applyInPandas(one, schema).withColumnRenamed("id", id)
