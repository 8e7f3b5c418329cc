"""Convolutional text classifier: hashed word embeddings, several filter widths, max pooling, logistic output.

A word's embedding is the mean of the vectors of its hash and of the hashes of
its first four, first five and last four characters. Training is adaptive
gradient descent in numpy. Only the word at which a filter has its maximum gets
a gradient, so the backward pass touches a few words of a document.

For scoring, the product of each filter row with each distinct word is kept in
a table of bounded size; a convolution is then a sum of looked-up rows, taken
in chunks so that memory does not depend on the length of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.labelled import OVER_BLOCKS, block_rows
from tagloom.session import settings

WIDTHS = (1, 2, 3)
_WORD = re.compile(r"\w+")
_CHUNK = 1 << 15
_CACHE = 150_000
_ROWS = 8192
_BASE = 0xD6E8FEB86659FD93
_SHIFTS = np.arange(4, dtype=np.uint64) * np.uint64(16)


def parts(words: list[str], buckets: int) -> np.ndarray:
    """Buckets of each word, its first four and five and its last four characters. ``buckets`` is a power of two."""
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    first = ends - sizes
    power = np.cumprod(np.full(len(code) + 1, np.uint64(_BASE)), dtype=np.uint64)
    back = np.cumprod(np.full(len(code) + 1, np.uint64(pow(_BASE, -1, 1 << 64))), dtype=np.uint64)
    running = np.concatenate([[np.uint64(0)], np.cumsum((code + np.uint64(77)) * power[:-1], dtype=np.uint64)])
    pieces = (
        (first, ends), (first, np.minimum(first + 4, ends)), (first, np.minimum(first + 5, ends)),
        (np.maximum(ends - 4, first), ends),
    )
    found = np.empty((len(words), len(pieces)), np.int64)
    for kind, (a, b) in enumerate(pieces):
        value = (running[b] - running[a]) * back[a] + np.uint64(kind)
        value = (value ^ (value >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        found[:, kind] = (value >> np.uint64(20)) & np.uint64(buckets - 1)
    return found


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def packed(text: str | None, buckets: int = 1 << 16) -> tuple[bytes, bytes]:
    """A text for training: its distinct words as the buckets of each in one number, and which of them each word is."""
    number: dict[str, int] = {}
    words = words_of(text)
    at = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
    four = parts(list(number), buckets).astype(np.uint64) << _SHIFTS if number else np.zeros((0, 4), np.uint64)
    return np.bitwise_or.reduce(four, axis=1).tobytes(), at.tobytes()


def _numbered(texts: list[tuple[bytes, bytes]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Numbers from 1 of the words of each packed text, and the buckets of each number; 0 is padding."""
    own = [np.frombuffer(words, np.uint64) for words, _ in texts]
    known, back = np.unique(np.concatenate(own), return_inverse=True)
    back = back.astype(np.int32) + np.int32(1)
    ends = np.cumsum([0, *map(len, own)])
    ids = [back[a:b][np.frombuffer(at, np.int32)] for a, b, (_, at) in zip(ends, ends[1:], texts)]
    four = (known[:, None] >> _SHIFTS & np.uint64(0xFFFF)).astype(np.int64)
    return ids, np.concatenate([np.zeros((1, 4), np.int64), four])


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dim
    filters: list[np.ndarray]  # per width: width x dim x filters
    offsets: np.ndarray  # bias of each filter of all widths
    out: np.ndarray
    bias: float
    thresholds: dict[str | None, float]  # by language; None for any other

    def means(self, buckets: np.ndarray) -> np.ndarray:
        """Embeddings of words, from the four buckets of each."""
        total = self.vectors.take(buckets[:, 0], axis=0)
        for k in range(1, buckets.shape[1]):
            total += self.vectors.take(buckets[:, k], axis=0)
        total /= buckets.shape[1]
        return total

    def projections(self, means: np.ndarray) -> np.ndarray:
        """Embeddings times all filter rows, width by width, offset by offset."""
        flat = np.concatenate([f.transpose(1, 0, 2).reshape(f.shape[1], -1) for f in self.filters], axis=1)
        return (means @ flat).astype(np.float32)


def _convolve(rows: np.ndarray, filters: int) -> np.ndarray:
    """Filter values at each position but the last two, from projected rows."""
    n = len(rows) - WIDTHS[-1] + 1
    found, at = np.empty((n, len(WIDTHS) * filters), rows.dtype), 0
    for k, width in enumerate(WIDTHS):
        total = found[:, k * filters : (k + 1) * filters]
        total[:] = rows[:n, at : at + filters]
        for offset in range(1, width):
            low = at + offset * filters
            total += rows[offset : offset + n, low : low + filters]
        at += width * filters
    return found


def _pool(table: np.ndarray, ids: list[np.ndarray], filters: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each filter in each document, and its first position. ``ids``: rows of ``table``; row 0 is padding."""
    pad = np.zeros(WIDTHS[-1] - 1, np.int64)
    best = np.full((len(ids), filters * len(WIDTHS)), -np.inf, np.float32)
    where = np.zeros(best.shape, np.int64)
    pieces, owners, firsts, size = [], [], [], 0

    def flush() -> None:
        starts = np.cumsum([0, *(len(p) for p in pieces)])
        values = _convolve(table.take(np.concatenate(pieces), axis=0), filters)
        for k, doc in enumerate(owners):
            part = values[starts[k] : starts[k + 1] - len(pad)]
            at = part.argmax(0)
            top = part[at, np.arange(part.shape[1])]
            better = top > best[doc]
            best[doc][better] = top[better]
            where[doc][better] = at[better] + firsts[k]

    for doc, own in enumerate(ids):
        own = np.concatenate([own if len(own) else np.zeros(1, np.int64), pad])
        for first in range(0, len(own) - len(pad), _CHUNK):
            pieces.append(own[first : first + _CHUNK + len(pad)])
            owners.append(doc)
            firsts.append(first)
            size += len(pieces[-1])
            if size >= _CHUNK:
                flush()
                pieces, owners, firsts, size = [], [], [], 0
    if pieces:
        flush()
    return best, where


def _fresh(rng: np.random.Generator, share: float, buckets: int, dim: int, filters: int) -> Model:
    return Model(
        rng.normal(0, 0.1, (buckets, dim)), [rng.normal(0, 1 / np.sqrt(w * dim), (w, dim, filters)) for w in WIDTHS],
        np.zeros(filters * len(WIDTHS)), rng.normal(0, 0.1, filters * len(WIDTHS)), float(np.log(share / (1 - share))), {},
    )


def _constant(model: Model) -> Model:
    """Without examples of both classes."""
    model.out[:] = 0
    model.thresholds = {None: 0.5}
    return model


def _no_squares(model: Model) -> list[np.ndarray]:
    return [np.full(x.shape, 1e-6) for x in (model.vectors, *model.filters, model.offsets, model.out, np.zeros(1))]


class _Numbers:
    """The distinct values of an array in ascending order, and which of them each value is; all are below ``limit``."""

    def __init__(self, limit: int):
        self.seen, self.place = np.zeros(limit, np.bool_), np.zeros(limit, np.int64)

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.seen[values] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        self.place[found] = np.arange(len(found))
        return found, self.place[values]


def _pass(
    model: Model, squares: list[np.ndarray], ids: list[np.ndarray], bucket: np.ndarray, used: np.ndarray, labels: np.ndarray,
    weights: np.ndarray, rate: float, batch: int,
) -> None:
    """One pass over the texts ``used``, in that order; changes the model and ``squares``, the sums of squared gradients."""
    filters, dim = model.filters[0].shape[2], model.vectors.shape[1]
    number, place = _Numbers(len(bucket)), _Numbers(len(model.vectors))
    for at in range(0, len(used), batch):
        pick = used[at : at + batch]
        rows, back = number(np.concatenate([np.zeros(1, np.int32), *(ids[i] for i in pick)]))
        means = model.means(bucket.take(rows, axis=0))
        table = model.projections(means)
        table[0] = 0
        cuts = np.cumsum([1, *(len(ids[i]) for i in pick)])
        starts, ends = cuts[:-1, None], cuts[1:, None]
        best, where = _pool(table, [back[a:b] for a, b in zip(cuts, cuts[1:])], filters)
        best = best + model.offsets
        hidden = np.maximum(best, 0)
        odds = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.bias, -50, 50)))
        slope = (odds - labels[pick]) * weights[pick] / len(pick)
        grad = slope[:, None] * model.out * (best > 0)
        _adapt(model.out, hidden.T @ slope, squares[-2], rate)
        _adapt(model.offsets, grad.sum(0), squares[-3], rate)
        squares[-1] += slope.sum() ** 2
        model.bias -= rate * slope.sum() / np.sqrt(squares[-1][0])
        touched: list[np.ndarray] = []
        pulls: list[np.ndarray] = []
        for k, width in enumerate(WIDTHS):
            cols = slice(k * filters, (k + 1) * filters)
            change = np.zeros(model.filters[k].shape)
            for offset in range(width):
                spot = starts + where[:, cols] + offset
                word = back[np.where(spot < ends, spot, 0)]  # back[0] is the padding
                inside = (word > 0) * grad[:, cols]
                change[offset] = np.einsum("df,dfv->vf", inside, means[word])
                doc, kind = np.nonzero(inside)
                touched.append(bucket[rows[word[doc, kind]]])
                pulls.append(inside[doc, kind, None] * model.filters[k][offset].T[kind])
            _adapt(model.filters[k], change, squares[1 + k], rate)
        four, pull = np.concatenate(touched), np.concatenate(pulls) / 4
        some, spot = place(four.ravel())
        cells = spot[:, None] * dim + np.arange(dim)
        total = np.bincount(cells.ravel(), np.repeat(pull, 4, axis=0).ravel(), len(some) * dim).reshape(-1, dim)
        old = squares[0][some] + total**2
        squares[0][some] = old
        model.vectors[some] -= rate * total / np.sqrt(old)


def train(
    texts: list[str] | list[tuple[bytes, bytes]], labels: np.ndarray, weights: np.ndarray, langs: list[str | None], buckets: int = 1 << 16,
    dim: int = 16, filters: int = 8, epochs: int = 10, rate: float = 0.1, batch: int = 32, seed: int = 1,
) -> Model:
    """Fit on four fifths of the texts; the rest sets the threshold of each language.

    ``texts`` may be ``packed`` before, with the same ``buckets``, 65,536 at most.
    """
    if buckets > 1 << 16:
        raise ValueError("at most 65,536 buckets")
    rng = np.random.default_rng(seed)
    share = float(weights @ labels + 1) / float(weights.sum() + 2)
    model = _fresh(rng, share, buckets, dim, filters)
    if len(set(labels.tolist())) < 2:
        return _constant(model)
    order = rng.permutation(len(texts))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    ids, bucket = _numbered([t if isinstance(t, tuple) else packed(t, buckets) for t in texts])
    squares = _no_squares(model)
    for _ in range(epochs):
        _pass(model, squares, ids, bucket, used, labels, weights, rate, batch)
        rng.shuffle(used)
    scores = np.concatenate([_scores(model, bucket, [ids[i] for i in held[at : at + 200]]) for at in range(0, len(held), 200)] or [[]])
    model.thresholds = _thresholds(scores, labels[held], weights[held], [langs[i] for i in held])
    return model


def _rows(parts: list[np.ndarray]) -> np.ndarray:
    """All parameters, or their sums of squares, as rows as long as a word's vector: the vectors, then the others one after the other."""
    dim = parts[0].shape[1]
    rest = np.concatenate([x.ravel() for x in parts[1:]])
    return np.concatenate([parts[0], np.pad(rest, (0, -len(rest) % dim)).reshape(-1, dim)])


def _parts(rows: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    n = len(like[0])
    rest, at, found = rows[n:].ravel(), 0, [rows[:n].copy()]
    for x in like[1:]:
        found.append(rest[at : at + x.size].reshape(x.shape).copy())
        at += x.size
    return found


def _parameters(model: Model) -> list[np.ndarray]:
    return [model.vectors, *model.filters, model.offsets, model.out, np.array([model.bias])]


def _model(parts: list[np.ndarray], thresholds: dict[str | None, float]) -> Model:
    return Model(parts[0], parts[1:-3], parts[-3], parts[-2], float(parts[-1][0]), thresholds)


def fit(
    blocks: DataFrame, buckets: int = 1 << 16, dim: int = 16, filters: int = 8, epochs: int = 10, rate: float = 0.1, batch: int = 32,
    seed: int = 1,
) -> Model:
    """Fit on every text of ``labelled.training_blocks``; the texts it sets apart give the threshold of each language.

    Each epoch is a job: every block starts from the epoch's model and makes one
    pass over its texts, and a parameter then moves by the mean over the blocks
    that changed it. A core gets one task, which has one block at a time in memory
    and adds up its blocks; Spark adds up the tasks, so that what an epoch shuffles
    does not grow with the input and the driver gets one row for each vector. It
    sends back those that have changed since the start. One block alone is the plain
    method of ``train``. Thresholds come from the counts of all texts set apart by
    score, to four digits.
    """
    if buckets > 1 << 16:
        raise ValueError("at most 65,536 buckets")
    used = F.when(~F.col("d.held"), F.col("d.y"))
    spark = blocks.sparkSession
    with settings(spark, OVER_BLOCKS):
        sizes = blocks.select(F.explode("docs").alias("d")).agg(F.count(used).alias("n"), F.coalesce(F.sum(used), F.lit(0)).alias("ones")).first()
    share = (sizes["ones"] + 1) / (sizes["n"] + 2)

    def fresh() -> Model:
        return _fresh(np.random.default_rng(seed), share, buckets, dim, filters)

    model = fresh()
    if not 0 < sizes["ones"] < sizes["n"]:
        return _constant(model)
    like = _parameters(model)
    values, squares = _rows(like), _rows(_no_squares(model))
    changed = np.zeros(len(values), np.bool_)

    def step(epoch: int, sent: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = fresh()
            like = _parameters(first)
            values, squares = _rows(like), _rows(_no_squares(first))
            at, *known = sent.value
            values[at], squares[at] = known
            moved, grown, times = np.zeros_like(values), np.zeros_like(squares), np.zeros(len(values), np.int64)
            for block, y, _, texts in block_rows(batches, held=False):
                if not texts:
                    continue
                ids, bucket = _numbered(texts)
                own, sums = _model(_parts(values, like), {}), _parts(squares, like)
                used = np.random.default_rng([seed, epoch, block & 0x7FFFFFFF]).permutation(len(texts))
                _pass(own, sums, ids, bucket, used, y, np.ones(len(texts)), rate, batch)
                more = _rows(sums) - squares
                moved += _rows(_parameters(own)) - values
                grown += more
                times += more.any(1)
            hit = np.flatnonzero(times)
            for at in range(0, len(hit), _ROWS):
                some = hit[at : at + _ROWS]
                found = np.concatenate([moved[some], grown[some]], axis=1).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, times[some], *found.T.copy())], ["k", "n", *names])

        return run

    names = [f"{kind}{i}" for kind in "vq" for i in range(dim)]
    schema = "k long, n long, " + ", ".join(f"{c} float" for c in names)
    cores = spark.sparkContext.defaultParallelism
    for epoch in range(epochs):
        at = np.flatnonzero(changed)  # the others are those that ``fresh`` gives
        sent = spark.sparkContext.broadcast((at, values[at].astype(np.float32), squares[at].astype(np.float32)))
        with settings(spark, OVER_BLOCKS):
            steps = blocks.coalesce(cores).mapInArrow(step(epoch, sent), schema)
            total = steps.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).toArrow()
        sent.destroy()
        hit = total["k"].to_numpy()
        mean = np.stack([total[c].to_numpy() for c in names], axis=1) / total["n"].to_numpy()[:, None]
        values[hit] = (values[hit] + mean[:, :dim]).astype(np.float32)
        squares[hit] = (squares[hit] + mean[:, dim:]).astype(np.float32)
        changed[hit] = True
    model = _model(_parts(values, like), {})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, y, langs, texts in block_rows(batches, held=True):
            for at in range(0, len(texts), 200):
                ids, bucket = _numbered(texts[at : at + 200])
                scores = _scores(model, bucket, ids).round(4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(scores), pa.array(y[at : at + 200], pa.int32()), pa.array(langs[at : at + 200], pa.string())], ["s", "y", "l"])

    with settings(spark, OVER_BLOCKS):
        scored = blocks.mapInArrow(judge, "s double, y int, l string").groupBy("s", "y", "l").agg(F.count(F.lit(1)).alias("n"))
        found = scored.toPandas()  # scores of four digits, by language
    model.thresholds = _thresholds(
        found["s"].to_numpy(), found["y"].to_numpy(np.int64), found["n"].to_numpy(float), [x if isinstance(x, str) else None for x in found["l"]],
        counts=found["n"].to_numpy(np.int64))
    return model


def _scores(model: Model, bucket: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    rows, back = np.unique(np.concatenate([[0], *ids]), return_inverse=True)
    table = model.projections(model.means(bucket[rows]))
    table[0] = 0
    cuts = np.cumsum([1, *map(len, ids)])
    best, _ = _pool(table, [back[a:b] for a, b in zip(cuts, cuts[1:])], model.filters[0].shape[2])
    logits = np.maximum(best + model.offsets, 0) @ model.out + model.bias
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def _adapt(value: np.ndarray, grad: np.ndarray, square: np.ndarray, rate: float) -> None:
    square += grad**2
    value -= rate * grad / np.sqrt(square)


def _thresholds(scores, labels, weights, langs, least: int = 10, counts=None) -> dict[str | None, float]:
    """By language, the score from which flagging gives the largest F1; languages with few toxic texts take the common one.

    A row may stand for several texts, their number in ``counts``.
    """
    counts = np.ones(len(labels), np.int64) if counts is None else counts
    langs = np.array([x or "" for x in langs])
    found = {None: _best(scores, labels, weights)}
    for lang in sorted(set(langs.tolist()) - {""}):
        own = langs == lang
        if least <= labels[own] @ counts[own] < counts[own].sum():
            found[lang] = _best(scores[own], labels[own], weights[own])
    return found


def _best(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    if not len(scores) or not labels.any():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, hit, w = scores[order], (labels * weights)[order].cumsum(), weights[order].cumsum()
    f1 = 2 * hit / (w + (labels * weights).sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # only between different scores
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2 if k + 1 < len(s) else s[k])


class Scorer:
    """Probability of class 1 of whole texts."""

    def __init__(self, model: Model):
        self.model, self.filters = model, model.filters[0].shape[2]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((1, sum(WIDTHS) * self.filters), np.float32)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        found = []
        for at in range(0, len(texts), 200):
            docs = [words_of(t) for t in texts[at : at + 200]]
            if len(self.number) > _CACHE:
                self._forget()
            number = self.number
            fresh = list(set().union(*docs).difference(number))
            if fresh:
                number.update(zip(fresh, range(len(number) + 1, len(number) + len(fresh) + 1)))
                rows = self.model.projections(self.model.means(parts(fresh, len(self.model.vectors))))
                if len(number) + 1 > len(self.table):
                    larger = np.zeros((2 * (len(number) + 1), self.table.shape[1]), np.float32)
                    larger[: len(self.table)] = self.table
                    self.table = larger
                self.table[len(number) - len(fresh) + 1 : len(number) + 1] = rows
            look = number.__getitem__
            ids = [np.fromiter(map(look, d), np.int64, len(d)) for d in docs]
            best, _ = _pool(self.table, ids, self.filters)
            found.append(np.maximum(best + self.model.offsets, 0) @ self.model.out + self.model.bias)
        logits = np.concatenate(found) if found else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = (), name: str = "score") -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` and ``name``, the score (0 to 1) of the whole text; null counts as empty."""
    names = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for rows in batches:
            texts = [t if isinstance(t, str) else None for t in rows["t"]]
            yield rows[names].assign(score=scorer(texts))

    plain = docs.select(F.col(text).alias("t"), *[F.col(k).alias(n) for k, n in zip(keep, names)])
    scored = plain.mapInPandas(run, plain.drop("t").schema.add("score", "double"))
    return scored.select(*[F.col(n).alias(k) for k, n in zip(keep, names)], F.col("score").alias(name))


def flagged(score: Column, lang: Column, model: Model) -> Column:
    """Whether a score reaches the calibrated threshold of its language; other and null languages take the common one."""
    limit = F.lit(model.thresholds[None])
    for name, value in model.thresholds.items():
        if name is not None:
            limit = F.when(lang == name, F.lit(value)).otherwise(limit)
    return score >= limit
