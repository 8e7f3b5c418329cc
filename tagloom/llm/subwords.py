"""Supervised subword embeddings: a document is the average of hashed word and character n-gram vectors.

Vectors, softmax weights and biases are learned by stochastic gradient descent
in numpy. Beside the words and their n-grams (3 to 5 characters, with word
ends), a document has three marker words, counted once for each word that its
text has seen before, that equals the word before it, or that stands in a
repeated line: bags of words alone do not show repetition.

As the softmax is linear in the average, a learned word comes down to two
numbers, the sum of its parts' logits and how many parts it has; scoring looks
these up for each distinct word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEEN, SAME, LINE = "\x01seen", "\x01same", "\x01line"
_CACHE = 400_000


def word_counts(text: str | None) -> Counter:
    """Counts of words and marker words of a whole text."""
    words = (text or "").split()
    counts = Counter(words)
    if not words:
        return counts
    lines = Counter(text.split("\n"))
    again = sum((n - 1) * len(x) for x, n in lines.items() if n > 1)
    found = (
        (SEEN, len(words) - len(counts)), (SAME, sum(map(eq, words, words[1:]))),
        (LINE, round(again * len(words) / len(text))),
    )
    counts.update({k: n for k, n in found if n})
    return counts


def packed(text: str | None) -> tuple[bytes, bytes]:
    """``word_counts`` for training: the words, separated by blanks, and their counts."""
    counts = word_counts(text)
    words = " ".join(counts).encode("utf-8", "surrogatepass")
    return words, np.fromiter(counts.values(), np.int32, len(counts)).tobytes()


def _parts(words: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of part (the whole word, then n-grams): which word has it, and its bucket. ``buckets`` is a power of two."""
    marked = [f"<{w}>" for w in words]
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(sizes)
    first = ends - sizes
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(code))  # characters from here to the end of the word
    prime, shift, mask = np.uint64(0x9E3779B97F4A7C15), np.uint64(20), np.uint64(buckets - 1)
    running = np.concatenate([[np.uint64(0)], np.cumsum((code + np.uint64(77)) * _powers(len(code)), dtype=np.uint64)])
    word = (running[ends] - running[first]) * _inverse_powers(len(code))[first]
    word = (word ^ (word >> np.uint64(31))) * prime
    yield np.arange(len(marked)), ((word >> shift) & mask).astype(np.int64)
    gram = np.zeros(len(code), np.uint64)
    for n in range(1, 6):
        gram = gram[: len(code) - n + 1]
        gram = (gram ^ (code[n - 1 :] + np.uint64(1))) * prime
        gram ^= gram >> np.uint64(29)
        if n >= 3:
            whole = left[: len(gram)] >= n
            yield owner[: len(gram)][whole], ((gram[whole] >> shift) & mask).astype(np.int64)


def features(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed parts of each word: bucket ids of all words in a row, and where each word starts."""
    owners, ids = map(np.concatenate, zip(*_parts(words, buckets)))
    order = np.argsort(owners, kind="stable")
    return ids[order], np.searchsorted(owners[order], np.arange(len(words)))


_BASE = 0xD6E8FEB86659FD93


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(max(n, 1), np.uint64(_BASE)), dtype=np.uint64)[:n]


def _inverse_powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(max(n, 1), np.uint64(pow(_BASE, -1, 1 << 64))), dtype=np.uint64)[:n]


@dataclass
class Model:
    """``logit`` of each bucket (class 1 less class 0) and the bias: all that scoring needs."""

    logit: np.ndarray
    bias: float


def train(
    texts: list[str] | list[tuple[bytes, bytes]], labels: np.ndarray, weights: np.ndarray, buckets: int = 1 << 18, dim: int = 8, epochs: int = 4,
    rate: float = 0.5, batch: int = 32, seed: int = 1,
) -> Model:
    """Fit by stochastic gradient descent with a rate falling to zero. With one class or no texts the share decides.

    ``texts`` may be ``packed`` before.
    """
    share = float(weights @ labels + 1) / float(weights.sum() + 2)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(buckets), float(np.log(share / (1 - share))))
    number: dict[str, int] = {}
    words, times = [], []
    for t in texts:
        own, counts = t if isinstance(t, tuple) else packed(t)
        own = bytes(own).decode("utf-8", "surrogatepass").split(" ") if own else []
        words.append(np.fromiter((number.setdefault(w, len(number)) for w in own), np.int32, len(own)))
        times.append(np.frombuffer(counts, np.int32))
    names = list(number)
    del number
    found = [features(names[at : at + 20_000], buckets) for at in range(0, len(names), 20_000)]
    before = np.cumsum([0, *(len(ids) for ids, _ in found)])
    parts = np.concatenate([ids.astype(np.int32) for ids, _ in found])
    starts = np.concatenate([first + n for (_, first), n in zip(found, before)])
    del names, found
    sizes = np.diff(np.append(starts, len(parts)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim))
    out, bias = rng.normal(0, 0.1, (dim, 2)), np.array([0.0, 0.0])
    steps = epochs * -(-len(texts) // batch)
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick = [i for i in order[at : at + batch] if len(words[i])]
            speed = rate * (1 - done / steps)
            done += 1
            if not pick:
                continue
            flat, n = np.concatenate([words[i] for i in pick]), np.array([len(words[i]) for i in pick])
            doc = np.repeat(np.arange(len(pick)), n)
            uniq, back = np.unique(flat, return_inverse=True)
            lengths = sizes[uniq]
            offs = np.cumsum(lengths) - lengths
            bucket = parts[np.repeat(starts[uniq] - offs, lengths) + np.arange(lengths.sum())]
            share_of = np.concatenate([times[i] for i in pick])
            share_of = share_of / np.bincount(doc, share_of * lengths[back])[doc]
            inner = np.add.reduceat(vectors[bucket], offs)
            firsts = np.cumsum(n) - n
            hidden = np.add.reduceat(inner[back] * share_of[:, None], firsts)
            logits = hidden @ out + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            grad = odds / odds.sum(1, keepdims=True)
            y = labels[pick]
            grad[np.arange(len(pick)), y] -= 1
            grad *= weights[pick][:, None]
            down = grad @ out.T
            out -= speed * hidden.T @ grad
            bias -= speed * grad.sum(0) / len(pick)
            per_doc = down[doc] * share_of[:, None]
            touched, where = np.unique(bucket, return_inverse=True)
            owner = np.repeat(np.arange(len(uniq)), lengths)
            for j in range(dim):
                of_word = np.bincount(back, per_doc[:, j], len(uniq))
                vectors[touched, j] -= speed * np.bincount(where, of_word[owner], len(touched))
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


class Scorer:
    """Probability of class 1 of whole texts. Keeps a bounded number of known words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        found = []
        for at in range(0, len(texts), 500):
            counts = [word_counts(t) for t in texts[at : at + 500]]
            self._learn(counts)
            known = self.known
            for c in counts:
                total = parts = 0.0
                for w, n in c.items():
                    value, size = known[w]
                    total += n * value
                    parts += n * size
                found.append(self.model.bias + (total / parts if parts else 0.0))
        return 1 / (1 + np.exp(-np.clip(np.array(found), -500, 500)))

    def _learn(self, counts: list[Counter]) -> None:
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        fresh = list({w for c in counts for w in c if w not in known})
        for at in range(0, len(fresh), 50_000):
            some = fresh[at : at + 50_000]
            values, sizes = np.zeros(len(some)), np.zeros(len(some), np.int64)
            for owner, bucket in _parts(some, len(self.model.logit)):
                values += np.bincount(owner, self.model.logit[bucket], len(some))
                sizes += np.bincount(owner, minlength=len(some))
            known.update(zip(some, zip(values.tolist(), sizes.tolist())))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = (), name: str = "score") -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` and the score (0 to 1) of the whole text, called ``name``.

    Null, empty and wordless texts get the share the model learned as its bias.
    """
    names = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for rows in batches:
            texts = [t if isinstance(t, str) else None for t in rows["t"]]
            yield rows[names].assign(score=scorer(texts))

    plain = docs.select(F.col(text).alias("t"), *[F.col(k).alias(n) for k, n in zip(keep, names)])
    scored = plain.mapInPandas(run, plain.drop("t").schema.add("score", "double"))
    return scored.select(*[F.col(n).alias(k) for k, n in zip(keep, names)], F.col("score").alias(name))
