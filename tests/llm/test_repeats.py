"""Substring dedup by doubling and suffix dedup by an index family, against brute force."""

import random

import brute
import numpy as np
import pytest

from tagloom.llm import doubling, suffixes, winnow


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, doc long, key string").repartition(3)


def texts(seed, n=40, alphabet=4, most=60, glue=" "):
    rng = random.Random(seed)
    shared = [[f"w{rng.randrange(500)}" for _ in range(30)] for _ in range(3)]
    found = []
    for _ in range(n):
        words = [f"w{rng.randrange(rng.choice([alphabet, 400]))}" for _ in range(rng.randrange(most))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(shared)[rng.randrange(10) :]
        found.append(glue.join(words))
    return found + [found[0], "same " * 70, "same " * 40]


@pytest.mark.parametrize("seed", range(3))
def test_words(spark, seed):
    rows = [(3 * i, t, 1, "x") for i, t in enumerate(texts(seed))]
    width = 6 if seed else 20
    found = {r.doc_id: r for r in doubling.remove_repeats(docs(spark, rows), width=width).collect()}
    words = [t.encode().split() for _, t, _, _ in rows]
    for (i, *_), own, covered in zip(rows, words, brute.repeats(words, width)):
        kept = b" ".join(w for w, c in zip(own, covered) if not c).decode()
        got = found[i]
        assert (got.n_words, got.n_removed, got.kept) == (len(own), sum(covered), kept)
        assert [tuple(s) for s in got.spans] == brute.runs(covered)


def test_long_words_of_one_pattern_differ(spark):
    """The Thue-Morse word over a and b and its complement: equal to any polynomial hash modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(1 << 12)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    same = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{same} {one}", 1, "x"), (2, f"{same} {two}", 1, "x"), (3, f"{one} {same}", 1, "x"), (4, f"{same} {one}", 1, "x")]
    found = {r.doc_id: r.n_removed for r in doubling.remove_repeats(docs(spark, rows), width=20).collect()}
    assert found == {1: 0, 2: 0, 3: 0, 4: 20}


@pytest.mark.parametrize("period,width", [(1, 20), (3, 20), (7, 5), (25, 20), (4, 3), (2, 1)])
def test_periodic_texts(spark, period, width):
    rows = [(i, " ".join(f"w{(k + i) % period}" for k in range(60 + i)) + f" end{i}", 1, "x") for i in range(5)]
    found = {r.doc_id: r for r in doubling.remove_repeats(docs(spark, rows), width=width).collect()}
    words = [t.split() for _, t, _, _ in rows]
    for (i, *_), own, covered in zip(rows, words, brute.repeats(words, width)):
        assert (found[i].n_words, found[i].n_removed) == (len(own), sum(covered))


@pytest.mark.parametrize("seed,classes", [(0, 1000), (1, 1), (2, 2)])
def test_bytes(spark, monkeypatch, seed, classes):
    monkeypatch.setattr(suffixes, "MOST_CLASSES", classes)
    monkeypatch.setattr(suffixes, "BATCH", 50)
    rows = [(3 * i, t + "é" * (i % 3), 1, "x") for i, t in enumerate(texts(seed))]
    found = {r.doc_id: r for r in suffixes.remove_repeats(docs(spark, rows), width=24).collect()}
    data = [t.encode() for _, t, _, _ in rows]
    for (i, *_), own, covered in zip(rows, data, brute.repeats(data, 24)):
        kept = bytes(b for b, c in zip(own, covered) if not c)
        got = found[i]
        assert (got.n_bytes, got.n_removed, bytes(got.kept)) == (len(own), sum(covered), kept)
        assert [tuple(s) for s in got.spans] == brute.runs(covered)


def test_family_keeps_the_earliest_place_in_any_order():
    rng = np.random.default_rng(1)
    family, expected, late = suffixes.IndexFamily(), {}, set()
    for _ in range(20):
        n = 30
        r = winnow.Records(
            rng.integers(0, 8, n).astype(np.uint64), rng.integers(0, 3, n).astype(np.uint64), rng.integers(0, 50, n),
            rng.integers(0, 50, n), np.ones(n, np.int64),
        )
        for a, c, d, s in zip(r.anchor.tolist(), r.context.tolist(), r.doc.tolist(), r.start.tolist()):
            old = expected.get((a, c))
            late.update(x for x in ((d, s), old) if x and old and x != min((d, s), old))
            expected[(a, c)] = min((d, s), old or (d, s))
        got = family.add(r)
        late_now = set(zip(got.doc.tolist(), got.start.tolist()))
        assert late_now <= late
    whole = family.whole()
    assert {(a, c): (d, s) for a, c, d, s in zip(whole.anchor.tolist(), whole.context.tolist(), whole.doc.tolist(), whole.start.tolist())} == expected
    assert len(family.levels) <= 8


@pytest.mark.parametrize("seed", [0, 3])
def test_batches_added_one_by_one_equal_one_run(spark, tmp_path, seed):
    rows = [(3 * i, t + "é" * (i % 3), 1, f"k{i}") for i, t in enumerate(texts(seed))]
    rows[7] = (21, None, 1, "null")
    whole = {r.doc_id: r for r in suffixes.remove_repeats(docs(spark, rows), width=24, keep=("key",)).collect()}
    root, found = f"{tmp_path}/index", {}
    cuts = [0, 6, 10, 14, 15, 15, 30, len(rows)]  # an empty batch as well
    for a, b in zip(cuts, cuts[1:]):
        found |= {r.doc_id: r for r in suffixes.add_documents(docs(spark, rows[a:b]), root, width=24, keep=("key",)).collect()}
    assert found == whole
    sizes = [r["rows"] for r in suffixes._manifest(spark, root) if r["kind"] == "level"]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and len(sizes) <= 5
    with pytest.raises(ValueError):
        suffixes.add_documents(docs(spark, [(3, "again", 1, "x")]), root, width=24)


@pytest.mark.parametrize("remove,width", [(doubling.remove_repeats, 5), (suffixes.remove_repeats, 16)])
def test_nulls_repeats_empty_and_long_texts(spark, remove, width):
    long = " ".join(f"word{i}" for i in range(60_000))
    passage = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [
        (None, passage, 1, "x"), (5, passage, 1, "x"), (5, passage, 1, "x"), (2, passage + " iota", 1, "x"),
        (2, None, 1, "x"), (9, "", 1, "x"), (7, long, 1, "x"), (8, long[1000:], 1, "x"), (10, " \t ", 1, "x"),
    ]
    found = remove(docs(spark, rows), width=width, keep=("key",)).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    size = found[0].__fields__[2]
    assert [r.n_removed for r in by[None]] == [0]  # rows without id come first
    assert [r.n_removed for r in by[5]] == [r[size] for r in by[5]] and len(by[5]) == 2
    assert sorted(r.n_removed for r in by[2])[0] == 0 and by[9][0][size] == 0
    assert by[7][0].n_removed == 0 and by[8][0].n_removed >= by[8][0][size] - 1
    assert remove(docs(spark, []), width=width).collect() == []


def test_layout_is_kept(spark):
    rows = [(1, "a b\nc  d e f", 1, "x"), (2, "x\ty a b\n\nc  d e f\nz  z", 1, "x")]
    found = {r.doc_id: r.kept for r in doubling.remove_repeats(docs(spark, rows), width=6, layout=True).collect()}
    assert found == {1: "a b\nc  d e f", 2: "x\ty z  z"}


@pytest.mark.parametrize("name,width,size", [("op9_substring_dedup", 20, "n_words"), ("op6_suffix_dedup", 100, "n_bytes")])
def test_queries(spark, name, width, size):
    from tagloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    tokens = [t.split() if size == "n_words" else t for _, t in rows]
    found = {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}
    assert len(found) == len(rows)
    for (i, _), own, covered in zip(rows, tokens, brute.repeats(tokens, width)):
        kept = [x for x, c in zip(own, covered) if not c]
        digest = brute.sha(b" ".join(kept) if size == "n_words" else bytes(kept))
        assert (found[i][size], found[i].n_removed, found[i].kept_sha256) == (len(own), sum(covered), digest)
        if size == "n_bytes":
            assert found[i].n_spans == len(brute.runs(covered))
