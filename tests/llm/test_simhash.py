import random

import pytest
import brute

from tagloom.llm import graph, simhash


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2, 3):
        tables = simhash.masks(radius)
        assert len(tables) == 2 ** (radius + 1) - 1
        rng = random.Random(radius)
        for _ in range(500):
            flips = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(m & flips == 0 for m in tables)


def test_fingerprints(spark):
    texts = [None, "", " \t\n", "One", "one two", "A b c d e f", "a b c d e f", "É é Ü x y", "x " * 5000]
    for t in texts:
        assert simhash.fingerprint(t) == signed(brute.simhash(t))
    assert simhash.fingerprint("a b c a b c") == simhash.fingerprint("A B C A B C")


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, radius):
    rng = random.Random(radius)
    points = set()
    for _ in range(30):
        p = rng.getrandbits(64)
        points.add(p)
        for _ in range(rng.choice([0, 1, 5, 20])):  # chains and balls of near fingerprints
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 1)))
            points.add(p)
    points = sorted(points)
    expected = brute.components(points, lambda a, b: (a ^ b).bit_count() <= radius)
    df = spark.createDataFrame([(signed(p),) for p in points], "simhash long")
    edges = simhash.links(df, radius)
    found = dict(graph.components(edges).collect())
    groups = {}
    for p, root in zip(points, expected):
        groups.setdefault(root, set()).add(found.get(signed(p), signed(p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rows = path + star + [(5, 5), (None, 3), (1, 2)]
    found = graph.components(spark.createDataFrame(rows, "a long, b long")).collect()
    assert len({r.root for r in found if r.node <= 300}) == 1 and len({r.root for r in found if r.node >= 1000}) == 1
    assert len(found) == 301 + 200
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, simhash string, component int")


def test_nulls_ties_repeats_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (7, None, "x", 1), (3, "", "x", 1), (9, "the same text here", "x", 1), (9, "the same text here", "x", 1),
        (4, "The Same text here", "x", 1), (None, "the same text here", "x", 1), (None, "only without id", "x", 1),
        (5, long, "x", 1), (6, long + " end", "x", 1),
    ]
    found = {(r.doc_id, r.simhash): r.component for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    assert found[(7, 0)] == found[(3, 0)] == 3
    assert {c for (i, _), c in found.items() if i in (9, 4)} == {4}
    assert simhash.near_duplicates(docs(spark, rows)).count() == len(rows)
    kept = simhash.keep_first(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "simhash", "component"]
    assert sorted((r.doc_id, (r.text or "")[:8]) for r in kept.collect() if r.doc_id is not None)[:2] == [(3, ""), (4, "The Same")]
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["only without id"]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    assert simhash.keep_first(docs(spark, [])).collect() == []


def test_query_against_brute_force(spark):
    from tagloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = sorted(texts)
    points = [brute.simhash(texts[i]) for i in ids]
    roots = brute.components(points, lambda a, b: (a ^ b).bit_count() <= 2)
    expected = {i: (format(p, "016x"), ids[r]) for i, p, r in zip(ids, points, roots)}
    got = QUERIES["op1_simhash"](spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == expected and len(got) == len(ids)
