import random

import brute
import pytest

from tagloom.llm import decontaminate


def run(spark, docs, items, window):
    d = spark.createDataFrame(docs, "doc_id long, text string, words string, start int").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string, w int")
    return d, i, decontaminate.contamination(d, i, window=window).collect()


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, monkeypatch, large, seed):
    if large:  # the way beyond the bounded broadcasts
        monkeypatch.setattr(decontaminate, "MOST_WINDOWS", 0)
        monkeypatch.setattr(decontaminate, "MOST_HASHES", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(seed)
    word = lambda n: rng.choice(["Aa", "b", "é", "c1", "d"][:n] + [f"x{rng.randrange(40)}"])
    items = [(i, " ".join(word(5) for _ in range(rng.choice([1, 2, 4, 7, 12]))), 0) for i in range(12)]
    items += [(50, None, 0), (51, "... ,", 0), (None, "b c1", 0), (3, items[3][1], 0)]
    docs = []
    for k in range(40):
        words = [word(5) for _ in range(rng.randrange(25))]
        if rng.random() < 0.7:
            at = rng.randrange(len(words) + 1)
            words[at:at] = (items[rng.randrange(12)][1] or "").upper().split() * rng.choice([1, 2])
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(words), "x", 1))
    docs += [(90, None, "x", 1), (91, "", "x", 1), (90, docs[0][1], "x", 1), (None, docs[1][1], "x", 1)]
    try:
        _, _, found = run(spark, docs, items, 6)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = [(i, *brute.contamination(t, [x[:2] for x in items], 6)) for i, t, _, _ in docs]
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in found)


def test_long_texts_empty_tables_and_clean(spark):
    passage = " ".join(f"word{i}" for i in range(13))
    long = " ".join(f"other{i}" for i in range(50_000))
    docs = [(1, long + " " + passage, "x", 1), (2, passage, "x", 1), (2, "fine", "x", 1), (3, passage[:-1], "x", 1), (None, passage, "x", 1)]
    d, i, found = run(spark, docs, [(7, passage, 1)], 13)
    assert sorted((r.n_words, r.n_hit) for r in found) == [(1, 0), (13, 0), (13, 13), (13, 13), (50_013, 13)]
    kept = decontaminate.clean(d, i, window=13)
    assert kept.columns == d.columns
    assert sorted((r.doc_id, r.text[:5]) for r in kept.collect()) == [(1, "other"), (2, "fine"), (3, "word0")]
    assert {r.n_hit for r in run(spark, docs, [], 13)[2]} == {0}
    assert run(spark, [], [(7, passage, 1)], 13)[2] == []


def test_a_window_of_many_items_in_many_documents(spark):
    passage = " ".join(f"word{i}" for i in range(13))
    other = " ".join(f"more{i}" for i in range(13))
    items = [(i, passage + (f" {other}" if i % 2 else ""), 1) for i in range(40)] + [(99, other, 1)]
    docs = [(k, [passage, other, f"{passage} {other}", f"{other} {passage}"][k % 4], "x", 1) for k in range(60)]
    _, _, found = run(spark, docs, items, 13)
    everyone = sorted(str(i) for i in range(40))
    odd = sorted([str(i) for i in range(1, 40, 2)] + ["99"])
    expected = [everyone, odd, sorted({*everyone, *odd}), sorted({*everyone, *odd})]
    assert all(r["items"] == expected[r.doc_id % 4] for r in found) and len(found) == 60
