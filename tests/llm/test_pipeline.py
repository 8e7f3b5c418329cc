"""Each stage on its own input, against brute force."""

import os
import re

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagloom.llm import subwords

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


@pytest.fixture(scope="module")
def tables(spark_module):
    spark = spark_module
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    odd = spark.createDataFrame(
        [(10_001, None, "en", None, None), (10_002, "", None, "s", 0), (10_003, "few good words here", "en", "s", 19)], docs.schema
    )
    found = [corpus_pipeline.materialise(docs.unionByName(odd).repartition(3))]
    for _, stage in corpus_pipeline.STAGES:
        found.append(corpus_pipeline.materialise(stage(spark, found[-1], FOLDER)))
    return [t.collect() for t in found]


@pytest.fixture(scope="module")
def spark_module():
    from tagloom.session import local_session

    return local_session(8, "tests")


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_names_and_columns(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substring_dedup", "decontamination", "packing"]
    assert all(t[0].__fields__ == tables[0][0].__fields__ for t in tables[:5])


def test_quality_keeps_what_the_model_accepts(spark_module, tables):
    score = subwords.Scorer(corpus_pipeline.quality_model(spark_module, FOLDER))
    expected = {r.doc_id for r in tables[0] if score([r.text])[0] >= corpus_pipeline.REJECT_BELOW}
    assert set(by_id(tables[1])) == expected and all(by_id(tables[0])[r.doc_id] == r for r in tables[1])


def test_one_of_each_group_stays(tables):
    rows = sorted(tables[1], key=lambda r: r.doc_id)
    prints = [brute.simhash(r.text) for r in rows]
    roots = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(tables[2]) == sorted(rows[k] for k in sorted(set(roots)))


def test_repeated_words_go(tables):
    rows = sorted(tables[2], key=lambda r: r.doc_id)
    words = [(r.text or "").split() for r in rows]
    after = by_id(tables[3])
    assert len(after) == len(rows)
    for r, own, covered in zip(rows, words, brute.repeats(words, 20)):
        got = after[r.doc_id]
        assert got.text.split() == [w for w, c in zip(own, covered) if not c]
        assert got.n_chars == len(got.text) and (got.lang, got.source) == (r.lang, r.source)
        if not any(covered):
            assert got.text == (r.text or "")


def test_contaminated_documents_go(spark_module, tables):
    items = [tuple(r) for r in corpus_pipeline.table(spark_module, FOLDER, "benchmark").collect()]
    windows = {}
    for name, item in items:
        own = re.findall(brute.ALNUM, brute.lower(item))
        for i in range(max(1, len(own) - 12)):
            windows.setdefault(tuple(own[i : i + 13]), name)
    kept = []
    for r in tables[3]:
        words = re.findall(brute.ALNUM, brute.lower(r.text))
        hit = set()
        for at in range(len(words) - 12):
            if tuple(words[at : at + 13]) in windows:
                hit.update(range(at, at + 13))
        if not hit or 20 * len(hit) < len(words):
            kept.append(r)
    assert sorted(kept, key=lambda r: r.doc_id) == sorted(tables[4], key=lambda r: r.doc_id) and len(kept) < len(tables[3])


def test_all_that_is_left_is_packed(tables):
    assert {r.doc_id for r in tables[5]} == set(by_id(tables[4]))
    used = {}
    for r in tables[5]:
        used[(r.bin, r.capacity)] = used.get((r.bin, r.capacity), 0) + r.n_tokens
    assert all(n <= capacity for (_, capacity), n in used.items())


def test_run_gives_the_last_stage(spark_module, tables):
    found = corpus_pipeline.run(spark_module, FOLDER)
    ids = {r.doc_id for r in found.select("doc_id").distinct().collect()}
    assert ids == {i for i in {r.doc_id for r in tables[5]} if i < 10_000}
    assert found.filter(F.col("n_tokens") <= 0).isEmpty()
