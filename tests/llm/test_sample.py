"""Training samples cut in tasks, repeated ids, and a documents table with a column named score."""

import numpy as np
import pytest

import corpus_pipeline
from tagloom.llm import convnet, labelled, subwords
from test_classifiers import ODD, toy


def test_one_row_of_a_repeated_id(spark):
    rows = [(1, f"copy {k}", f"l{k}") for k in range(500)] + [(2, "b", "x"), (1, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    found = labelled.training_sample(docs, labels, "quality", 10, lang="lang")
    assert (found.texts, found.labels.tolist(), found.langs) == (["copy 0", "b"], [0, 1], ["l0", "x"])
    cut = labelled.training_sample(docs, labels, "quality", 10, lang="lang", cut=subwords.packed)
    assert [tuple(map(bytes, t)) for t in cut.texts] == [subwords.packed("copy 0"), subwords.packed("b")]
    assert cut.langs == ["l0", "x"]


def test_training_on_cut_texts_is_the_same():
    texts, labels = toy(120)
    texts = [*texts, *(t or "" for t in ODD)]
    labels = np.append(labels, [0, 1, 0, 1, 0, 1])
    weights = np.ones(len(texts))
    one = subwords.train(texts, labels, weights, buckets=1 << 10)
    two = subwords.train([subwords.packed(t) for t in texts], labels, weights, buckets=1 << 10)
    assert (one.logit == two.logit).all() and one.bias == two.bias
    langs = [None] * len(texts)
    one = convnet.train(texts, labels, weights, langs, buckets=1 << 10, epochs=1)
    two = convnet.train([convnet.packed(t, 1 << 10) for t in texts], labels, weights, langs, buckets=1 << 10, epochs=1)
    assert (one.vectors == two.vectors).all() and one.thresholds == two.thresholds
    ids, bucket = convnet._numbered([convnet.packed(t, 1 << 10) for t in texts])
    for t, own in zip(texts, ids):
        words = convnet.words_of(t)
        assert len(own) == len(words) and (not words or (bucket[own] == convnet.parts(words, 1 << 10)).all())
    assert convnet._scores(two, bucket, ids) == pytest.approx(convnet.Scorer(two)(texts), rel=1e-4)


def test_quality_stage_with_a_column_named_score(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "quality_model", lambda *_: subwords.Model(np.zeros(8), 1.0))
    docs = spark.createDataFrame([(1, "a b", "mine", 2)], "doc_id long, text string, score string, n_chars int")
    found = corpus_pipeline.quality(spark, docs, "")
    assert found.columns == docs.columns and found.collect() == docs.collect()


def test_sample_is_bounded_in_bytes(spark):
    rows = [(i, "x" * (10 if i % 2 else 1000)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    whole = labelled.training_sample(docs, labels, "quality", 25)
    bounded = labelled.training_sample(docs, labels, "quality", 25, most_bytes=4500)
    assert sorted(map(len, whole.texts)) == [10] * 25 + [1000] * 25
    assert sorted(map(len, bounded.texts)) == [10] * 25 + [1000] * 4
    assert set(bounded.texts) <= set(whole.texts)
    one = labelled.training_sample(docs, labels, "quality", 25, most_bytes=1)
    assert sorted(map(len, one.texts)) == [10, 1000]
