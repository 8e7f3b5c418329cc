import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import convnet, labelled, subwords
from tagloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"
present = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")
ODD = [None, "", " \n", "a", "word " * 50_000, "퟿ é 中文 \U0001f600"]


def toy(n=300, seed=1):
    rng = np.random.default_rng(seed)
    texts, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(300)}" for _ in range(rng.integers(5, 40))]
        if i % 3 == 0:
            words[rng.integers(len(words))] = rng.choice(["vilest", "viles", "vile"])
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, np.array(labels)


def test_convnet_finds_single_words_and_scores_any_text():
    texts, labels = toy()
    langs = [["en", "fr", None][i // 3 % 3] for i in range(len(texts))]
    model = convnet.train(texts, labels, np.ones(len(texts)), langs, buckets=1 << 12)
    scores = convnet.Scorer(model)(texts)
    assert ((scores >= 0.5) == labels).mean() > 0.97
    assert None in model.thresholds and set(model.thresholds) <= {None, "en", "fr"}
    odd = convnet.Scorer(model)(ODD)
    assert ((odd >= 0) & (odd <= 1)).all() and odd[0] == odd[1] == odd[2]
    hidden = convnet.Scorer(model)(["w1 " * 100_000 + "vilest", "w1 " * 100_000])
    assert hidden[0] > 0.5 > hidden[1]  # at the very end of a long text


def test_convolution_equals_the_plain_one(monkeypatch):
    monkeypatch.setattr(convnet, "_CHUNK", 7)
    rng = np.random.default_rng(2)
    model = convnet.Model(
        rng.normal(size=(64, 4)), [rng.normal(size=(w, 4, 3)) for w in convnet.WIDTHS], rng.normal(size=9),
        rng.normal(size=9), 0.3, {None: 0.5},
    )
    texts = ["a b c d e f g h i j k l m n o p", "a", "b a", ""]
    for text, got in zip(texts, convnet.Scorer(model)(texts)):
        words = convnet.words_of(text)
        rows = [model.vectors[b].mean(0) for b in convnet.parts(words, 64)] if words else [np.zeros(4)]
        rows += [np.zeros(4)] * 2
        best = []
        for w, f in zip(convnet.WIDTHS, model.filters):
            for k in range(3):
                best.append(max(sum(rows[i + o] @ f[o, :, k] for o in range(w)) for i in range(len(rows) - 2)))
        hidden = np.maximum(np.array(best) + model.offsets, 0)
        assert got == pytest.approx(1 / (1 + np.exp(-(hidden @ model.out + 0.3))), rel=1e-4)


def test_subwords_equal_the_plain_average():
    rng = np.random.default_rng(3)
    model = subwords.Model(rng.normal(size=1 << 8), -0.2)
    text = "one two two\nthree é one\none two two"
    counts = subwords.word_counts(text)
    assert counts["two"] == 4 and counts[subwords.SAME] == 3 and counts[subwords.SEEN] == 5
    total = parts = 0
    for word, n in counts.items():
        ids, _ = subwords.features([word], 1 << 8)
        assert len(ids) == 1 + sum(max(0, len(word) + 2 - k + 1) for k in (3, 4, 5))
        total, parts = total + n * model.logit[ids].sum(), parts + n * len(ids)
    assert subwords.Scorer(model)([text])[0] == pytest.approx(1 / (1 + np.exp(0.2 - total / parts)))


def test_subwords_learn_and_score_any_text():
    texts, labels = toy(300)
    texts = [t.upper() if y else t for t, y in zip(texts, labels)]
    model = subwords.train(texts, labels, np.ones(len(texts)), buckets=1 << 12)
    assert ((subwords.Scorer(model)(texts) >= 0.5) == labels).mean() > 0.97
    odd = subwords.Scorer(model)(ODD)
    assert ((odd >= 0) & (odd <= 1)).all() and odd[0] == odd[1] == odd[2]
    alone = subwords.train(texts[:3], np.ones(3, int), np.ones(3))
    assert 0 < subwords.Scorer(alone)(["x"])[0] < 1
    assert len(subwords.Scorer(subwords.train([], np.zeros(0, int), np.zeros(0)))([])) == 0


def test_sample_is_bounded_and_deterministic(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "x") for i in range(50)] + [(3, None, None, "x")], "doc_id long, text string, lang string, _y string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(2, 1), (4, None), (None, 1), (99, 1)], "doc_id long, quality int")
    one = labelled.training_sample(docs, labels, "quality", 10, lang="lang")
    two = labelled.training_sample(docs.repartition(5), labels, "quality", 10, lang="lang")
    assert one.texts == two.texts and 18 <= len(one.texts) <= 20 and one.weights.mean() == pytest.approx(1, abs=0.1)
    assert "t2" not in [t for t, y in zip(one.texts, one.labels) if y == 0]  # the larger of repeated labels counts
    none = labelled.training_sample(docs, labels.limit(0), "quality", 10)
    assert none.texts == []
    import zlib

    flags = {r.i: r.h for r in spark.range(100).select(F.col("id").alias("i"), labelled.held_out(F.col("id"), 5, 0).alias("h")).collect()}
    assert flags == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(100)}
    assert spark.range(1).select(labelled.held_out(F.lit(None).cast("long"), 5, 0).alias("h")).first().h is False


def test_scores_of_nulls_repeats_empty_and_clashing_names(spark):
    schema = "c0 long, text string, score string, t int"
    rows = [(1, None, "a", 1), (1, None, "a", 1), (None, "word", None, None)]
    for score, model in (
        (subwords.score, subwords.Model(np.ones(8), 0.0)),
        (convnet.score, convnet.train([], np.zeros(0, int), np.zeros(0), [], buckets=8)),
    ):
        found = score(spark.createDataFrame(rows, schema), model, keep=("c0", "t")).collect()
        assert len(found) == 3 and all(0 <= r.score <= 1 for r in found)
        assert score(spark.createDataFrame([], schema), model, keep=("c0",)).collect() == []


@present
@pytest.mark.parametrize("name,label,least", [("op3_quality", "quality", 0.98), ("op10_toxicity", "toxic", 0.94)])
def test_held_out_accuracy(spark, name, label, least):
    found = QUERIES[name](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    row = found.filter("held_out").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("right")).first()
    assert row.n > 500 and row.right >= least


def test_score_may_have_any_name(spark):
    texts, labels = toy(60)
    model = convnet.train(texts, labels, np.ones(len(texts)), [None] * len(texts), buckets=1 << 10, epochs=1)
    docs = spark.createDataFrame([("good", 7)], "text string, score int")
    row = convnet.score(docs, model, keep=("score",), name="own").first()
    assert row.score == 7 and 0 <= row.own <= 1


def tables_of(spark, n, seed=1):
    texts, y = toy(n, seed)
    docs = [(i, t, ["en", "fr", None][i % 3]) for i, t in enumerate(texts)]
    odd = [(3, None, "en"), (None, "vile", "en"), (5, "~later", "en"), (n + 1, "not labelled", "en"), (n + 2, None, "en")]
    labels = [(i, int(v)) for i, v in enumerate(y)] + [(4, 1), (7, None), (None, 1), (n + 2, 1), (n + 3, 0)]
    return (spark.createDataFrame(docs + odd, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int"), texts, y)


def test_blocks_hold_every_labelled_document_once(spark):
    docs, labels, texts, y = tables_of(spark, 300)
    cut = lambda t: (t.encode(), b"")
    for size, most in ((4096, 1 << 24), (40, 1 << 24), (40, 500)):
        blocks = labelled.training_blocks(docs, labels, "toxic", cut, lang="lang", size=size, most_bytes=most)
        found = [d for r in blocks.collect() for d in r.docs]
        assert sorted((d.a.decode(), d.y) for d in found) == sorted((t, 1 if i == 4 else int(v)) for i, (t, v) in enumerate(zip(texts, y)))
        assert 30 < sum(d.held for d in found) < 90
        again = labelled.training_blocks(docs.repartition(7), labels.repartition(3), "toxic", cut, lang="lang", size=size, most_bytes=most)
        assert sorted(map(repr, again.collect())) == sorted(map(repr, blocks.collect()))
        assert most > 500 or all(len(r.docs) == 1 or sum(len(d.a) for d in r.docs) <= most for r in blocks.collect())
    assert labelled.training_blocks(docs, labels.limit(0), "toxic", cut).collect() == []


def test_fit_over_blocks_learns_from_every_text(spark):
    docs, labels, _, _ = tables_of(spark, 900)
    unseen, y = toy(200, seed=9)
    for size in (2000, 200):
        blocks = labelled.training_blocks(docs, labels, "toxic", lambda t: convnet.packed(t, 1 << 12), lang="lang", size=size)
        model = convnet.fit(blocks, buckets=1 << 12)
        assert ((convnet.Scorer(model)(unseen) >= 0.5) == y).mean() > 0.95
        assert None in model.thresholds and set(model.thresholds) <= {None, "en", "fr"}
    same = convnet.fit(blocks, buckets=1 << 12)
    assert np.allclose(same.vectors, model.vectors, atol=1e-5) and same.thresholds.keys() == model.thresholds.keys()
    alone = convnet.fit(labelled.training_blocks(docs, labels.filter("toxic = 1"), "toxic", convnet.packed))
    assert alone.thresholds == {None: 0.5}
    none = convnet.fit(labelled.training_blocks(docs, labels.limit(0), "toxic", convnet.packed))
    assert 0 <= convnet.Scorer(none)(["x"])[0] <= 1


def test_toxicity_is_fitted_on_no_sample(spark, monkeypatch, tmp_path):
    docs, labels, _, _ = tables_of(spark, 60)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(labelled, "training_sample", None)
    seen, fit = [], convnet.fit
    monkeypatch.setattr(convnet, "fit", lambda blocks, **k: seen.append(blocks.selectExpr("sum(size(docs))").first()[0]) or fit(blocks, **k))
    assert QUERIES["op10_toxicity"](spark, str(tmp_path)).count() == docs.count()
    import zlib

    assert seen == [sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(60))]


def test_rows_of_blocks_are_small_and_each_hash_has_a_file(spark):
    docs = spark.range(2000).selectExpr("id doc_id", "repeat(cast(id as string), 100) text", "cast(null as string) lang")
    labels = spark.range(2000).selectExpr("id doc_id", "cast(id % 2 as int) toxic")
    cut = lambda t: (t.encode() * 10, b"x")
    blocks = labelled.training_blocks(docs, labels, "toxic", cut, size=250, most_bytes=1 << 20)
    sizes = blocks.selectExpr("aggregate(docs, 0L, (n, d) -> n + length(d.a))").collect()
    assert max(n for n, in sizes) <= 1 << 18
    files = blocks.selectExpr("block >> 8 AS s", "input_file_name() AS f").distinct().collect()
    assert len(files) == 8 == len({r.f for r in files})
    rows = blocks.collect()
    for held in (False, True):
        batches = blocks.toArrow().to_batches(max_chunksize=2)
        found = list(labelled.block_rows(iter(batches), held))
        assert [x[0] for x in found] == [r.block for r in rows if r["last"]]
        assert [t for *_, texts in found for t in texts] == [(bytes(d.a), b"x") for r in rows for d in r.docs if d.held == held]
        assert all(len(y) == len(langs) == len(texts) for _, y, langs, texts in found)


def test_an_epoch_shuffles_as_much_for_more_blocks_and_leaves_nothing(spark, monkeypatch):
    import glob
    import tempfile

    from pyspark.sql.classic.dataframe import DataFrame

    docs, labels, _, _ = tables_of(spark, 600)
    seen, plain = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, *a, **k: seen.append(self.rdd.getNumPartitions()) or plain(self, *a, **k))
    blocks = labelled.training_blocks(docs, labels, "toxic", lambda t: convnet.packed(t, 1 << 8), size=20)
    seen.clear()
    shuffled = lambda: set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))
    before, settings = shuffled(), {k: spark.conf.get(k, None) for k in labelled.OVER_BLOCKS}
    convnet.fit(blocks, epochs=2, buckets=1 << 8)
    cores = spark.sparkContext.defaultParallelism
    assert len(blocks.inputFiles()) == 31 > cores and len(seen) == 3 and max(seen[:2]) <= cores
    assert not shuffled() - before
    assert settings == {k: spark.conf.get(k, None) for k in labelled.OVER_BLOCKS}


def test_numbers_are_those_of_unique():
    number = convnet._Numbers(50)
    for values in ([3, 0, 3, 49], [7], [], [1, 1, 0]):
        values = np.array(values, np.int64)
        for got, want in zip(number(values), np.unique(values, return_inverse=True)):
            assert got.tolist() == want.tolist()


def test_texts_are_read_in_the_splits_of_the_session(spark, monkeypatch):
    docs, labels, _, _ = tables_of(spark, 60)
    seen, plain = [], labelled.materialise

    def spy(df):
        seen.append([spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.parquet.columnarReaderBatchSize")])
        return plain(df)

    before = [spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.parquet.columnarReaderBatchSize")]
    monkeypatch.setattr(labelled, "materialise", spy)
    labelled.training_blocks(docs, labels, "toxic", convnet.packed)
    assert seen == [before]
