import hashlib
import random

import numpy as np
import pytest

from tagloom.llm import alignment
from tagloom.llm.tokens import vocabulary

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, groups int, radix string"


def plain_tokens(text):
    """Ids and bytes of both tokenizers as the libraries give them, None if they differ from the text's."""
    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in shown}
    for i, c in enumerate(c for c in range(256) if c not in shown):
        byte[chr(256 + i)] = c
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    data = (" " + text).encode()
    return (ids_a, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == data == b"".join(bytes_b) else None


def plain_align(rows):
    links, out = [], []
    for doc_id, text in rows:
        found = plain_tokens(text) if text else None
        links.append([])
        if found is None:
            out.append([doc_id, 0, 0, 0, 0, 0, 0, ""])
            continue
        ids_a, bytes_a, ids_b, bytes_b = found
        ends_a, ends_b = ([0, *np.cumsum([len(t) for t in ts]).tolist()] for ts in (bytes_a, bytes_b))
        for i, x in enumerate(ids_a):
            links[-1] += [(x, y) for j, y in enumerate(ids_b) if ends_a[i] < ends_b[j + 1] and ends_b[j] < ends_a[i + 1]]
        cuts = sorted(set(ends_a) & set(ends_b))
        written = []
        for s, e in zip(cuts, cuts[1:]):
            own = [",".join(str(t) for t, at in zip(ids, ends) if s <= at < e) for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))]
            written.append("|".join(own))
        out.append([doc_id, len(ids_a), len(ids_b), len(written), len(links[-1]), 0, 0, ";".join(written)])
    count = {}
    for own in links:
        for pair in set(own):
            count[pair] = count.get(pair, 0) + 1
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    for own, row in zip(links, out):
        row[5] = sum(count[p] == best[p[0]] for p in own)
        row[6] = sum(count[p] for p in own)
    return sorted(map(tuple, out), key=repr)


def found(spark, rows, parts=3, **settings):
    df = spark.createDataFrame([(i, t, "x", 0, "") for i, t in rows], SCHEMA).repartition(parts)
    got = alignment.align(df, A, B, **settings)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  x  "), (5, "a b"), (5, "a b"), (None, "no id here"), (6, "\n\n a\tb\r\n"), (7, "has▁mark"),
    (8, "<s>hi</s> <|endoftext|> <unk>"), (9, "中文 text é é \U0001f600"), (10, "nul\x00byte"), (11, " wide　 space "),
    (12, "word " * 3000), (13, "x" * 4000), (14, "don't we'll I'M 1234567 ½ ²"), (15, "\n"), (16, " \n \n"), (17, "<0x41>"),
]


def test_odd_texts_equal_the_plain_version(spark):
    rows = [(i, t) for i, t in ODD if t is None or len(t) < 5000]
    assert found(spark, rows) == plain_align(rows)


@pytest.mark.parametrize("chunk,part", [(1 << 21, 1 << 22), (40, 25), (1, 1)])
def test_counts_over_chunks_and_parts(spark, chunk, part):
    rng = random.Random(3)
    words = ["the", "The", "tion", "über", "a", "b", ",", "\n", "x1", "  ", "éa", "zzzq"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))) for i in range(120)]
    rows += [(500 + i, "the same words, over and over") for i in range(80)]
    assert found(spark, rows, chunk_records=chunk, part_records=part) == plain_align(rows)


def test_long_text_digest_and_empty_table(spark):
    [row] = found(spark, [(12, "word " * 30000)], digest=True)
    assert row[1:4] == (30001, 30001, 30001) and row[5] == row[4] == row[6]
    [plain] = found(spark, [(12, "word " * 30000)])
    assert row[7] == hashlib.sha256(plain[7].encode()).hexdigest()
    assert found(spark, []) == []


def test_looked_up_pieces_equal_the_model():
    model, pieces = sentencepiece.SentencePieceProcessor(model_file=B), alignment.Pieces(B)
    rng = random.Random(5)
    alphabet = "ab é\n\t ,.ſ中  ́"
    for _ in range(600):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40)))
        spaced = " " + text
        assert pieces(spaced, spaced.encode()).tolist() == model.encode(text), repr(text)


def test_merge_holds_one_block_of_each_run():
    rng = np.random.default_rng(2)
    lists = [np.unique(rng.integers(0, 400, 90)) for _ in range(7)]

    def blocks(a):
        for s in range(0, len(a), 5):
            yield (a[s : s + 5], np.ones(len(a[s : s + 5]), np.int64)), None

    total, last = {}, -1
    for out in alignment.merge_runs([blocks(a) for a in lists]):
        pairs = np.concatenate([c[0] for _, c, _ in out])
        assert pairs.min() > last
        last = pairs.max()
        for p in pairs.tolist():
            total[p] = total.get(p, 0) + 1
    expected = np.unique(np.concatenate(lists), return_counts=True)
    assert total == dict(zip(*(e.tolist() for e in expected)))
