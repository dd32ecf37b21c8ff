"""Perfect hashing and token alignment against the tokenizers themselves."""

from collections import Counter
import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from heliovane.llm import alignment, queries
from heliovane.llm.perfecthash import PerfectHash, ShardedHash
from tests.llm.helpers import ODD, SF, texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    signs = alignment.byte_signs()
    spelled = {i: bytes(signs[c] for c in t) for t, i in json.load(open(A))["model"]["vocab"].items() if t != "<|endoftext|>"}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    pieces = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.vocab_size())]
    return a, spelled, b, pieces


def brute(rows):
    """Rows (doc_id, text) to the contract's rows, token by token."""
    a, spelled, b, pieces = libraries()
    found, docs = [], Counter()
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if b"".join(spelled[i] for i in ids_a) != whole or b"".join(pieces[i] for i in ids_b) != whole:
            ids_a, ids_b = [], []
        spans = []
        for ids, names in ((ids_a, spelled), (ids_b, pieces)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(names[i]), i))
                at += len(names[i])
            spans.append(out)
        links, j = [], 0
        for start, end, i in spans[0]:
            while j and spans[1][j][0] >= start:
                j -= 1
            while spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < end:
                links.append((i, spans[1][k][2]))
                k += 1
            j = min(k, len(spans[1]) - 1)
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, at = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for s, e, i in side if at <= s and e <= end) for side in spans))
            at = end
        docs.update(set(links))
        found.append((ids_a, ids_b, groups, links))
    best = Counter()
    for (i, _), n in docs.items():
        best[i] = max(best[i], n)
    return [
        (doc_id, len(x), len(y), len(groups), len(links), sum(docs[l] == best[l[0]] for l in links), sum(docs[l] for l in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for (doc_id, _), (x, y, groups, links) in zip(rows, found)
    ]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 63, 1000, 200_000):
        keys = np.unique(rng.integers(0, 1 << 62, n))
        index = ShardedHash([PerfectHash(keys)])
        assert np.array_equal(np.sort(index.find(keys)), np.arange(len(keys)))
        others = np.setdiff1d(rng.integers(0, 1 << 62, 1000), keys)
        assert (index.find(others) == -1).all()
    shard = ShardedHash.shard_of(keys, 7)
    index = ShardedHash([PerfectHash(keys[shard == i]) for i in range(7)])
    assert np.array_equal(np.sort(index.find(keys)), np.arange(len(keys))) and np.array_equal(index.keys[index.find(keys)], keys)
    assert (index.find(others) == -1).all()
    bits = sum(size for levels in index.levels for size, _, _ in levels)
    assert bits < 4 * len(keys)


def test_chunks_give_the_libraries_tokens():
    a, _, b, _ = libraries()
    known, rng = alignment.aligner(A, B), random.Random(3)
    signs = ["a", "of", "Zé", "'s", "12", " ", " ", "  ", "\n", "\t", "\x0b", "\x85", " ", "　", " ", "​", "\x1c", "日本", "\U0001f600", ".", "<s>", "<|endoftext|>", "\x00", "�", "ﬁ", "é"]
    for _ in range(4000):
        text = "".join(rng.choices(signs, k=rng.randint(1, 14)))
        parts = [known.tokens(p) for p in known.parts(text.encode())]
        assert [i for x, _ in parts for i in x] == a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert [i for _, y in parts for i in y] == b.encode(text), repr(text)


def test_chunks_that_left_the_table_are_aligned_again():
    known, words = alignment.Aligner(A, B), [f" w{i}x" for i in range(40)]
    known.chunks.half = 5
    whole = "".join(words[i % 40] for i in range(0, 400, 7))[1:].encode()
    assert known([whole, whole]) == [alignment.Aligner(A, B)([whole])[0]] * 2


def test_groups_of_one_text(spark):
    (row,) = alignment.align(texts(spark, [(1, "Unbelievable naïveté, 日本")]), A, B).collect()
    _, spelled, _, pieces = libraries()
    for group in row["groups"]:
        assert b"".join(spelled[i] for i in group["a"]) == b"".join(pieces[i] for i in group["b"])
    assert b"".join(spelled[i] for g in row["groups"] for i in g["a"]).decode() == " Unbelievable naïveté, 日本"


@pytest.mark.parametrize("dense", [alignment.DENSE_KEYS, 40, 1])
def test_summary_against_the_libraries(spark, dense):
    rng = random.Random(7)
    words = ["the", "The", "été", "antidis", "establish", "mentarianism", "日本語", "x▁y", "\n", "  ", "\U0001f600", "a b", "12", "it's"]
    rows = ODD + [(100 + i, " ".join(rng.choices(words[:7] + words[8:], k=rng.randint(0, 30)))) for i in range(60)] + [(500, "x▁y"), (501, " \n  \n "), (502, "a \n  b"), (503, " "), (504, "\n")]
    got = alignment.summarize(texts(spark, rows), A, B, dense_keys=dense).collect()
    assert ordered(got) == ordered(brute(rows))


def test_query_against_the_libraries(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_token_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ordered(got.collect()) == ordered(brute([(r["doc_id"], r["text"]) for r in docs]))


def test_dense_counts_equal_grouped_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    runs = alignment.pair_runs(docs, A, B)
    wanted = {(r["a"], r["b"]): r["docs"] for r in alignment.link_counts(docs, A, B).collect()}
    keys = runs.select("pair").distinct()
    index = alignment.hashed(keys, keys.count())
    counts, width = alignment.dense_counts(runs, index), alignment.vocabulary_size(B)
    assert {(int(k) // width, int(k) % width): int(c) for k, c in zip(index.keys, counts)} == wanted


def test_long_texts_empty_tables_and_other_columns(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HELD_PAIRS", 50)
    rows = [(1, "ab" * 500_000), (2, "word " * 300_000), (3, "a\n" * 100_000), (4, " " * 200_000), (5, "  x" * 50_000)]
    got = {r["doc_id"]: r for r in alignment.summarize(texts(spark, rows), A, B).collect()}
    assert got[2]["n_groups"] == got[2]["n_a"] > 299_999 and all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] > 0 for r in got.values())
    assert alignment.summarize(texts(spark, []), A, B).collect() == []
    clash = spark.createDataFrame([(1, "one two", 5, 5, 5, "h"), (2, None, 5, 5, 5, "h")], "doc_id int, text string, row int, pair int, n_a int, head string")
    assert ordered(alignment.summarize(clash, A, B).collect()) == ordered(brute([(1, "one two"), (2, None)]))


@pytest.mark.parametrize("dense", [alignment.DENSE_KEYS, 5])
def test_texts_are_read_and_aligned_once(spark, dense):
    rows = [(i, f"word the Word {i % 7} {i} été") for i in range(50)] + [(900, None), (901, "x y " * 2000)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = texts(spark, rows).select("doc_id", "text")
    got = alignment.summarize(docs.mapInArrow(counted, docs.schema), A, B, dense_keys=dense).collect()
    assert read.value == len(rows)
    assert ordered(got) == ordered(brute(rows))


def test_pairs_are_looked_up_some_at_a_time(monkeypatch):
    monkeypatch.setattr(alignment, "LOOKED_UP", 10)
    sizes = [5, 0, 3, 7, 0, 100, 1, 0]
    batch = pa.RecordBatch.from_arrays([pa.array(sizes), pa.array([np.arange(n, dtype=t).tobytes() for n, t in zip(sizes, [np.uint8, np.uint32] * 4)], pa.binary())], names=["distinct", "pairs"])
    some = list(alignment._some_pairs(batch))
    assert [b.column("distinct").to_pylist() for b in some] == [[5, 0, 3], [7, 0], [100, 1, 0]]
    found = np.concatenate([alignment._numbers(b.column("pairs"), b.column("distinct").to_numpy()) for b in some])
    assert found.tolist() == [i for n in sizes for i in range(n)]
    assert list(alignment._some_pairs(batch.slice(0, 0))) == []
