"""Operators on single texts, against brute force and the libraries."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
import pytest
import sentencepiece
from tokenizers import Tokenizer

from heliovane.llm import decontaminate, langid, licenses, queries, sentencepieces, tokencounts
from heliovane.llm.common import Memo
from heliovane.llm.orctokens import WordEncoder
from tests.llm.helpers import ODD, SF, documents, texts, words


def brute_windows(items, window=10):
    out = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else []:
            out.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    return out


def brute_hits(text, windows):
    w, hit, items = words(text), set(), set()
    for n in {len(k) for k in windows}:
        for i in range(len(w) - n + 1):
            found = windows.get(tuple(w[i : i + n]))
            if found:
                hit |= set(range(i, i + n))
                items |= found
    return len(w), len(hit), sorted(items)


ITEMS = [(1, "a b c d e f g h i j k l"), (10, "Short, item"), (2, None), (3, "..."), (None, "c d e f g h i j k l m"), (4, "a b c d e f g h i j k l"), (4, "a b c d e f g h i j k l")]


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 40])
def test_windows_against_brute_force(spark, block_chars):
    rows = ODD + [(20, "x A-b c d e f g h i j K l m y"), (21, "short ITEM short item"), (22, "a b c d e f g h i"), (20, "x A-b c d e f g h i j K l m y"), (None, "short item")]
    found = decontaminate.decontaminate(texts(spark, rows), texts(spark, ITEMS, "item_id long, text string"), block_chars=block_chars)
    windows = brute_windows(ITEMS)
    want = []
    for key, text in rows:
        n, hit, items = brute_hits(text, windows)
        want.append((key, n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0))
    got = [tuple(r) for r in found.drop("spans", "items").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_spans_point_into_the_original(spark):
    text = "Eh… intro: A,b;C d e f g h i j k-L! end"
    row = decontaminate.find_windows(texts(spark, [(1, text)]), texts(spark, ITEMS, "item_id long, text string")).first()
    assert [text[s["char_start"] : s["char_end"]] for s in row["spans"]] == ["A,b;C d e f g h i j k-L"]
    assert row["spans"][0]["first_word"] == 2 and row["items"] == ["", "1", "4"]


def test_decontamination_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    want = con.execute(queries.ORACLES["op2_decontaminate"]).df().sort_values("doc_id").reset_index(drop=True)
    got = queries.op2_decontaminate(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert want.n_hit.sum() > 0
    assert got[want.columns].equals(want)


def test_license_base_phrases(spark):
    rows = ODD + [
        (30, "Apache   LICENSE, apache license. CC-BY cc by CC BYE gnu general public license-3 smit license"),
        (31, "SPDX-License-Identifier: GPL-2.0-or-later"), (32, "licensed under the Apache License, Version 2.0"), (33, "apache-licensed"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(texts(spark, rows), carry=False).collect()}
    for key, text in rows:
        w, places, labels = words(text), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[key]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(r["labels"].split(",")) | (set() if labels else {""}) and 0 <= r["score"] <= 1
    assert got[31]["labels"] == "gpl-2.0" and got[32]["labels"] == "apache,apache-2.0" and got[33]["score"] == 0


def test_license_rules_and_suppression():
    known = licenses.rules()
    assert len(known) >= 200
    scanner = licenses.Scanner()
    samples = {
        "gnu lesser general public license version 2 1": "lgpl-2.1", "Simplified BSD License": "bsd-2-clause", "the ISC license": "isc", "Mozilla Public License, v. 2.0": "mpl-2.0",
        "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa", "CC0 1.0 Universal": "cc0-1.0", "SIL Open Font License": "ofl-1.1", "provided under the zlib license": "zlib",
    }
    for text, label in samples.items():
        assert label in scanner.scan(text.encode())[5].split(","), text
    found = [(40, 0, 10, 0), (60, 0, 12, 1), (40, 11, 20, 2), (40, 11, 20, 3), (40, 12, 20, 4), (60, 5, 9, 5)]
    assert licenses.accepted(found) == [(60, 0, 12, 1), (40, 11, 20, 2)]
    rng = random.Random(3)
    for _ in range(200):
        some = [(rng.choice((40, 60)), a, a + rng.randint(1, 8), i) for i, a in enumerate(rng.choices(range(20), k=8))]
        kept = []
        for one in sorted(some, key=lambda f: (-f[0], f[1] - f[2], f[1], f[3])):
            if not any(k[1] <= one[1] and k[2] >= one[2] for k in kept):
                kept.append(one)
        assert licenses.accepted(some) == sorted(kept, key=lambda k: (k[1], k[2], k[3]))


def test_every_keyword_is_needed_by_its_rule():
    """A rule never matches a line that holds none of its keywords, tried on the quoted patterns' own words."""
    scanner = licenses.Scanner()
    for rule in scanner.rules:
        line = " " + rule.pattern.pattern.removeprefix("(?<= )(?:").removesuffix(")(?= )") + " "
        if not set(line) & set("()[]?|"):
            assert rule.pattern.search(line) and any(k in line for k in rule.keywords), rule.label


def brute_phrases(codes, sample, piece):
    count = 0
    for at in range(0, len(codes), piece):
        part, i = codes[at : at + piece], 0
        while i < len(part):
            n = 1
            while i + n < len(part) and bytes(part[i : i + n + 1]) in sample:
                n += 1
            count += 1
            i += n if bytes(part[i : i + 1]) in sample else 1
    return count


def test_phrases_against_brute_force():
    rng = random.Random(1)
    sample = {lang: "".join(rng.choices(letters, k=400)) for lang, letters in (("x", "aab c"), ("y", "bcd  e"))}
    parser = langid.CrossParser(sample, letters=4)
    raws = ["".join(rng.choices("abcde zé!\n", k=rng.randint(0, 90))).encode() for _ in range(60)] + [b"", "ÄÖ".encode()]
    counts, sizes, has = parser.phrases(raws, piece=16)
    for k, raw in enumerate(raws):
        codes, n = parser.codes([raw])
        assert sizes[k] == n[0] == len(codes) and has[k] == any(ch.isalpha() for ch in raw.decode())
        for j, lang in enumerate(parser.names):
            trained = bytes(parser.codes([sample[lang].encode()])[0])
            assert counts[k, j] == brute_phrases(codes, trained, 16)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in documents(spark, sf).select("doc_id", "lang").collect()}
    got = queries.op4_language_id(spark, sf).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_without_letters_or_labels(spark):
    got = {r["doc_id"]: r for r in langid.identify(texts(spark, ODD), {"x": "one two three", "y": "fox dog"}).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (0, 1, 2, 5)) and got[3]["lang_pred"] == "x"
    assert all(r["lang_pred"] == "und" for r in langid.identify(texts(spark, ODD), {}).collect())
    labelled = texts(spark, [(1, "aa", None), (2, None, "x"), (None, "bb", "x"), (3, "cc", "y")], "doc_id long, text string, lang string")
    assert langid.labelled_sample(labelled, F.lit(True), "doc_id", "text", "lang") == {"y": " cc"}


def brute_pieces(marked, vocabulary):
    n = 0
    while marked:
        size = next((k for k in range(len(marked), 0, -1) if marked[:k] in vocabulary), 0)
        if not size:
            return 0
        marked, n = marked[size:], n + 1
    return n


def test_token_counts_against_greedy_matching(spark):
    rng = random.Random(2)
    for _ in range(150):
        vocabulary = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 14))}
        vocabulary |= {"▁" + "".join(rng.choices("abc", k=rng.randint(0, 4))) for _ in range(4)}
        automaton = tokencounts.LongestMatch(list(vocabulary))
        for _ in range(60):
            word = "▁" + "".join(rng.choices("abc", k=rng.randint(0, 9)))
            assert automaton.count(word) == brute_pieces(word, vocabulary), (word, vocabulary)
    known = set(tokencounts.marked_vocabulary(queries.PIECES))
    got = [tuple(r) for r in tokencounts.count_tokens(texts(spark, ODD), queries.PIECES).collect()]
    for (key, text), row in zip(ODD, got, strict=True):
        parts = (text or "").replace("▁", " ").encode().split()
        counts = [brute_pieces("▁" + p.decode(), known) for p in parts]
        assert row == (key, len(parts), sum(c or 1 for c in counts), counts.count(0))


ALPHABET = list("ab  \n\t▁.,'s't<>É ß éç ñ İ σς 　́\U0001f600 09 \x00\x1c\x7f") + ["<|endoftext|>", "<s>", "</s>", "'ll", "A", "the ", " thing", "ª", "×"]


def test_pieces_equal_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    known, rng = sentencepieces.Pieces(queries.PIECES), random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 14)))
        assert known.encode(text.encode()) == sp.encode(text)
        ids = rng.choices([0, 1, 2, 3, 50, 131, 200, 259, 264, 28705, 300, 229, 132], k=rng.randint(0, 6))
        assert known.decode(ids) == sp.decode(ids)
    rows = ODD + [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    got = [tuple(r) for r in sentencepieces.round_trip(texts(spark, rows), queries.PIECES).collect()]
    want = []
    for key, text in rows:
        ids = sp.encode(text or "")
        want.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)
    encoded = sentencepieces.encode(texts(spark, ODD), queries.PIECES)
    assert [r["text"] for r in sentencepieces.decode(encoded, queries.PIECES).collect()] == [sp.decode(sp.encode(t or "")) for _, t in ODD]


def test_words_equal_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    mine, theirs, rng = WordEncoder(path), Tokenizer.from_file(path), random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 14)))
        assert np.frombuffer(mine.encode(text.encode()), "<i4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_memo_is_bounded_and_right():
    calls = []
    memo = Memo(lambda k: calls.append(k) or len(k), limit=8, longest=5)
    for k in ["a", "bb", "a", "ccc", "toolong", "toolong", *(str(i) for i in range(30)), "a"]:
        assert memo[k] == len(k)
    assert len(memo) + len(memo.older) <= 8 and calls.count("toolong") == 2
