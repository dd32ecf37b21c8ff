"""Fingerprints, likeness, Hamming links and components, against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from heliovane.llm import minhash, queries, simhash
from heliovane.session import settle
from tests.llm.helpers import LOW, ODD, SF, documents, texts, words


def brute_simhash(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if x]
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles)) if shingles else 0


def brute_components(prints, radius=4):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_query_against_brute_force(spark):
    rows = documents(spark).select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_simhash(r["text"]) for r in rows]
    roots = brute_components(prints)
    want = {(r["doc_id"], f"{p:016x}", rows[root]["doc_id"]) for r, p, root in zip(rows, prints, roots, strict=True)}
    assert len(set(roots)) < len(rows)
    assert {tuple(r) for r in queries.op7_simhash(spark, SF).collect()} == want


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicates(texts(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[0]["fingerprint"] == by[2]["fingerprint"] == "0" * 16 and by[0]["component_id"] == by[1]["component_id"] == 0
    assert by[None]["component_id"] is None and by[None]["fingerprint"] == f"{brute_simhash('a null id'):016x}"
    assert simhash.near_duplicates(texts(spark, [])).collect() == []


def planted_prints(seed, centers=6, each=40):
    rng, out = random.Random(seed), set()
    for _ in range(centers):
        center = rng.getrandbits(64)
        for _ in range(each):
            x = center
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            out.add(x)
    return sorted(out | {rng.getrandbits(64) for _ in range(100)} | {0, 15, 31, 2**64 - 1})


@pytest.mark.parametrize(("blocks", "split"), [(6, 4096), (6, 8), (5, 16)])
def test_components_of_links_are_exact(spark, blocks, split):
    prints = planted_prints(blocks)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = settle(simhash.components(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), blocks=blocks, split=split)))
    root = {r["node"]: r["root"] for r in found.collect()}
    of = brute_components(prints)
    groups = {}
    for s, r in zip(signed, of, strict=True):
        groups.setdefault(r, set()).add(s)
    got = {}
    for s in signed:
        got.setdefault(root.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_bit_sliced_distances():
    rng = np.random.default_rng(7)
    values = rng.integers(0, 1 << 63, 200, np.uint64) * np.uint64(2)
    values[50:120] = values[0] ^ (np.uint64(1) << rng.integers(0, 64, 70).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 70).astype(np.uint64))
    query, word = np.repeat(np.arange(200), 4), np.tile(np.arange(4), 200)
    for radius in (1, 2, 4, 7):
        near = simhash.within_radius(values, simhash._planes(values), query, word, radius)
        for q, w, bits in zip(query.tolist(), word.tolist(), near.tolist(), strict=True):
            for lane in range(64):
                if w * 64 + lane < 200:
                    assert bool(bits >> lane & 1) == ((int(values[q]) ^ int(values[w * 64 + lane])).bit_count() <= radius)


def test_chain_of_links_is_one_component(spark):
    edges = [(i + 1, i) for i in range(300)] + [(1000, 999), (7, 7)]
    root = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {root[i] for i in range(301)} == {0} and root[1000] == root[999] == 999
    assert simhash.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("hub", [-1, 500, 10_000])
def test_hub_and_random_links(spark, hub):
    """A hub below, among and above its neighbours, beside random links, with repeated and turned edges."""
    rng = random.Random(hub)
    edges = [(hub, i) for i in range(0, 400, 2)] + [(i, hub) for i in range(0, 400, 40)] * 2
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(220)]
    parent = {x: x for edge in edges for x in edge}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    loose = {x for x in parent if all(a == b for a, b in edges if x in (a, b))}  # only linked to themselves
    assert found == {x: find(x) for x in parent if x not in loose}


def test_keep_one_of_each_group(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 8
    rows = [(9, text, "z"), (3, text, "x"), (3, text, "x"), (5, "another text of its own entirely here", "y"), (None, "no id at all but kept", "n"), (None, text, "q"), (8, None, None), (7, "", None)]
    docs = texts(spark, rows, "doc_id long, text string, fp string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([(3, text, "x"), rows[3], rows[4], (7, "", None)], key=str)


def true_likeness(a, b):
    def shingles(text):
        w = words(text)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_fingerprints_against_true_similarity(spark):
    rows = documents(spark).select("doc_id", "text").orderBy("doc_id").collect()
    got = queries.op6_fingerprints(spark, SF).orderBy("doc_id").collect()
    errors, by_text = [], {}
    for i, (row, result) in enumerate(zip(rows, got, strict=True)):
        after = rows[(i + 1) % len(rows)]["text"]
        changed = minhash.edited(row["text"], after)
        k = len(row["text"]) // 2
        assert changed == row["text"][: len(row["text"]) - k] + after[:k]
        assert result["n_chars"] == len(row["text"]) and result["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        if min(len(set(words(t))) for t in (row["text"], after)) >= 60:  # of few shingles, bins hold few different values
            errors += [result["near_edited"] - true_likeness(row["text"], changed), result["near_next"] - true_likeness(row["text"], after)]
        assert by_text.setdefault(row["text"], result["fingerprint"]) == result["fingerprint"]
        assert len(result["fingerprint"]) == minhash.BINS * minhash.BITS // 4
    assert len(errors) > 200 and np.abs(errors).max() < 0.2 and np.sqrt(np.mean(np.square(errors))) < 0.04 and abs(np.mean(errors)) < 0.01


def test_fingerprints_in_order_with_odd_rows(spark, conf):
    conf(spark__sql__shuffle__partitions="3")
    got = minhash.compare_with_edits(texts(spark, ODD * 2)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, len(r[1] or ""), r[1] or "")
    ordered = sorted(ODD * 2, key=key)
    want = sorted(
        (str(k), len(t or ""), hashlib.sha256(minhash.edited(t or "", ordered[(i + 1) % len(ordered)][1] or "").encode()).hexdigest()) for i, (k, t) in enumerate(ordered)
    )
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == want
    assert {r["fingerprint"] for r in got if r["doc_id"] in (0, 1, 2, 5)} == {""}
    assert minhash.compare_with_edits(texts(spark, [])).collect() == []
    one = minhash.compare_with_edits(texts(spark, [(1, "just one text of some words")])).first()
    assert one["near_next"] == 1.0


def test_many_pieces_keep_the_order(spark):
    docs = spark.range(5000).selectExpr("(id * 7919) % 5000 AS doc_id", "concat('text of number ', (id * 7919) % 5000, repeat(' x', cast(id % 7 AS int))) AS text")
    ordered = minhash.in_key_order(docs, "doc_id", "text", piece_rows=100).collect()
    pieces = {}
    for r in ordered:
        pieces.setdefault(r["piece"], []).append(r)
    assert len(pieces) > 20
    successor = {}
    for rows in pieces.values():
        keys = [r["key"] for r in rows]
        assert [r["ahead"] for r in rows] == [False] * (len(rows) - 1) + [True]
        successor.update(zip(keys[:-1], keys[1:], strict=True))
    assert successor == {i: (i + 1) % 5000 for i in range(5000)}


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_packed_bits_and_bias(bits):
    rng = random.Random(bits)
    maker = minhash.Fingerprinter(bins=1024, bits=bits)
    common, a, b = ([str(rng.getrandbits(40)) for _ in range(600)] for _ in range(3))
    pair = [" ".join(common + a[:300]), " ".join(common + b[:300])]
    low, has = maker.bits_of([t.encode() for t in pair])
    assert abs(maker.likeness(low[:1], has[:1], low[1:], has[1:])[0] - true_likeness(*pair)) < 0.12
    assert len(maker.texts(low, has)[0]) == 1024 * bits // 4
