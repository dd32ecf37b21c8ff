"""Source divergence against plain Python arithmetic."""

from collections import Counter
import re

import numpy as np
import pytest

from heliovane.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "text string, lang string, source string, value int, rank string, gid int"


def brute(rows, min_docs=3, top=200):
    rows = [tuple(x or "" for x in r[:3]) for r in rows]
    seen, docs, groups = Counter(), Counter(), sorted({r[1:] for r in rows})
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(LOW))
        seen.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (at, t), n in docs.items() if at == lang and n >= min_docs)
        sources = [s for at, s in groups if at == lang]
        counts = {s: [seen[lang, s, t] for t in kept] for s in sources}

        def shares(counts, v=len(kept)):
            return [1 + 10**9 * (c + 1) // (sum(counts) + v) for c in counts]

        q_lang, p = shares([sum(c) for c in zip(*counts.values())]), {s: shares(c) for s, c in counts.items()}
        for s in sources:
            pairs = [(t, sum((a - b) ** 2 // b for a, b in zip(p[s], p[t]))) for t in sources if t != s]
            terms = [(t, (a - b) ** 2 // b) for t, a, b, n in zip(kept, p[s], q_lang, counts[s]) if n and a > b]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def random_rows(seed, n=300):
    rng = np.random.default_rng(seed)
    vocabulary = ["Of", "été", "été's", "naïve", "x1y", "日本", "\U0001f600", *(f"w{'abcdefgh'[i % 8]}{'klmnopqr'[i // 8]}" for i in range(64))]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    rows = []
    for i in range(n):
        words = rng.choice(vocabulary, size=rng.integers(0, 30), p=weights / weights.sum())
        source = "hot" if i % 3 == 0 else f"s{rng.integers(0, 6)}"
        rows.append((" ".join(words), ["en", "fr"][i % 2], source, i, "r", None))
    return rows


ODD = [
    (None, None, None, 1, None, 1), ("", "en", "", 1, "x", 2), ("only numbers 12", "zz", "one", None, "x", 2), ("same same", "en", None, 1, "x", 2), ("same same", "en", None, 1, "x", 2),
    ("same Same tie tie", "en", "b", 1, "x", 2), ("tie tie same same", "en", "a", 1, "x", 2), ("tie same", "en", "a", 1, "x", 2), ("nothing kept", "de", "a", 1, "x", 2), ("12 !", "de", "b", 1, "x", 2),
]


@pytest.mark.parametrize("rows", [ODD, random_rows(1), ODD + random_rows(2)])
def test_audit_against_plain_arithmetic(spark, rows):
    got = divergence.audit(spark.createDataFrame(rows, DDL)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_parameters_and_empty_table(spark):
    rows = random_rows(3)
    got = divergence.audit(spark.createDataFrame(rows, DDL), min_docs=9, top=4).collect()
    assert sorted(map(tuple, got)) == brute(rows, 9, 4)
    assert divergence.audit(spark.createDataFrame([], DDL)).collect() == []


def test_runs_are_sorted_and_merge_to_the_same_terms(spark):
    rows = random_rows(4)
    frame = spark.createDataFrame([r[:3] for r in rows], "text string, lang string, source string").repartition(5)
    groups = sorted({r[1:3] for r in rows})
    gids, langs = {g: i for i, g in enumerate(groups)}, [int(g[0] == "fr") for g in groups]
    small = divergence.sorted_runs(frame, gids, block_bytes=2000)
    runs = small.collect()
    assert len(runs) > len({(r["gid"], r["term"]) for r in runs})  # several runs hold the same posting
    assert sum(a["term"].encode() > b["term"].encode() for a, b in zip(runs, runs[1:])) < 200  # ascending within each of the many runs
    merged = {(r["lang_no"], r["term"]): (r["total"], dict(zip(r["gids"], r["counts"]))) for r in divergence.merged(small, langs).collect()}
    whole = {(r["lang_no"], r["term"]): (r["total"], dict(zip(r["gids"], r["counts"]))) for r in divergence.merged(divergence.sorted_runs(frame, gids), langs).collect()}
    assert merged == whole and all(total == sum(counts.values()) for total, counts in merged.values())


def test_terms_that_span_batches(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch=3)
    rows = random_rows(5)
    assert sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, DDL)).collect())) == brute(rows)


def test_a_very_long_text_and_word(spark):
    rows = [("a" * 3_000_000, "en", "a", 1, "", 1)] * 3 + [("word of " * 400_000, "en", "b", 1, "", 1), ("word of", "en", "c", 1, "", 1), ("of word", "en", "c", 1, "", 1)]
    assert sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, DDL)).collect())) == brute(rows)


def test_shares_of_large_counts():
    counts, sizes = np.array([0, 7, 8 * 10**15]), np.array([1, 10, 9 * 10**15])
    assert divergence.shares(counts, sizes).tolist() == [1 + 10**9 * (int(c) + 1) // int(s) for c, s in zip(counts, sizes)]
