"""SimHash near-duplicates with bit-sliced comparison.

A text's words (split at ASCII white space, A-Z in lower case) give its 4-word shingles, repeats
included; bit b of the fingerprint is set if more than half of the shingles' XXH64 values (seed
42) have it.  Texts with fewer words are one shingle, wordless texts have fingerprint zero.
Fingerprints are linked if at most `RADIUS` bits differ, and a document's component is the
smallest id reachable over links.

Links are found exactly.  The 64 bits are cut into `BLOCKS` parts; two linked fingerprints agree in
at least BLOCKS - RADIUS of them, so each distinct fingerprint is keyed by every such choice of
parts and only those with an equal key are compared.  Each run of equal keys is laid out as 64
vertical bit planes; a fingerprint is compared with 64 others at once by adding planes into
carry-save counters, and what lies beyond the radius in all 64 lanes is abandoned early.  A key
held by more than `SPLIT` fingerprints is dealt into slices, each pair of slices a group of its
own, so no task gathers a large group.  Only a spanning forest of the links leaves a task, and
components come from alternating star contractions of written edge tables.

Defined cases: null and blank texts have fingerprint zero and are linked like any other; rows
with a null id get a fingerprint and the component of the ids they are linked to (null if
there is none); repeated rows are kept; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
import xxhash

from heliovane.llm.common import LOWER, map_texts
from heliovane.session import discard, settle

WORDS = 4
SEED = 42
RADIUS = 4
BLOCKS = 6
SPLIT = 4096
PAIRS = 1 << 15


def simhash(raw: bytes) -> int:
    """The 64-bit fingerprint of one text."""
    words = raw.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    n = max(1, len(words) - WORDS + 1)
    last = ends[min(WORDS, len(words)) - 1 :]
    view, digest = memoryview(line), xxhash.xxh64_digest
    hashes = b"".join([digest(view[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)])
    ones = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Per document: doc_id, fp (the fingerprint as a signed long)."""

    def make(raws: list[bytes]) -> list[pa.Array]:
        return [pa.array(np.array([simhash(raw) for raw in raws], np.uint64).view(np.int64))]

    return map_texts(docs, key, text, lambda: make, "fp long", carry)


def _planes(values: np.ndarray) -> np.ndarray:
    """(64 x words): plane b holds bit b of every value, 64 values to a word, lane 0 lowest."""
    n = -(-len(values) // 64) * 64
    padded = np.zeros(n, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within_radius(values: np.ndarray, planes: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each (query, word of 64 lanes): the lanes within the radius of the query, as bits.

    `radius` is below 8: three carry-save counters and one overflow word.
    """
    alive, out = np.arange(len(query)), np.zeros(len(query), np.uint64)
    ones, twos, fours, over = (np.zeros(len(query), np.uint64) for _ in range(4))
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for b in range(64):
        x = planes[b][word] ^ (np.uint64(0) - ((values[query] >> np.uint64(b)) & np.uint64(1)))
        carry = ones & x
        ones ^= x
        more = twos & carry
        twos ^= carry
        over |= fours & more
        fours ^= more
        if b % 8 == 7:
            far = over.copy()
            for k in range(radius + 1, 8):
                far |= (ones if k & 1 else ~ones) & (twos if k & 2 else ~twos) & (fours if k & 4 else ~fours)
            if b == 63:
                out[alive] = ~far
                break
            keep = np.flatnonzero(far != full)
            if len(keep) < len(far):
                alive, query, word, ones, twos, fours, over = (v[keep] for v in (alive, query, word, ones, twos, fours, over))
            if not len(alive):
                break
    return out


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the pairs; parent[i] stays the smallest place of i's set."""
    while len(a):
        a, b = parent[a], parent[b]
        differ = a != b
        a, b = a[differ], b[differ]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def run_links(values: np.ndarray, runs: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal numbers in `runs`, as (value, value of its set's first place)."""
    n = len(values)
    ends = np.searchsorted(runs, runs, "right")
    planes, parent = _planes(values), np.arange(n)
    first, last = (np.arange(n) + 1) >> 6, (ends - 1) >> 6
    count = np.where(ends > np.arange(n) + 1, last - first + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PAIRS, "right")) - 1)
        query = np.repeat(np.arange(at, to), count[at:to])
        word = first[query] + np.arange(len(query)) - (bounds[query] - bounds[at])
        near = within_radius(values, planes, query, word, radius)
        hit = np.flatnonzero(near)
        for part in np.array_split(hit, max(1, len(hit) // 4096)):
            rows, lanes = np.nonzero(np.unpackbits(near[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            a, b = query[part[rows]], word[part[rows]] * 64 + lanes
            ok = (b > a) & (b < ends[a])
            _unite(parent, a[ok], b[ok])
        at = to
    moved = np.flatnonzero(parent != np.arange(n))
    return values[moved], values[parent[moved]]


def _keys(fp: Column, blocks: int, radius: int) -> Column:
    """All (choice of parts, their bits) of a fingerprint."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    out = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        out.append(F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("k")))
    return F.explode(F.array(*out))


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, split: int = SPLIT) -> DataFrame:
    """(u, v), u > v: a set of links whose components are those of all links within the radius."""
    if not 0 < radius < min(8, blocks):
        raise ValueError("the radius must be below 8 and below the number of blocks")
    keyed = distinct.select("fp", _keys(F.col("fp"), blocks, radius).alias("at")).select("fp", "at.t", "at.k")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"))
    slices = sizes.where(F.col("n") > split).select(F.col("t").alias("ht"), F.col("k").alias("hk"), F.ceil(F.col("n") / split).cast("int").alias("slices"))
    hot = settle(slices)
    joined = keyed.join(hot, (F.col("t") == F.col("ht")) & (F.col("k") == F.col("hk")), "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda j: F.struct(F.least(mine, j).alias("a"), F.greatest(mine, j).alias("b")))
    alone = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
    groups = joined.select("fp", "t", "k", F.explode(F.when(F.col("slices").isNull(), alone).otherwise(others)).alias("g"))
    groups = groups.select("fp", F.xxhash64("t", "k", "g.a", "g.b").alias("h"), "t", "k", F.col("g.a").alias("a"), F.col("g.b").alias("b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            now = [np.concatenate([k, batch.column(i).to_numpy()]) for i, k in enumerate(kept)]
            change = np.zeros(len(now[0]), bool)
            for column in now[1:]:
                change[1:] |= column[1:] != column[:-1]
            runs = np.cumsum(change)
            open_ = int(np.searchsorted(runs, runs[-1])) if len(runs) else 0
            kept = [column[open_:] for column in now]
            yield _linked(now[0][:open_], runs[:open_])
        if len(kept[0]):
            yield _linked(kept[0], np.zeros(len(kept[0]), np.int64))

    def _linked(values: np.ndarray, runs: np.ndarray) -> pa.RecordBatch:
        size = np.bincount(runs) if len(runs) else np.zeros(0, np.int64)
        several = size[runs] > 1 if len(runs) else np.zeros(0, bool)
        a, b = run_links(values[several].view(np.uint64), runs[several], radius)
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["u", "v"])

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = groups.repartition(parts, "h").sortWithinPartitions("t", "k", "a", "b").select("fp", "t", "k", "a", "b")
    return ordered.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in an edge, root the smallest node of its component.

    Large-star and small-star steps alternate until the edges no longer change.  Edges point from
    the larger node to the smaller one, so a node's least neighbour comes from the edges that
    leave it; a hub that is the least of its neighbours has none and stays as it is.  Both sides of
    each join are written tables: nothing is recomputed, a lost executor costs a re-read, and
    Spark splits the rows of a hub, which it can't where one side is an aggregate.
    """
    edges = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first())

    def least(df: DataFrame) -> DataFrame:
        return settle(df.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")))

    before = mark(edges)
    while before[0]:
        down = least(edges)
        large = settle(edges.join(down, F.col("v") == F.col("x"), "left").select("u", F.coalesce("m", "v").alias("v")).distinct())
        below = least(large)
        moved = large.join(below, F.col("u") == F.col("x")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nearer = settle(moved.unionByName(below.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct())
        discard(edges, down, large, below)
        edges, last = nearer, before
        before = mark(edges)
        if before == last:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _classes(marked: DataFrame, radius: int, blocks: int, split: int) -> DataFrame:
    """(fp, least, root): each fingerprint, its smallest id, and the number of its component."""
    ids = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(ids.select("fp"), radius, blocks, split))
    return settle(ids.join(found, ids["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, blocks: int = BLOCKS, split: int = SPLIT) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    marked = settle(fingerprints(docs, key, text))
    classes = _classes(marked, radius, blocks, split)
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of = classes.join(smallest, "root").select(F.col("fp").alias("f"), "component_id")
    return marked.join(of, F.col("fp") == F.col("f"), "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, blocks: int = BLOCKS, split: int = SPLIT) -> DataFrame:
    """The rows that stay when one document of each component does: the one with the smallest id.

    Rows move once, by fingerprint and id together, so a large group of copies spreads out.
    Where the chosen row itself is repeated, one of the repetitions stays.
    """
    marked = settle(fingerprints(docs, key, text, carry=True))
    classes = _classes(marked, radius, blocks, split)
    chosen = classes.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("c"))
    copies = marked.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    chosen = chosen.select(F.col("c.fp").alias("f"), F.col("c.least").alias("id"))
    chosen = settle(chosen.join(copies, (F.col("f") == F.col("fp")) & F.col("id").eqNullSafe(F.col("doc_id"))).select("f", "id", "copies"))
    rows = marked.join(chosen, (F.col("fp") == F.col("f")) & F.col("doc_id").eqNullSafe(F.col("id")))
    single = rows.where("copies = 1").select("row.*")
    return single.unionByName(rows.where("copies > 1").dropDuplicates(["f", "id"]).select("row.*"))
