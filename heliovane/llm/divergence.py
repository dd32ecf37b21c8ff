"""How far the sources of a language diverge in their vocabulary, from one index of term counts.

Single-pass in-memory indexing: a task gathers postings (group, term) -> (occurrences, documents)
until `BLOCK_BYTES` of them are held, emits them as one run sorted by term, and starts the next
block.  Runs go to hash shards of the terms, where Spark's external sorter merges them (a heap over
spilled runs) and a streaming pass adds up neighbours to frequencies.  A term is one row with the
groups that hold it, so no later step has to bring its postings together again.

With p(c) = 1 + floor(SCALE (c + 1) / (N + V)) a pair of sources sums f(p, q) over all V kept terms,
of which most are in neither.  So the sum is taken as if no term were in both: V times the value of
an absent term plus, from each source's histogram of counts, what its own terms add.  Then only
terms that really are in both sources are streamed, and each corrects its pair's sum.  All
arithmetic is exact in 64-bit integers for N + V below 9 * 10**15 and V below 10**9.

Collected on the way: one row (lang, source, N, V) for every group.  The result holds a row for
every two of them, so this is small next to the result.

Defined cases: null texts, languages and sources are '' (a group as any other); a group without
terms still gets its pairs; a language without kept terms has pairs of value 0 and no terms; a
single source has no pairs; repeated rows count as documents of their own; equal values are ranked
by the UTF-8 bytes of the item; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import raw_texts
from heliovane.session import cleared, settle

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
BLOCK_BYTES = 96 << 20
#: What an entry of a block takes besides the bytes of its term: two counters' slots and objects.
ENTRY_BYTES = 200
#: A-Z become a-z; every ASCII character but letters separates terms.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_RUN = "gid int, term string, n long, docs long"
_KEPT = "lang_no int, term string, total long, gids array<int>, counts array<long>"


class Block:
    """Postings in memory: per group the occurrences and the documents of each term."""

    def __init__(self):
        self.seen: dict[int, Counter] = defaultdict(Counter)
        self.docs: dict[int, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, gid: int, raw: bytes) -> None:
        terms, seen = raw.translate(TERMS).split(), self.seen[gid]
        known = len(seen)
        seen.update(terms)
        self.docs[gid].update(set(terms))
        if terms:  # new terms, at the mean length of this text's terms
            self.size += (len(seen) - known) * (ENTRY_BYTES + len(raw) // len(terms))

    def run(self) -> pa.RecordBatch:
        """All postings, sorted by term."""
        gids = np.repeat(list(self.seen), [len(c) for c in self.seen.values()])
        terms = pa.array([t for c in self.seen.values() for t in c], pa.binary()).cast(pa.string())
        n = pa.array([v for c in self.seen.values() for v in c.values()], pa.int64())
        docs = pa.array([self.docs[g][t] for g, c in self.seen.items() for t in c], pa.int64())
        run = pa.RecordBatch.from_arrays([pa.array(gids, pa.int32()), terms, n, docs], names=["gid", "term", "n", "docs"])
        return run.take(pc.sort_indices(terms))


def sorted_runs(rows: DataFrame, gids: dict[tuple[str, str], int], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Runs (gid, term, n, docs) of rows (lang, source, text)."""

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            where = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group, raw in zip(where, raw_texts(batch.column("text")), strict=True):
                block.add(gids[group], raw)
                if block.size > block_bytes:
                    yield block.run()
                    block = Block()
        yield block.run()

    return rows.mapInArrow(index, _RUN)


def _starts(changed: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], changed]))


def merged(runs: DataFrame, langs: list[int], min_docs: int = MIN_DOCS) -> DataFrame:
    """One row for each term of a language in `min_docs` documents or more: _KEPT.  `langs`: each group's language."""
    of_group = np.array(langs, np.int32)

    def whole_terms(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        term, gid = rows["term"].chunk(0), rows["gid"].to_numpy()
        n, docs, lang = rows["n"].to_numpy(), rows["docs"].to_numpy(), of_group[gid]
        new_term = np.asarray(pc.not_equal(term[1:], term[:-1]))
        posting = _starts(new_term | (gid[1:] != gid[:-1]))
        entry = _starts(new_term | (lang[1:] != lang[:-1]))
        keep = np.add.reduceat(docs, entry) >= min_docs
        counts, of_entry = np.add.reduceat(n, posting), np.searchsorted(entry, posting, "right") - 1
        sizes, kept = np.bincount(of_entry, minlength=len(entry))[keep], keep[of_entry]
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(lang[entry[keep]]), term.take(pa.array(entry[keep])), pa.array(np.add.reduceat(n, entry)[keep]),
             pa.ListArray.from_arrays(ends, pa.array(gid[posting[kept]])), pa.ListArray.from_arrays(ends, pa.array(counts[kept]))],
            names=["lang_no", "term", "total", "gids", "counts"],
        )

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the term that the next batch may go on with
        for batch in batches:
            if not len(batch):
                continue
            last = pc.equal(batch.column("term"), batch.column("term")[-1]).to_numpy(zero_copy_only=False)
            start = int(np.argmax(last))
            if start or (held and held[0].column("term")[0] != batch.column("term")[0]):
                yield whole_terms(pa.Table.from_batches([*held, batch.slice(0, start)]))
                held = []
            held.append(batch.slice(start))
        if held:
            yield whole_terms(pa.Table.from_batches(held))

    shards = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(shards, "term").sortWithinPartitions("term", "gid").mapInArrow(merge, _KEPT)


def share(count: Column, size: Column) -> Column:
    """1 + floor(SCALE (count + 1) / size) by long division, as the product need not fit 64 bits."""
    value, rest = F.lit(0), count + 1
    for _ in range(3):
        value, rest = value * 1000 + F.call_function("div", rest * 1000, size), (rest * 1000) % size
    return value + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def shares(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """`share` over arrays."""
    value, rest = np.zeros(len(counts), np.int64), counts + 1
    for _ in range(3):
        value, rest = value * 1000 + rest * 1000 // sizes, rest * 1000 % sizes
    return value + 1


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def pair_corrections(kept: DataFrame, sizes: np.ndarray) -> DataFrame:
    """What terms in both of two groups add to the sums that take no term to be in both: (s, t, value).

    `sizes`: N + V by group.  Postings of a term are met at every distance of their list, so a step
    of numpy serves all terms of a batch.
    """
    absent = shares(np.zeros(len(sizes), np.int64), np.maximum(sizes, 1))

    def correct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, found = batch.column("gids"), []
            gid, count = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            entry = np.repeat(np.arange(len(batch)), np.diff(np.asarray(lists.offsets)))
            p, p0 = shares(count, sizes[gid]), absent[gid]
            both = np.arange(len(gid))
            for step in range(1, len(gid)):
                both = both[: np.searchsorted(both, len(gid) - step)]
                both = both[entry[both] == entry[both + step]]
                if not len(both):
                    break
                for s, t in ((both, both + step), (both + step, both)):
                    value = divergences(p[s], p[t]) - divergences(p[s], p0[t]) - divergences(p0[s], p[t]) + divergences(p0[s], p0[t])
                    found.append((gid[s].astype(np.int64) << 32 | gid[t], value))
                if sum(len(k) for k, _ in found) > 1 << 22:
                    found = [_summed(found)]
            if found:
                pairs, value = _summed(found)
                yield pa.RecordBatch.from_arrays([pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(value)], names=["s", "t", "value"])

    return kept.select("gids", "counts").mapInArrow(correct, "s int, t int, value long")


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, value = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(pairs), np.int64)
    np.add.at(total, at, value)
    return pairs, total


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: see the module's text."""
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    groups = sorted((r["lang"], r["source"]) for r in rows.select("lang", "source").distinct().collect())
    names = sorted({g[0] for g in groups})
    langs = [names.index(g[0]) for g in groups]
    with cleared() as staying:
        kept = settle(merged(sorted_runs(rows, {g: i for i, g in enumerate(groups)}), langs, min_docs))
        postings = kept.select("lang_no", "term", "total", F.explode(F.arrays_zip("gids", "counts")).alias("x")).select("lang_no", "term", "total", F.col("x.gids").alias("gid"), F.col("x.counts").alias("n"))
        histogram = settle(postings.groupBy("gid", "n").agg(F.count("*").alias("terms")))
        found = {r["gid"]: r["size"] for r in histogram.groupBy("gid").agg(F.sum(F.col("n") * F.col("terms")).alias("size")).collect()}
        terms = {r["lang_no"]: r["terms"] for r in kept.groupBy("lang_no").agg(F.count("*").alias("terms")).collect()}
        whole = Counter()
        for gid, n in found.items():
            whole[langs[gid]] += n
        info = [(gid, langs[gid], *group, found.get(gid, 0) + terms.get(langs[gid], 0), whole[langs[gid]] + terms.get(langs[gid], 0), terms.get(langs[gid], 0)) for gid, group in enumerate(groups)]
        about = spark.createDataFrame(info, "gid int, lang_no int, lang string, source string, size long, lang_size long, terms long")
        sizes = np.array([row[4] for row in info], np.int64)

        known = postings.join(about.select("gid", "size", "lang_size"), "gid")
        known = known.select("gid", F.col("term").alias("item"), share(F.col("n"), F.col("size")).alias("p"), share(F.col("total"), F.col("lang_size")).alias("q"))
        of_terms = known.where("p > q").select("gid", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value"))

        # Sums as if no term were in both sources of a pair: each other source t of s, then either's own terms.
        absent = share(F.lit(0).cast("long"), F.greatest(F.col("size"), F.lit(1)))
        s = about.select(F.col("gid").alias("s"), "lang_no", F.col("size").alias("s_size"), absent.alias("p0"), "terms")
        t = about.select(F.col("gid").alias("t"), "lang_no", F.col("size").alias("t_size"), absent.alias("q0"))
        pairs = s.join(t, "lang_no").where("s <> t")
        none = divergence(F.col("p0"), F.col("q0"))
        p, q = share(F.col("n"), F.col("s_size")), share(F.col("n"), F.col("t_size"))
        counts = histogram.withColumnRenamed("terms", "with_count")
        parts = [
            pairs.select("s", "t", (F.col("terms") * none).alias("value")),
            pairs.join(counts.withColumnRenamed("gid", "s"), "s").select("s", "t", (F.col("with_count") * (divergence(p, F.col("q0")) - none)).alias("value")),
            pairs.join(counts.withColumnRenamed("gid", "t"), "t").select("s", "t", (F.col("with_count") * (divergence(F.col("p0"), q) - none)).alias("value")),
            pair_corrections(kept, sizes),
        ]
        sums = parts[0]
        for part in parts[1:]:
            sums = sums.unionAll(part)
        sums = sums.groupBy("s", "t").agg(F.sum("value").alias("value"))
        others = about.select(F.col("gid").alias("t"), F.col("source").alias("item"))
        of_pairs = sums.join(others, "t").select(F.col("s").alias("gid"), F.lit("pair").alias("part"), "item", "value")

        order = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "item"))
        ranked = of_pairs.withColumn("rank", order).unionAll(of_terms.withColumn("rank", order).where(F.col("rank") <= top))
        result = settle(ranked.join(about.select("gid", "lang", "source"), "gid").select("lang", "source", "part", "item", "value", "rank"))
        staying.append(result)
    return result
