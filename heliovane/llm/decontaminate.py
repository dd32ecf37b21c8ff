"""Benchmark decontamination: one automaton over normalised test windows, texts scanned once.

Words are runs of letters and digits (A-Z in lower case, every non-ASCII character counts as
a letter).  A window is `window` consecutive words of a test item; a shorter item that has
words is one window.  The windows, written with single spaces, form one Aho-Corasick
automaton; each text is normalised the same way, passed through it once, and the hits are
mapped back to word numbers and to code points of the original text.

The automaton is broadcast.  Its size is bounded by `block_chars`: a larger test set is dealt
into several automata by the hash of the window, and the texts are scanned once for each.

Defined cases: a null or wordless text has no words and no hits; a null or wordless item has
no window; an item with a null id counts as an item with the id ''; repeated items with one id
count once; repeated documents each get their own row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import columns, folded_words, map_texts, raw_texts
from heliovane.session import settle

WINDOW = 10
BLOCK_CHARS = 4_000_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPAN = "struct<first_word:long,n_words:long,char_start:long,char_end:long>"
_SPAN = pa.struct([(n, pa.int64()) for n in ("first_word", "n_words", "char_start", "char_end")])


def item_windows(items: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """(phrase, items): each distinct window with the sorted ids, as strings, of the items that hold it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column("key").to_pylist(), raw_texts(batch.column("text")), strict=True):
                words = folded_words(raw)
                phrases = {b" ".join(words[i : i + window]).decode() for i in range(max(1, len(words) - window + 1))} if words else set()
                if phrases:
                    yield pa.RecordBatch.from_pydict({"phrase": sorted(phrases), "item": [item] * len(phrases)}, schema=pa.schema([("phrase", pa.string()), ("item", pa.string())]))

    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "phrase string, item string").groupBy("phrase").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _automaton(phrases: list[tuple[str, list[str]]]) -> ahocorasick.Automaton | None:
    built, same = ahocorasick.Automaton(), {}
    for phrase, items in phrases:
        key = f" {phrase} ".encode().decode("latin-1")
        ids = same.setdefault(tuple(items), tuple(items))
        built.add_word(key, (len(key), phrase.count(" ") + 1, ids))
    built.make_automaton()
    return built if phrases else None


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching (first, end) intervals as one."""
    out: list[list[int]] = []
    for first, end in sorted(hits):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [tuple(x) for x in out]


def _found(raw: bytes, automaton) -> tuple[int, list[dict], list[str]]:
    """Number of words, merged spans with their places in the original, and ids of the items found."""
    words = folded_words(raw)
    if not words or automaton is None:
        return len(words), [], []
    line = b" " + b" ".join(words) + b" "
    hits, items, at, count = [], set(), 0, 0
    for end, (length, n, ids) in sorted(automaton.iter(line.decode("latin-1")), key=lambda hit: hit[0] - hit[1][0]):
        start = end - length + 1
        count, at = count + line.count(b" ", at, start), start
        hits.append((count, count + n))
        items.update(ids)
    spans = []
    if hits:
        places = [m.span() for m in _WORD.finditer(raw.decode())]
        spans = [
            {"first_word": a, "n_words": b - a, "char_start": places[a][0], "char_end": places[b - 1][1]} for a, b in _merged(hits)
        ]
    return len(words), spans, sorted(items)


def find_windows(
    docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS, carry: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_words, spans (merged places of windows), items (ids found, sorted).

    With one automaton nothing is shuffled.  With several, texts hit by a further one are
    joined back on the key and a 128-bit digest of the text.
    """
    phrases = settle(item_windows(items, item_key, item_text, window))
    size = phrases.agg(F.sum(F.length("phrase") + F.length(F.array_join("items", ","))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_chars))
    spark, several = docs.sparkSession, blocks > 1

    def scanned(block: int, carry: bool) -> DataFrame:
        mine = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block).collect()
        sent = spark.sparkContext.broadcast([(r["phrase"], list(r["items"])) for r in mine])

        def start():
            automaton = _automaton(sent.value)

            def make(raws: list[bytes]) -> list[pa.Array]:
                found = ((hashlib.md5(raw).hexdigest() if several else None, *_found(raw, automaton)) for raw in raws)
                return columns(found, pa.string(), pa.int64(), pa.list_(_SPAN), pa.list_(pa.string()))

            return make

        return map_texts(docs, doc_key, text, start, f"digest string, n_words long, spans array<{SPAN}>, items array<string>", carry)

    first = scanned(0, carry)
    if blocks == 1:
        return first.drop("digest")
    more = reduce(DataFrame.unionByName, [scanned(b, False).where(F.size("items") > 0) for b in range(1, blocks)])
    more = more.dropDuplicates(["doc_id", "digest", "items"]).select(
        F.col("doc_id").alias("k"), F.col("digest").alias("d"), F.col("spans").alias("s"), F.col("items").alias("i")
    )
    more = more.groupBy("k", "d").agg(F.flatten(F.collect_list("s")).alias("s"), F.flatten(F.collect_list("i")).alias("i"))
    both = first.join(more, F.col("doc_id").eqNullSafe(F.col("k")) & F.col("digest").eqNullSafe(F.col("d")), "left")
    none = F.array()
    return both.select(
        "doc_id", *(["row"] if carry else []), "n_words", F.concat("spans", F.coalesce("s", none.cast(f"array<{SPAN}>"))).alias("spans"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("i", none.cast("array<string>"))))).alias("items"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS, carry: bool = False) -> DataFrame:
    """`find_windows` with counts: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items.

    n_hit counts each hit word once, also where spans of several automata overlap.
    """
    found = find_windows(docs, items, doc_key, text, window=window, block_chars=block_chars, carry=carry)
    words = F.flatten(F.transform("spans", lambda s: F.sequence(s["first_word"], s["first_word"] + s["n_words"] - 1)))
    n_hit = F.when(F.size("spans") == 0, F.lit(0)).otherwise(F.size(F.array_distinct(words))).cast("long")
    return found.select(
        "doc_id", *(["row"] if carry else []), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans", "items",
    )
