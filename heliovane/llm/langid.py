"""Language identification by cross-parsing against one suffix automaton per language.

A text is parsed into phrases: from where a phrase starts it goes on as long as what was read
occurs in the language's labelled text, which the automaton decides one character at a time.
The number of phrases times log2(length of the labelled text), over the length of the text,
estimates the bits per character of the text under that language; the language with the
fewest wins (ties: the first name).  A character that the language never shows is a phrase.

Characters are read as classes: letters in lower case, the `LETTERS` most frequent of the
labelled text and one class for the rest; everything else, however long, is one break.  Texts are
parsed in consecutive pieces of `PIECE` classes, whole and to the end, so that many pieces
advance at once as lanes of one numpy step.

The labelled text of a language is a sample bounded by `SAMPLE_DOCS` documents (smallest hash of
the key) and `SAMPLE_CHARS` characters; the tables sent to the tasks are these texts.

Defined cases: a null text and one without letters give `und` and score 0, as does every text if
nothing is labelled; rows with a null label or key are not learned from; repeated rows get
equal results; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from functools import lru_cache
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import columns, map_texts

SAMPLE_DOCS = 64
SAMPLE_CHARS = 32_000
LETTERS = 46
PIECE = 1024
LANES = 4096
UNDETERMINED = "und"


def labelled_sample(docs: DataFrame, learn: Column, key: str, text: str, lang: str, n_docs: int = SAMPLE_DOCS, n_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """A bounded sample of each language's text: equal shares of documents chosen by key hash."""
    share = n_chars // n_docs * 4
    offset = (F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.greatest(F.length(F.col(text)) - share, F.lit(0)) + 1) + 1).cast("int")
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(key)).alias("h"), F.col(text).substr(offset, F.lit(share)).alias("text")
    )
    order = Window.partitionBy("lang").orderBy("h", "text")
    chosen = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n_docs).orderBy("lang", "r").collect()
    out: dict[str, str] = {}
    for row in chosen:
        if len(out.get(row["lang"], "")) < n_chars:
            out[row["lang"]] = (out.get(row["lang"], "") + " " + row["text"])[:n_chars]
    return out


def suffix_automaton(codes: Iterable[int], width: int) -> np.ndarray:
    """Transitions (states x width) of the automaton of all substrings; -1 where there is none."""
    links, lengths, moves, last = [-1], [0], [{}], 0
    for c in codes:
        new = len(links)
        links.append(0)
        lengths.append(lengths[last] + 1)
        moves.append({})
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = links[p]
        if p >= 0:
            q = moves[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                copy = len(links)
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                moves.append(dict(moves[q]))
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = links[p]
                links[q] = links[new] = copy
        last = new
    out = np.full((len(moves), width), -1, np.int32)
    for state, move in enumerate(moves):
        for c, to in move.items():
            out[state, c] = to
    return out


class CrossParser:
    """The classes and the automata made of labelled texts."""

    def __init__(self, sample: dict[str, str], letters: int = LETTERS):
        self.names = sorted(sample)
        common = Counter(ch for text in sample.values() for ch in text.lower() if ch.isalpha())
        kept = sorted(common, key=lambda ch: (-common[ch], ch))[:letters]
        self.break_, self.other, self.pad, self.width = 0, len(kept) + 1, len(kept) + 2, len(kept) + 3
        code = {ch: i + 1 for i, ch in enumerate(kept)}
        self.classes = np.zeros(0x110000, np.uint8)
        for point in range(0x110000):
            ch = chr(point)
            if ch.isalpha():
                self.classes[point] = code.get(ch.lower(), self.other)
        self.tables, self.starts, self.bits = [], [], []
        for name in self.names:
            codes, _ = self.codes([sample[name].encode()])
            table = suffix_automaton(codes.tolist(), self.width)
            dead = len(table) * self.width
            full = np.full((len(table) + 1, self.width), -1, np.int32)
            full[:-1] = np.where(table < 0, -1, table * self.width)
            full[:, self.pad] = 0
            self.tables.append(full.ravel())
            self.starts.append(np.where(table[0] < 0, dead, table[0] * self.width).astype(np.int32))
            self.bits.append((dead, math.log2(max(2, len(codes)))))

    def codes(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all texts in a row, runs of breaks as one, and the number of classes of each text."""
        points = [np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32) for raw in raws]
        sizes = np.array([len(p) for p in points], np.int64)
        codes = self.classes[np.concatenate(points)] if len(points) else np.zeros(0, np.uint8)
        owner = np.repeat(np.arange(len(raws)), sizes)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != self.break_) | (codes[:-1] != self.break_) | (owner[1:] != owner[:-1])
        return codes[keep], np.bincount(owner[keep], minlength=len(raws))

    def phrases(self, raws: list[bytes], piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(texts x languages) numbers of phrases, the numbers of classes, and which texts have letters."""
        codes, sizes = self.codes(raws)
        counts = np.zeros((len(raws), len(self.names)), np.int64)
        has = np.zeros(len(raws), bool)
        begins = np.cumsum(sizes) - sizes
        n_pieces = -(-sizes // piece)
        owner = np.repeat(np.arange(len(raws)), n_pieces)
        first = np.repeat(begins, n_pieces) + (np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)) * piece
        length = np.minimum(piece, np.repeat(begins + sizes, n_pieces) - first)
        order = np.argsort(-length, kind="stable")
        codes = np.concatenate([codes, np.full(piece, self.pad, np.uint8)])
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            most = int(length[lanes[0]])
            places = np.arange(most)[:, None]
            grid = np.where(places < length[lanes], codes[np.minimum(first[lanes] + places, len(codes) - 1)], self.pad).astype(np.int32)
            np.logical_or.at(has, owner[lanes], ((grid != self.break_) & (grid != self.pad)).any(axis=0))
            for k, (table, start, (dead, _)) in enumerate(zip(self.tables, self.starts, self.bits, strict=True)):
                state, n = np.full(len(lanes), dead, np.int32), np.zeros(len(lanes), np.int32)
                for row in grid:
                    state = table[state + row]
                    missed = state < 0
                    n += missed
                    state = np.where(missed, start[row], state)
                np.add.at(counts[:, k], owner[lanes], n)
        return counts, sizes, has

    def predict(self, raws: list[bytes]) -> list[tuple[str, float]]:
        """Language and score: how far the second language's cost lies above the best one's, 0 to 1."""
        if not self.names or not raws:
            return [(UNDETERMINED, 0.0)] * len(raws)
        counts, sizes, has = self.phrases(raws)
        cost = counts * np.array([b for _, b in self.bits]) / np.maximum(1, sizes)[:, None]
        out = []
        for row, ok in zip(cost, has, strict=True):
            if not ok:
                out.append((UNDETERMINED, 0.0))
                continue
            best = int(row.argmin())
            second = np.delete(row, best).min(initial=np.inf)
            out.append((self.names[best], 1.0 if not np.isfinite(second) else float(1 - row[best] / second) if second else 0.0))
        return out


@lru_cache(maxsize=1)
def _parser(sample: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(dict(sample))


def identify(docs: DataFrame, sample: dict[str, str], key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Per document: doc_id, lang_pred, score.  Texts are parsed a few megabytes at a time."""
    fixed = tuple(sorted(sample.items()))

    def start():
        parser = _parser(fixed)

        def make(raws: list[bytes]) -> list[pa.Array]:
            found, waiting, volume = [], [], 0
            for raw in raws:
                waiting.append(raw)
                volume += len(raw)
                if volume > 4_000_000:
                    found += parser.predict(waiting)
                    waiting, volume = [], 0
            return columns(found + parser.predict(waiting), pa.string(), pa.float64())

        return make

    return map_texts(docs, key, text, start, "lang_pred string, score double", carry)
