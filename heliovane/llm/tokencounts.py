"""Token counts by a linear longest-match automaton over a word-piece vocabulary.

Greedy word-piece takes the longest piece that starts a word, then the longest continuation
piece, and so on; a word that cannot be finished is one unknown token.  Here the pieces form
one trie.  Each node holds where to go when no child matches (the failure link) and how many
tokens that jump would emit (the popped count), so a word's count is one walk over its
characters, without backtracking and without building pieces.

The first piece of a word is one that starts with the marker U+2581 in the vocabulary; all
others are continuations, so the marked word is read from a single root.  Words are runs of
anything but ASCII white space and the marker itself, case kept.

Defined cases: null and blank texts have 0 words and 0 tokens; a word with a character the
vocabulary lacks is one unknown token; words longer than `LONGEST` bytes are counted like any
other but not remembered; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections import deque
from functools import lru_cache
import json

import pyarrow as pa
from pyspark.sql import DataFrame
import sentencepiece

from heliovane.llm.common import Memo, columns, map_texts

MARKER = "▁"
LONGEST = 64


def marked_vocabulary(path: str) -> list[str]:
    """Pieces of a SentencePiece model, or of a JSON list, that are neither special nor bytes."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as file:
            return json.load(file)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = (i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)))
    return [sp.id_to_piece(i) for i in kept]


class LongestMatch:
    """Trie with failure links and popped counts."""

    def __init__(self, vocabulary: list[str]):
        self.moves: list[dict[str, int]] = [{}]
        whole, depth = [False], [0]
        for piece in sorted(set(vocabulary)):
            node = 0
            for ch in piece:
                if ch not in self.moves[node]:
                    self.moves[node][ch] = len(self.moves)
                    self.moves.append({})
                    whole.append(False)
                    depth.append(depth[node] + 1)
                node = self.moves[node][ch]
            whole[node] = bool(piece)
        #: Failure target (-1: the text so far cannot be segmented) and tokens emitted by taking it.
        self.fail, self.popped = [-1] * len(whole), [0] * len(whole)
        waiting = deque([0])
        while waiting:
            node = waiting.popleft()
            for ch, child in self.moves[node].items():
                waiting.append(child)
                if whole[child]:
                    self.fail[child], self.popped[child] = 0, 1
                    continue
                at, tokens = self.fail[node], self.popped[node]
                while at >= 0 and ch not in self.moves[at]:
                    tokens += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[child], self.popped[child] = self.moves[at][ch], tokens

    def count(self, marked: str) -> int:
        """Tokens of one marked word; 0 if it cannot be segmented."""
        node, tokens, moves, fail, popped = 0, 0, self.moves, self.fail, self.popped
        for ch in marked:
            while ch not in moves[node]:
                if fail[node] < 0 or node == 0:
                    return 0
                tokens += popped[node]
                node = fail[node]
            node = moves[node][ch]
        while node:
            if fail[node] < 0:
                return 0
            tokens += popped[node]
            node = fail[node]
        return tokens


@lru_cache(maxsize=2)
def _words(path: str) -> Memo:
    automaton = LongestMatch(marked_vocabulary(path))
    return Memo(lambda word: automaton.count(MARKER + word.decode()), longest=LONGEST)


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_tokens (an unknown word is one token), n_unknown."""

    def start():
        known = _words(vocabulary)

        def count(raw: bytes) -> tuple[int, int, int]:
            counts = list(map(known.__getitem__, raw.replace(MARKER.encode(), b" ").split()))
            unknown = counts.count(0)
            return len(counts), sum(counts) + unknown, unknown

        return lambda raws: columns(map(count, raws), pa.int64(), pa.int64(), pa.int64())

    return map_texts(docs, key, text, start, "n_words long, n_tokens long, n_unknown long", carry)
