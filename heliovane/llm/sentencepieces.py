"""SentencePiece encoding and decoding with a table of distinct chunks.

In this kind of model no piece holds a whitespace marker after another character, so merges
never cross from one marked word to the next: a text is cut before each run of markers, each
distinct chunk is segmented once by the library, and the ids are joined back by position.
`Pieces` checks the property and refuses a model without it.

The table is kept per worker and bounded (`common.Memo`).  Decoding joins the bytes of the
pieces; where these are not valid UTF-8, or a control piece is among them, the library decodes,
so its replacement rule holds.

Defined cases: null is the empty text, which has no ids and decodes to ''; repeated rows each
get their own result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
import hashlib
from itertools import chain
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import sentencepiece
from sentencepiece.sentencepiece_model_pb2 import ModelProto

from heliovane.llm.common import Memo, columns, map_texts

_MARKER = "\u2581"
_CHUNK = re.compile(rb" +[^ ]*")


class Pieces:
    """Encoder and decoder for one model file."""

    def __init__(self, model: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        spec = ModelProto.FromString(self.sp.serialized_model_proto()).normalizer_spec
        names = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        if any(_MARKER in name.lstrip(_MARKER) for name in names):
            raise ValueError("pieces of this model cross whitespace markers")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("this model changes its input before segmenting")
        self.ids = list(range(len(names)))  # one object for each id, which all remembered chunks share
        self.decimal = [str(i).encode() for i in self.ids]
        self.bytes: list[bytes] = []
        for i, name in enumerate(names):
            if self.sp.is_control(i):
                self.bytes.append(b"\xff")  # no UTF-8: what holds it is left to the library
            elif self.sp.is_byte(i):
                self.bytes.append(bytes([int(name[3:-1], 16)]))
            elif self.sp.is_unknown(i):
                self.bytes.append(self.sp.decode([i]).encode())
            else:
                self.bytes.append(name.replace(_MARKER, " ").encode())
        self.marker = self.sp.piece_to_id(_MARKER)
        self.plain = not any(self.sp.is_unused(i) for i in range(len(names)))
        self.table = Memo(self._segment)

    def _segment(self, chunk: bytes) -> tuple[int, ...]:
        """Ids of one chunk; the library itself puts the first marker before what it encodes."""
        return tuple(map(self.ids.__getitem__, self.sp.encode(chunk[1:].decode()))) if len(chunk) > 1 else (self.marker,)

    def encode(self, raw: bytes) -> list[int]:
        """The library's ids of the whole text."""
        if not raw:
            return []
        marked = b" " + raw.replace(_MARKER.encode(), b" ")
        return list(chain.from_iterable(map(self.table.__getitem__, _CHUNK.findall(marked))))

    def decode(self, ids: list[int]) -> str:
        """The library's text of the ids."""
        try:
            text = b"".join(map(self.bytes.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            return self.sp.decode(ids)
        if not self.plain:
            return self.sp.decode(ids)
        return text[1:] if ids and text[:1] == " " and not self.sp.is_byte(ids[0]) and not self.sp.is_unknown(ids[0]) else text


@lru_cache(maxsize=2)
def pieces(model: str) -> Pieces:
    return Pieces(model)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Per document: doc_id, ids."""

    def start():
        known = pieces(model)
        return lambda raws: [pa.array([known.encode(raw) for raw in raws], pa.list_(pa.int32()))]

    return map_texts(docs, key, text, start, "ids array<int>", carry)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: doc_id, text; null ids are no ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for batch in batches:
            texts = [known.decode(list(row or [])) for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Encode, decode and digest in one pass, so that ids need not travel: n_tokens, ids_sha256, decoded_sha256."""

    def start():
        known = pieces(model)

        def digest(raw: bytes) -> tuple[int, str, str]:
            ids = known.encode(raw)
            listed = b",".join(map(known.decimal.__getitem__, ids))
            return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(known.decode(ids).encode()).hexdigest()

        return lambda raws: columns(map(digest, raws), pa.int64(), pa.string(), pa.string())

    return map_texts(docs, key, text, start, "n_tokens long, ids_sha256 string, decoded_sha256 string", carry)
