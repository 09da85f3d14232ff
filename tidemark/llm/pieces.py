"""SentencePiece encoding and decoding through a table of distinct chunks.

The library replaces each space by a marker and puts one in front of the text. No piece
of the vocabulary holds a marker after another character, so no merge crosses the start
of a run of markers: the text falls into chunks, a run of markers and what follows up to
the next, that are segmented independently. Each distinct chunk is segmented by the
library once and its ids are put back by position; decoding works the same way.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, text_of

by_value(__name__)

if array("I").itemsize != 4 or sys.byteorder != "little":
    raise ImportError("packing needs four-byte little-endian integers")

MARK = "▁"
#: Bytes of chunks, ids and texts that a task's table holds before it starts anew.
TABLE_BYTES = 128 << 20
#: Bytes of the objects that hold a chunk, beside its characters.
OVERHEAD = 300
#: Longer chunks are segmented where they occur; whole texts without a space are such.
LONGEST = 256
#: Characters whose new chunks are segmented in one call of the library.
SHARE = 1 << 20


class ChunkTable:
    """Ids and text of each chunk seen, by a SentencePiece model."""

    def __init__(self, model: bytes, size: int = TABLE_BYTES):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = map(self.library.id_to_piece, range(self.library.vocab_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross markers; chunks would not be independent")
        if self.library.encode(f"{MARK}a") != self.library.encode(" a"):
            raise ValueError("this model does not mark spaces")
        # Of an empty text the library makes nothing, so a lone marker is taken from behind a letter.
        self.lone = self.library.encode(f"a{MARK}")[len(self.library.encode("a")) :]
        self.size, self.held, self.known = size, 0, {}
        self.chunk = re.compile(f"{MARK}+[^{MARK}]*")
        self.begin = array("I", [self.library.bos_id()]).tobytes()
        self.end = array("I", [self.library.eos_id()]).tobytes()

    def chunks(self, text: str) -> list[str]:
        """The chunks in order, each without its first marker, which the library adds."""
        if not text:
            return []
        if MARK in text or "  " in text or text[0] == " ":
            return [c[1:] for c in self.chunk.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")  # every run is one marker

    def segmented(self, new: list[str]) -> dict[str, tuple[bytes, str]]:
        """Packed ids and decoded text of each chunk."""
        ids = self.library.encode(new, num_threads=1)
        ids = [i if c else self.lone for c, i in zip(new, ids, strict=True)]
        texts = self.library.decode(ids)
        return {c: (array("I", own).tobytes(), " " + t) for c, own, t in zip(new, ids, texts, strict=True)}

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Packed little-endian ids with begin and end id, and the decoded text, of each."""
        rows = list(map(self.chunks, texts))
        if self.held > self.size:
            self.known, self.held = {}, 0
        known, long_ = self.known, {}
        new = {c for chunks in rows for c in chunks if c not in known}
        if new:
            for chunk, found in self.segmented(list(new)).items():
                if len(chunk) > LONGEST:
                    long_[chunk] = found
                else:
                    known[chunk] = found
                    self.held += OVERHEAD + 2 * len(chunk) + len(found[0])
        packed = []
        for chunks in rows:
            parts = [known.get(c) or long_[c] for c in chunks]
            ids = b"".join([p[0] for p in parts])
            packed.append((self.begin + ids + self.end, "".join([p[1] for p in parts])[1:]))
        return packed


def shares(texts: list[str]) -> Iterator[list[str]]:
    """Texts by turns, some ``SHARE`` characters at a time; one at least."""
    share: list[str] = []
    size = 0
    for text in texts:
        share.append(text)
        size += len(text)
        if size >= SHARE:
            yield share
            share, size = [], 0
    if share:
        yield share


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``n_tokens``, ``ids`` (packed uint32), ``decoded``.

    ``ids`` equal the library's for the whole text with begin and end id; ``decoded`` is
    the text that the library decodes from them. NULL texts count as empty and give the
    two outer ids. Rows that repeat are encoded each; an empty table gives an empty
    result. The model file (half a megabyte) is read where the job starts and sent to
    the tasks; a task's table is bounded, and a text's chunks are looked up in order, so
    memory is a batch of texts and their ids.
    """
    by_batches(docs.sparkSession)
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model.value)
        for batch in batches:
            pairs = [p for texts in shares(batch.column(1).to_pylist()) for p in table.encode(texts)]
            ids = pa.array((p[0] for p in pairs), pa.binary(), size=len(pairs))
            texts = pa.array((p[1] for p in pairs), pa.string(), size=len(pairs))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, texts], ["_id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_of(F.col(text_col)).alias("_text"))
    found = rows.mapInArrow(run, f"_id {kind}, ids binary, decoded string")
    return found.withColumn("n_tokens", (F.length("ids") / 4).cast("bigint"))
