"""SentencePiece encoding and decoding through a table of distinct chunks.

If no piece of the model holds a word marker after another character, no
piece crosses the start of a marked word, so a text's segmentation is that of
its marked words one after another. Each distinct marked word of a batch is
segmented once by the library, and ids are joined back by position. The table
lives as long as the task and is emptied at `TABLE` entries or `BYTES` characters
and ids' bytes, whichever comes first, so memory is bounded by these and one group
of texts; nothing is shuffled, and a word that makes up a third of all words
costs one lookup each time. Where a model has a crossing piece, or rewrites its
input, texts are segmented whole.

Defined cases. A null or empty text has the begin and end ids only. All rows
stay, repeated ones too; other columns pass through untouched.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
TABLE = 1 << 18
BYTES = 1 << 24
#: Characters of the texts that are looked up together.
GROUP = 1 << 20
ENCODED = "ids binary, n_tokens bigint, decoded string"
#: The runs of blanks before a word, with the word; blanks at the end by themselves.
MARKED_WORD = re.compile(" +[^ ]*")


@lru_cache(maxsize=2)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


#: Texts on which a model that leaves its input as it is shows no change.
_PLAIN = ("a  b ", " \t\néé½　ﬁ x", "A")


@lru_cache(maxsize=2)
def chunkable(model: str) -> bool:
    """Whether marked words can be segmented by themselves."""
    lib = processor(model)
    pieces = (lib.id_to_piece(i) for i in range(lib.get_piece_size()))
    return (
        lib.piece_to_id(MARK) != lib.unk_id()
        and not any(MARK in p.lstrip(MARK) for p in pieces)
        and all(lib.decode(lib.encode(t)) == t for t in _PLAIN)
    )


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkTable:
    """Distinct marked words with their ids, little-endian, and their decoded text."""

    def __init__(self, model: str, size: int = TABLE, room: int = BYTES):
        self.lib, self.size, self.room, self.held = processor(model), size, room, 0
        self.whole = not chunkable(model)
        self.ids: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}  # the words that do not decode to themselves
        self.begin, self.end = little_endian([self.lib.bos_id()]), little_endian([self.lib.eos_id()])

    def _learn(self, chunks: set[str]) -> None:
        if len(self.ids) + len(chunks) > self.size or self.held > self.room:
            self.ids, self.changed, self.held = {}, {}, 0  # a group of texts finds all its words, however many
        new = [c for c in chunks if c not in self.ids]
        # the library puts one marker before what it is given, unless that is empty
        coded = self.lib.encode([c[1:] for c in new], num_threads=1)
        if " " in chunks and " " in new:
            coded[new.index(" ")] = [self.lib.piece_to_id(MARK)]
        for chunk, ids, text in zip(new, coded, self.lib.decode(coded, num_threads=1) if new else ()):
            self.ids[chunk] = coded_bytes = little_endian(ids)
            self.held += len(chunk) + len(coded_bytes)
            if " " + text != chunk:
                self.changed[chunk] = " " + text

    def _joined(self, chunks: list[str]) -> tuple[bytes, str]:
        ids = b"".join(map(self.ids.__getitem__, chunks))
        if self.changed:
            chunks = [self.changed.get(c, c) for c in chunks]
        return self.begin + ids + self.end, "".join(chunks)[1:]

    def _whole(self, text: str) -> tuple[bytes, str]:
        ids = self.lib.encode(text, add_bos=True, add_eos=True)
        return little_endian(ids), self.lib.decode(ids)

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[bytes, str]]:
        """For each text all ids, with begin and end, and what they decode to."""
        if self.whole:
            yield from map(self._whole, texts)
            return
        group, length = [], 0
        for text in texts:
            group.append(MARKED_WORD.findall(" " + text.replace(MARK, " ")) if text else [])
            length += len(text)
            if length > GROUP:
                yield from self._group(group)
                group, length = [], 0
        yield from self._group(group)

    def _group(self, group: list[list[str]]) -> Iterator[tuple[bytes, str]]:
        self._learn(set().union(*group))
        return map(self._joined, group)


def encoded(text: str, model: str) -> Column:
    """A struct of `ids` (unsigned 32-bit, little-endian), `n_tokens` and `decoded`."""

    @F.arrow_udf(ENCODED)
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = ChunkTable(model)
        for batch in texts:
            ids, decoded = [], []
            for coded in table.encode(t.as_py() or "" for t in batch):
                ids.append(coded[0])
                decoded.append(coded[1])
            yield pa.StructArray.from_arrays(
                [
                    pa.array(ids, pa.binary()),
                    pa.array((len(i) // 4 for i in ids), pa.int64()),
                    pa.array(decoded, pa.string()),
                ],
                ["ids", "n_tokens", "decoded"],
            )

    return encode(F.col(text).cast("string"))


def with_pieces(docs: DataFrame, model: str, text: str = "text", into: str = "pieces") -> DataFrame:
    """docs with the struct of `encoded` as one more column, which replaces one of that name."""
    return docs.withColumn(into, encoded(text, model))


def id_list(ids: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))
