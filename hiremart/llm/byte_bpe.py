"""Byte-level BPE through a sentencepiece model that is written directly from a rank file.

Every vocabulary entry becomes a piece whose letters stand for its bytes, scored by its negative
rank, so the best-scored merge is the lowest-ranked one; ids are the ranks. Normalisation is the
identity, without prefix space or white-space escaping. Texts are cut into pre-tokens, each
distinct one is encoded once per worker, and ids are decoded by the inverse of the letter table.

Null texts are encoded as empty, invalid ids raise, repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from hiremart.llm.common import map_rows, text_of
from hiremart.llm.word_tokens import byte_letters


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: pieces (1), trainer spec (2) and normalizer spec (3) of the public format."""
    letters = byte_letters()
    pieces = [b""] * len(ranks)
    for token, rank in ranks.items():
        body = _block(1, "".join([letters[b] for b in token]).encode())
        pieces[rank] = _block(1, body + _varint(2 << 3 | 5) + struct.pack("<f", -rank))
    unknown = _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0) + _number(3, 2))
    absent = 2**64 - 1  # -1: no such piece
    trainer = _block(2, _number(3, 2) + _number(40, len(ranks)) + _number(41, absent) + _number(42, absent)
                     + _number(43, absent))
    normalizer = _block(3, _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return b"".join(pieces) + unknown + trainer + normalizer


class ByteBpe:
    """Encoder and decoder of one rank file; keeps the ids of distinct pre-tokens up to a limit."""

    def __init__(self, path: str, pattern: str, limit: int = 400_000) -> None:
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.letters = byte_letters()
        self.values = {letter: b for b, letter in enumerate(self.letters)}
        self.whole = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.tokens = [bytes(map(self.values.__getitem__, self.model.id_to_piece(i))) for i in range(len(ranks))]
        self.find = regex.compile(pattern).findall
        self.limit, self.chunks, self.pieces = limit, {}, {}

    def pre_token(self, piece: str) -> bytes:
        """Ids of one pre-token; one that is an entry itself is that entry, as in the tiktoken library."""
        data = piece.encode("utf-8")
        ids = self.whole.get(data)
        if ids is None:
            found = self.model.encode("".join([self.letters[b] for b in data]))
            ids = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _chunk(self, chunk: str) -> bytes:
        found = []
        for piece in self.find(chunk):
            ids = self.pieces.get(piece)
            if ids is None:
                if len(self.pieces) >= self.limit:
                    self.pieces.clear()
                ids = self.pieces[piece] = self.pre_token(piece)
            found.append(ids)
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        No match of the pattern spans the place before a single space between two other characters,
        so a text without any other space is cut there and each distinct chunk is matched once.
        """
        first, *rest = text.split(" ")
        chunks, cache = [first, *[" " + c for c in rest]], self.chunks
        found = list(map(cache.get, chunks))
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    chunk = chunks[at]
                    ids = cache.get(chunk)
                    if ids is None:
                        core = chunk[1:] if at else chunk
                        if core.strip() != core or not core:
                            return self._chunk(text)  # other white space next to a space: never kept
                        if len(cache) >= self.limit:
                            cache.clear()
                        ids = cache[chunk] = self._chunk(chunk)
                    found[at] = ids
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


_WORKER: dict[tuple[str, str], ByteBpe] = {}


def worker_bpe(path: str, pattern: str) -> ByteBpe:
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = ByteBpe(path, pattern)
    return _WORKER[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """(id, ids): the ids of each row's whole text as little-endian unsigned 32-bit integers."""

    def run(blocks: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        bpe = worker_bpe(path, pattern)
        for block in blocks:
            yield {"_id": block["_id"], "ids": [bpe.encode(t) for t in block["text"]]}

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), text_of().alias("text"))
    return map_rows(rows, run, f"_id {kind}, ids binary").withColumnRenamed("_id", id_column)


def decode(encoded: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """(id, ids, bytes): ``encoded`` with the decoded bytes of each row; null ids decode to nothing."""

    def run(blocks: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        bpe = worker_bpe(path, pattern)
        for block in blocks:
            yield block | {"bytes": [bpe.decode(i or b"") for i in block["ids"]]}

    kind = encoded.schema[id_column].dataType.simpleString()
    rows = encoded.select(F.col(id_column).alias("_id"), "ids")
    return map_rows(rows, run, f"_id {kind}, ids binary, bytes binary").withColumnRenamed("_id", id_column)
