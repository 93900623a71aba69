"""Token ids of white-space separated chunks, computed once per distinct chunk and worker.

The tokenizer drops white space before its merges, so a text's ids are the ids of its chunks in
order, and a chunk's ids do not depend on its neighbours. A chunk that is not in the cache is split
into letters and closing punctuation; a part that the simple rules do not cover goes through the
library as it is.
"""

from __future__ import annotations

import os
import re
import unicodedata

#: str.split() also splits at these; the tokenizer does not.
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_TAIL = re.compile(r"[!-&(-/:-@\[-`{-~]+\Z")  # ASCII punctuation without the apostrophe


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class ChunkIds:
    """Ids of a chunk as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, limit: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = byte_letters()
        self.limit = limit
        self.frequent: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if _ODD_SPACE.search(text):
            return [c for c in re.split(r"[^\S\x1c-\x1f]+", text) if c]
        return text.split()

    def _encode(self, chunk: str) -> bytes:
        return self._pack(self.library.encode(chunk, add_special_tokens=False).ids)

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _part(self, part: str) -> bytes:
        """Ids of lower-case letters only, or of ASCII punctuation only."""
        found = self.parts.get(part)
        if found is None:
            spelt = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            found = self.parts[part] = self._pack([t.id for t in self.model.tokenize(spelt)])
            if len(self.parts) > self.limit:
                self.parts.clear()
        return found

    def encode(self, chunk: str) -> bytes:
        """Ids of one chunk, without looking at the cache of chunks."""
        plain = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
        if "<|" in plain or "Σ" in plain:
            return self._encode(chunk)
        plain = plain.lower()
        if plain.isalpha():
            return self._part(plain)
        tail = _TAIL.search(plain)
        if tail and (tail.start() == 0 or plain[:tail.start()].isalpha()):
            head = plain[:tail.start()]
            return (self._part(head) if head else b"") + self._part(tail[0])
        return self._encode(chunk)

    def of(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk: the fixed table first, then this worker's cache, then the tokenizer."""
        get, cache = self.frequent.get, self.chunks
        found = list(map(get, chunks))
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    chunk = chunks[at]
                    ids = cache.get(chunk)
                    if ids is None:
                        if len(cache) >= self.limit:
                            cache.clear()
                        ids = cache[chunk] = self.encode(chunk)
                    found[at] = ids
        return found

    def ids(self, text: str) -> bytes:
        return b"".join(self.of(self.split(text)))


_WORKER: dict[str, ChunkIds] = {}


def worker_ids(path: str) -> ChunkIds:
    """This process's tokenizer and cache."""
    if path not in _WORKER:
        _WORKER[path] = ChunkIds(path)
    return _WORKER[path]
