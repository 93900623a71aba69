"""Token counts and byte-level BPE against the libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
from hiremart.llm import byte_bpe, token_counts
from hiremart.llm.byte_bpe import ByteBpe
from hiremart.llm.word_tokens import ChunkIds
from tests.conftest import SF
from tests.llm import cases

WORD_FILE, BYTE_FILE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")
ODD = ["", " a", "a ", "a  b", "a\n b", " \n\n  a", "\x1c a\x1cb", "<|endoftext|> x <|END", "ΣΑΣ Σ İstanbul", "éa ́x", "日本語 テスト,",
       " " * 300 + "x" * 500, "don't I'LL we've", "１２３ ٣ ½", "😀🏽‍♀️", "\x00a\x00 b", "a b\xa0c\x85d", "it's, 'tis", "ẛ̣ ÅΩ"]


def noise(n=400):
    r = random.Random(3)
    ranges = [(1, 0x250), (1, 0x80), (0x300, 0x1200), (0x2000, 0x2100), (32, 33), (0x3A3, 0x3A4), (39, 45)]
    return ["".join(chr(r.randrange(*r.choice(ranges))) for _ in range(r.randrange(1, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_FILE)


@pytest.fixture(scope="module")
def tik():
    with open(BYTE_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def unpack(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def test_chunk_ids_equal_the_library(library):
    tokens = ChunkIds(WORD_FILE, limit=50)  # the caches overflow
    for text in ODD + noise():
        assert unpack(tokens.ids(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_byte_bpe_equals_tiktoken_and_round_trips(tik):
    bpe = ByteBpe(BYTE_FILE, P.PATTERN, limit=50)
    for text in ODD + noise():
        ids = bpe.encode(text)
        assert unpack(ids) == tik.encode_ordinary(text), repr(text)
        assert bpe.decode(ids) == text.encode()


def test_counts_of_the_table(spark, library):
    got = {r["doc_id"]: r for r in entry.queries()["op9_token_counts"](spark, SF).collect()}
    for row in cases.table(spark, SF):
        n = len(library.encode(row["text"] or "", add_special_tokens=False).ids)
        assert (got[row["doc_id"]]["n_tokens"], got[row["doc_id"]]["over_limit"]) == (n, n > 2048)
        assert got[row["doc_id"]]["n_bytes"] == len((row["text"] or "").encode())


def test_encoding_of_the_table(spark, tik):
    got = {r["doc_id"]: r for r in entry.queries()["op6_byte_bpe"](spark, SF).collect()}
    for row in cases.table(spark, SF):
        ids = tik.encode_ordinary(row["text"] or "")
        found = got[row["doc_id"]]
        assert found["n_tokens"] == len(ids)
        assert found["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert found["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_odd_rows(spark, library, tik):
    want = sorted((str(r[0]), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in cases.ODD_ROWS)
    counts = token_counts.token_counts(cases.odd(spark), WORD_FILE)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in counts.collect()) == want
    encoded = byte_bpe.decode(byte_bpe.encode(cases.odd(spark), BYTE_FILE, P.PATTERN), BYTE_FILE, P.PATTERN)
    assert sorted((str(r["doc_id"]), bytes(r["bytes"])) for r in encoded.collect()) == sorted(
        (str(r[0]), (r[1] or "").encode()) for r in cases.ODD_ROWS)
    assert token_counts.token_counts(cases.empty(spark), WORD_FILE).count() == 0
    assert byte_bpe.encode(cases.empty(spark), BYTE_FILE, P.PATTERN).count() == 0


def test_no_pre_token_is_shuffled(spark):
    counts = token_counts.token_counts(spark.read.parquet(f"{SF}/documents.parquet"), WORD_FILE)
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
