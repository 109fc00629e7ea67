"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from conftest import SF_SMALL
from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import byte_bpe
from stratum.llm.queries import queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(enc, text):
    ids = enc.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def random_texts(seed, count):
    r = random.Random(seed)
    pool = list("aàbsStTrREveVmMlLdD'''  \n\t\r   12٣½!.,?-_{}\x1c\x85 é中文\U0001F600́ⅷ\U000105c0\x00") + ["'re", "'ll", "'s", " '", "\n\n", "  ", "n't", "I've"]
    return ["".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(count)]


def test_equals_the_library(spark, docs):
    enc = library()
    texts = random_texts(1, 600) + [None, "", " ", "\n", "'", "'s", "same", "same", "a" * 60_000, " " * 5000, "x'll " * 5000, "q\n" * 3000]
    rows = list(enumerate(texts)) + [(None, "no id")]
    got = byte_bpe.digests(docs(rows), RANKS).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {d: wanted(enc, t) for d, t in rows}
    encoded = byte_bpe.encode(docs(rows), RANKS)
    for r in encoded.collect():
        raw = (dict(rows)[r.doc_id] or "").encode()
        token = [raw[a:b] for a, b in zip(r.offsets, [*r.offsets[1:], len(raw)])]
        assert token == [enc.decode_single_token_bytes(i) for i in r.ids]
    assert {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(encoded, RANKS).collect()} == {d: (t or "").encode() for d, t in rows}
    assert byte_bpe.digests(docs([]), RANKS).collect() == []


def test_every_code_point_and_batches_of_texts():
    enc, own = library(), byte_bpe.load(RANKS)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    random.Random(2).shuffle(every)
    assert np.frombuffer(next(own.encode(["".join(every)])), "<u4").tolist() == enc.encode_ordinary("".join(every))
    texts = random_texts(7, 4000)
    for at in range(0, len(texts), 97):
        some = texts[at : at + 97]
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(some)] == enc.encode_ordinary_batch(some)


def test_scan_equals_one_walk():
    """Composed chunk functions give what the automaton gives symbol by symbol."""
    syms = np.random.default_rng(4).integers(0, 9, 5000).astype(np.uint8)
    state, walked = byte_bpe.OPEN, []
    for s in syms:
        walked.append(bool(byte_bpe.STARTS[s, state]))
        state = byte_bpe.TO[s, state]
    for n in (1, 511, 512, 513, 5000):
        assert byte_bpe.piece_starts(syms[:n]).tolist() == walked[:n]


def test_small_memory_gives_the_same(monkeypatch):
    enc = library()
    monkeypatch.setattr(byte_bpe, "PIECES", 3)
    monkeypatch.setattr(byte_bpe, "GROUP", 50)
    own = byte_bpe.ByteBpe(RANKS)
    texts = random_texts(9, 200)
    got = [b for g in byte_bpe.groups(texts) for b in own.encode(g)]
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == enc.encode_ordinary_batch(texts)


def test_registered_query(spark):
    enc = library()
    got = queries()["op12_byte_bpe"](spark, SF_SMALL).collect()
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, *wanted(enc, r.text)) for r in rows)
