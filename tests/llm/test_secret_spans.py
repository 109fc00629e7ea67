"""All spans of the secret scan against a plain version; short keys; cut runs."""

import base64
import hashlib
import random
import re
import string

import duckdb
import public_tokenizers
import tiktoken

from conftest import SF_CHECK
from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import secret_scan

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
KINDS = ["assign", "access", "hex", "random"]


def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(text, enc):
    """Character by character: which belong to a base span, and the stretches beside them."""
    text = text or ""
    base = [("assign", *m.span()) for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.ASCII) if len(m[2]) > 7]
    base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) > 15]
    base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) > 31]
    inside = {i for _, s, e in base for i in range(s, e)}
    keylike = set(string.ascii_letters + string.digits + "+/_=-")
    found, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in keylike and end not in inside:
            end += 1
        run = text[at:end]
        digest = len(run) in (32, 40, 56, 64, 96, 128) and (re.fullmatch("[0-9a-f]+", run) or re.fullmatch("[0-9A-F]+", run))
        uuid = re.fullmatch("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", run)
        if len(run) >= 16 and not digest and not uuid and len(run) < (2.2 if len(run) > 19 else 1.85) * len(enc.encode_ordinary(run)):
            found.append(("random", at, end))
        at = max(end, at + 1)
    order = lambda x: sorted(x, key=lambda s: (s[1], KINDS.index(s[0])))
    spell = lambda x: ",".join(f"{k}:{s}:{e}" for k, s, e in order(x))
    counts = [sum(k == kind for k, *_ in base + found) for kind in KINDS]
    return (*counts, hashlib.sha256(spell(base).encode()).hexdigest(), spell(base + found))


def scan(frame):
    return secret_scan.scan_secrets(frame, RANKS, public_tokenizers.PATTERN).collect()


def test_spans_equal_the_plain_version(spark, docs):
    enc, r = library(), random.Random(3)
    key = lambda n: "".join(r.choice(string.ascii_letters + string.digits) for _ in range(n))
    bits = ["token=", "password: ", "AKIA", "/", "-", "x/", " ", "\n", "words of a text", "e3b0c44298fc1c149afbf4c8996fb924", "é", "=", "123e4567-e89b-12d3-a456-426614174000"]
    texts = ["".join(r.choice([*bits, key(8), key(16), key(19), key(30)]) for _ in range(r.randrange(12))) for _ in range(400)]
    texts += [None, "", " ", "x/" + key(24) + "/token=abcdefgh", "token=abcdefgh " + key(16), "same " + key(20)] * 2
    texts += [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF_CHECK}/documents.parquet' WHERE length(text) < 6000 LIMIT 300").fetchall()]
    rows = [*enumerate(texts), (None, "token: abcdefgh1")]
    got = sorted(((x.doc_id, tuple(x)[1:]) for x in scan(docs(rows))), key=str)
    assert got == sorted(((d, plain(t, enc)) for d, t in rows), key=str)
    assert sum(x[1][3] for x in got) > 300 and scan(docs([])) == []


def test_short_keys_are_found(spark, docs):
    r = random.Random(2)
    for n in (16, 19, 20):
        keys = ["".join(r.choice(string.ascii_letters + string.digits) for _ in range(n)) for _ in range(200)]
        assert sum(x.n_random for x in scan(docs([(i, f"see {k} here") for i, k in enumerate(keys)]))) >= 198
    words = ["internationalization", "responsibilities", "telecommunication", "state-of-the-art", "Donaudampfschifffahrt", "2024-01-15-release-notes"]
    assert not any(x.n_random for x in scan(docs(list(enumerate(words)))))


def test_what_a_base_span_leaves_of_a_run(spark, docs):
    text = "x/zX9qK7vLw2RtY8mPbN4sD6fG/token=abcdefgh"
    assert scan(docs([(1, text)]))[0].spans == "random:0:27,assign:27:41"
