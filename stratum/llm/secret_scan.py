"""Secret scan: pattern finds plus a token-efficiency test.

Three base patterns (assignments, access keys, long hex) are searched in every
text. Beyond them, runs of key-like characters are encoded with a byte-level
vocabulary: words of a language cost few tokens a character, random strings
many, so a run whose characters per token fall under ``max_ratio`` is reported
as ``random``, unless it is a known identifier form (a digest of a usual length,
a UUID). Base spans are cut out of a run first and what is left on either side is
judged by itself. Runs of 16 to 19 characters need a lower ratio, ``short_ratio``: so
short a word of a language can cost as many tokens as a random string of one case.
Runs of letters of one case are judged like others; a few random ones lie just above.

Defined results: null or empty text has no span; extra columns are ignored; a
null id gives a row with a null id; repeated rows give a row each; an empty
table gives an empty result. Whole texts are searched.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from stratum.llm.common import row_step, scan

#: Order of the kinds where spans start together.
KINDS = ("assign", "access", "hex", "random")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
#: Characters of the shortest run that is judged, and of the shortest judged by ``max_ratio``.
SHORTEST, LONG = 16, 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Lengths of hex digests in common use (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the three base kinds, sorted by start, then kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    # runs of [0-9a-f] are maximal either way, so the short ones needn't be visited
    found += [("hex", *m.span()) for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def known_identifier(run: str) -> bool:
    """Digests of a usual length, and UUIDs."""
    return bool(
        (len(run) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run))
        or UUID.fullmatch(run)
    )


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """The tiktoken encoding of a rank file (loaded once per worker)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def outside(start: int, end: int, base: list[Span]) -> list[tuple[int, int]]:
    """What is left of a run when the base spans (sorted by start) are cut out."""
    left = []
    for _, s, e in base:
        if s < end and start < e:
            left.append((start, s))
            start = max(start, e)
    return [(s, e) for s, e in [*left, (start, end)] if e - s >= SHORTEST]


def finder(path: str, pattern: str, max_ratio: float, short_ratio: float) -> Callable[[str, list[Span]], list[Span]]:
    """text -> spans of the method: runs that cost too many tokens."""
    enc = encoder(path, pattern)

    def find(text: str, base: list[Span]) -> list[Span]:
        found = []
        for m in RUN.finditer(text):
            for start, end in outside(*m.span(), base):
                run = text[start:end]
                ratio = max_ratio if len(run) >= LONG else short_ratio
                if not known_identifier(run) and len(run) < ratio * len(enc.encode_ordinary(run)):
                    found.append(("random", start, end))
        return found

    return find


def spell(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan_secrets(
    docs: DataFrame,
    rank_file: str,
    token_pattern: str,
    max_ratio: float = 2.2,
    short_ratio: float = 1.85,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per text: counts by kind, digest of the base spans, all spans."""
    schema = pa.schema(
        [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())]
    )

    def make():
        find = finder(rank_file, token_pattern, max_ratio, short_ratio)

        def one(doc, text):
            text = text or ""
            base = base_spans(text)
            every = sorted(base + find(text, base), key=lambda s: (s[1], KINDS.index(s[0])))
            kinds = [s[0] for s in every]
            return doc, *map(kinds.count, KINDS), hashlib.sha256(spell(base).encode()).hexdigest(), spell(every)

        return one

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return scan(docs, [id_col, text_col], row_step(make, schema), f"doc_id long, {kinds}, base_sha256 string, spans string")
