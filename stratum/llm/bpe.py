"""Byte-pair encoding and decoding by speculation and verification.

For every new word the longest vocabulary entry is taken greedily from the left.
A token sequence is the exact merge result if and only if each token is what its
own bytes merge to and each adjacent pair is *compatible*: merging the two
tokens' bytes together gives back just these two. The pairs of all new words of
a batch are tested together in numpy by walking both tokens' merge trees along
the seam; only words with a failing pair go through exact merging.

The tokenizer file (JSON: BPE with an end-of-word suffix, NFC, white space,
lower case, a split pattern and the byte alphabet) is a parameter; it is read
once per worker and never written anywhere.

Defined results: null text counts as empty (no ids, empty decoding); extra
columns are ignored; a null id gives a row with a null id; repeated rows give a
row each; an empty table gives an empty result. Whole texts are encoded, those of
very many words in pieces; memory holds one batch plus a bounded table of words.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stratum.llm.common import row_step, scan

#: White space as the file's ``\s`` means it (Unicode White_Space).
SPACE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Words remembered between batches by a worker at most; a batch has half as many of its own.
WORD_LIMIT = 400_000


def byte_alphabet() -> list[str]:
    """byte -> the visible character that stands for it: printable Latin-1 for
    itself, the other bytes in order from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = (b for b in range(256) if b not in plain)
    shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [shown[b] for b in range(256)]


class Bpe:
    """Vocabulary, merges and the pair test of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE))
        self.pieces = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        self.text_of = {i: t for t, i in (self.vocab | self.added).items()}
        size = max(self.text_of) + 1
        self.rank: dict[tuple[int, int], int] = {}
        self.result: list[int] = []
        # merge tree: the two halves and the rank of each merged token
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        self.made = np.full(size, -1, np.int64)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            i, j, k = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rank[i, j] = rank
            self.result.append(k)
            if self.made[k] < 0:
                self.left[k], self.right[k], self.made[k] = i, j, rank
        keys = np.array([i << 32 | j for i, j in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array(list(self.rank.values()), np.int64)[order]
        self.alphabet = byte_alphabet()
        self.never = len(model["merges"])
        self.longest = max(map(len, self.vocab))
        # a token that its own characters don't merge to is never proposed
        self.sound = {t: i for t, i in self.vocab.items() if self.made[i] < 0 or self.merged(self.symbols(t)) == [i]}
        self.known: dict[str, tuple[str, str, int]] = {}

    def symbols(self, shown: str) -> list[str]:
        """Characters of a spelled word, the last one with the suffix on it."""
        end = self.suffix and shown.endswith(self.suffix) and len(shown) > len(self.suffix)
        body = shown[: -len(self.suffix)] if end else shown
        return [*body[:-1], body[-1] + self.suffix] if end else list(body)

    def merged(self, symbols: list[str]) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost of equals."""
        ids = [self.vocab[s] for s in symbols]
        rank, never = self.rank, self.never
        ranks = [rank.get(p, never) for p in zip(ids, ids[1:])]
        while ranks and (lowest := min(ranks)) < never:
            k = ranks.index(lowest)
            ids[k : k + 2] = [self.result[lowest]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get((ids[k - 1], ids[k]), never)
            if k < len(ranks):
                ranks[k] = rank.get((ids[k], ids[k + 1]), never)
        return ids

    def proposed(self, spelled: str) -> list[int]:
        """Greedy longest matches; the last token carries the suffix."""
        out, at, end = [], 0, len(spelled)
        stop = end - len(self.suffix)  # a token ends before the suffix or covers it
        sound, longest = self.sound, self.longest
        while at < end:
            to = min(end, at + longest)
            while True:
                if (to <= stop - 1 or to == end) and (i := sound.get(spelled[at:to])) is not None:
                    break
                to -= 1
            out.append(i)
            at = to
        return out

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, ``never`` without one."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.never)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the seam between the bytes of ``a`` and ``b``.

        The parts that touch the seam grow as the merges run in rank order. Going
        back from the finished tokens, the later of the two last merges is undone
        each time; a merge across the seam would have come first if it ranks below
        the merge that was undone last (on the left side: at most equal, since the
        leftmost of equal merges runs first).
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        bar = np.full(len(a), self.never, np.int64)
        while len(live):
            crosses = self.rank_of(a, b) < bar
            ok[live[crosses]] = False
            made_a, made_b = self.made[a], self.made[b]
            go = ~crosses & ((made_a >= 0) | (made_b >= 0))
            live, a, b, made_a, made_b = live[go], a[go], b[go], made_a[go], made_b[go]
            undo_a = made_a > made_b
            # equal ranks: the left one ran first, so the right one is undone first
            bar = np.where(undo_a, made_a, made_b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def learn(self, words: list[str]) -> dict[str, tuple[str, str, int]]:
        """Encode words together: their ids, spelling and number of ids."""
        spelled = ["".join(map(self.alphabet.__getitem__, w.encode("utf-8", "surrogatepass"))) + self.suffix for w in words]
        tokens = [self.proposed(s) for s in spelled]
        flat = np.fromiter((t for ts in tokens for t in ts), np.int64)
        owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        inner = owner[1:] == owner[:-1]
        bad = set(owner[1:][inner][~self.compatible(flat[:-1][inner], flat[1:][inner])].tolist())
        out = {}
        for k, (word, s) in enumerate(zip(words, spelled)):
            ids = self.merged(self.symbols(s)) if k in bad else tokens[k]
            out[word] = (" ".join(map(str, ids)), " ".join(map(self.text_of.__getitem__, ids)), len(ids))
        return out

    def encode_long(self, parts: list[str | int]) -> tuple[int, str, str]:
        """One text of very many words, by pieces of its words; nothing is remembered."""
        n, ids, decoded = 0, [], []
        for at in range(0, len(parts), WORD_LIMIT // 2):
            piece = parts[at : at + WORD_LIMIT // 2]
            own = self.learn(list(dict.fromkeys(w for w in piece if not isinstance(w, int))))
            got = [own[w] if not isinstance(w, int) else (str(w), self.text_of[w], 1) for w in piece]
            n += sum(g[2] for g in got)
            ids.append(" ".join([g[0] for g in got]))
            decoded.append(" ".join([g[1] for g in got]))
        return n, " ".join(ids), " ".join(decoded)

    def split(self, text: str) -> list[str | int]:
        """Words of a normalised text, and the ids of added tokens found in it."""
        if not any(t in text for t in self.added):
            return self.words.findall(normalised(text))
        parts: list[str | int] = []
        at = 0
        for m in self.pieces.finditer(text):
            parts += self.words.findall(normalised(text[at : m.start()]))
            parts.append(self.added[m[0]])
            at = m.end()
        return parts + self.words.findall(normalised(text[at:]))

    def encode_batch(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Per text: number of ids, the decimal ids and the decoding, space-joined."""
        parts = [self.split(t or "") for t in texts]
        new = dict.fromkeys(w for p in parts for w in p if w not in self.known and not isinstance(w, int))
        out: list[tuple[int, str, str] | None] = [None] * len(texts)
        if len(new) > WORD_LIMIT // 2:  # very many words: by halves, or one text by pieces
            if len(texts) == 1:
                return [self.encode_long(parts[0])]
            half = len(texts) // 2
            return self.encode_batch(texts[:half]) + self.encode_batch(texts[half:])
        own = self.learn(list(new)) if new else {}
        # this batch still reads words remembered before: they go only once it is encoded
        known = self.known
        if len(known) + len(own) > WORD_LIMIT:
            lookup = lambda w: own[w] if w in own else known[w]
            self.known = own
        else:
            known.update(own)
            lookup = known.__getitem__
        for k, p in enumerate(parts):
            got = [lookup(w) if not isinstance(w, int) else (str(w), self.text_of[w], 1) for w in p]
            out[k] = (sum(g[2] for g in got), " ".join([g[0] for g in got]), " ".join([g[1] for g in got]))
        return out

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by a space (the file names no decoder); special tokens stay."""
        return " ".join(self.text_of[i] for i in ids if i in self.text_of)


def normalised(text: str) -> str:
    """NFC, white space runs to a space, lower case by character (no final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array) and ``decoded`` of every text."""

    def step(batches):
        bpe = load(path)
        for batch in batches:
            got = bpe.encode_batch(batch.column(1).to_pylist())
            ids = [[int(i) for i in g[1].split()] for g in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([g[2] for g in got], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return scan(docs, [id_col, text_col], step, "doc_id long, ids array<int>, decoded string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``decoded`` from a column ``ids`` (null: empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])

    def make():
        bpe = load(path)
        return lambda doc, ids: (doc, bpe.decode(ids or []))

    return scan(encoded, ["doc_id", "ids"], row_step(make, schema), "doc_id long, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: what a table of
    ids would hold, as digests, without moving the ids."""

    def step(batches):
        bpe = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                got = bpe.encode_batch(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array([g[0] for g in got], pa.int64()),
                        pa.array([sha256(g[1]) for g in got], pa.string()),
                        pa.array([sha256(g[2]) for g in got], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return scan(docs, [id_col, text_col], step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
