"""Quality rules as a bitmask ledger.

``measure`` counts each text once; ``ledger`` evaluates every rule once on the
counts and gives the failures as one bigint of bits beside the measurements;
``write_ledger`` stores that as a Parquet table with the rules in force beside it,
and ``read_ledger`` refuses a book whose bits mean other rules. A ``Policy`` is a versioned mask over those bits: applying another version, or
asking what one rule alone removes, is bitwise work on the ledger and never
reads a text again.

Defined results: null or empty text counts zero words; extra columns of the
input are ignored; a null id gives a row with a null id; repeated rows give a
row each; an empty table gives an empty ledger. Whole texts are read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import row_step, scan, utf8
from stratum.session import create_file, read_file

SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
)


@dataclass(frozen=True)
class Rule:
    """A bit and the SQL condition (on the measures) under which a text fails."""

    bit: int
    name: str
    fails: str


#: Integer comparisons only, so every engine decides alike.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule(5, "capitals", "2 * n_upper > word_chars"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version and the rules whose failure rejects a text."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in set(self.rules))


LEDGER = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", fail_bits long"
POLICIES = {
    1: Policy(1, BASE),
    2: Policy(2, tuple(r.name for r in RULES)),
}


def counts(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    raw = utf8(text)
    words = raw.split()
    n = len(words)
    letters = raw.translate(None, b" \t\n\r\x0b\x0c")
    chars = len(letters.decode("utf-8", "surrogatepass"))
    symbols = sum(map(letters.count, (bytes([s]) for s in SYMBOLS)))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    upper = len(letters) - len(letters.translate(None, bytes(range(65, 91))))
    return n, chars, symbols, len(lines) - len(set(lines)), repeated(words), len(lines), upper


def repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(seen) + ids[1:]
    _, pairs = np.unique(pairs, return_inverse=True)  # keeps the products in 64 bits
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    hit = times[which] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : k + len(hit)] |= hit
    return int(inside.sum())


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measures of every text."""
    schema = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in MEASURES)])
    step = row_step(lambda: lambda doc, text: (doc, *counts(text)), schema)
    return scan(docs, [id_col, text_col], step, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(measures: DataFrame) -> DataFrame:
    """The measures plus ``fail_bits``: bit b set where rule b fails."""
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit}L ELSE 0L END" for r in RULES)
    return measures.withColumn("fail_bits", F.expr(bits))


def rules_text() -> str:
    return json.dumps([[r.bit, r.name, r.fails] for r in RULES])


def write_ledger(book: DataFrame, path: str) -> None:
    """Store a ledger: texts are not read again, whatever policy is asked for later."""
    book.write.parquet(path)
    create_file(book.sparkSession, f"{path}/_rules.json", rules_text())


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A stored ledger; raises if it was made under other rules."""
    if read_file(spark, f"{path}/_rules.json") != rules_text():
        raise ValueError(f"the bits of {path} stand for other rules than these")
    return spark.read.schema(LEDGER).parquet(path)


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """``kept``: no rule of the policy fails."""
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablation(book: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: texts that fail it, and texts that it alone rejects.

    One aggregate gathers the ledger into a row per bit pattern (at most
    2^rules); the bits are taken apart on that histogram.
    """
    patterns = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = [(r.name, 1 << r.bit) for r in RULES if r.name in policy.rules]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules]))
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    return (
        patterns.withColumn("r", each)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit.bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_fail"),
            F.sum(F.when(hit == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )
