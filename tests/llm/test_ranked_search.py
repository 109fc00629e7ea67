"""Ranked search against a plain ranking of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import ranked_search
from stratum.llm.queries import queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return Counter(TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)})))


def ranking(rows, items, k=20):
    held = [(d, c, sum(c.values())) for d, t in rows if (c := terms(t))]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in terms(text).items() if t in c
            )
            if score > 0:
                scores.append((-score, math.inf if d is None else d))
        out += [(item, r + 1, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, doc_id string, score string")


def found(spark, rows, items, frames, **options):
    return sorted(map(tuple, ranked_search.top_documents(frames(rows), items_of(spark, items), **options).collect()), key=str)


@pytest.mark.parametrize("shard,k", [(1 << 21, 20), (60, 3)])
def test_ranking_equals_plain_scoring(spark, docs, shard, k):
    r = random.Random(shard)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "ÜBER", "naïve", "x1y2", "漢字"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(r.choices(vocabulary, weights, k=n))
    rows = [(i * 7 % 400, text(r.choice([1, 3, 9, 40, 300]))) for i in range(400)]
    rows += [(500, rows[3][1]), (500, rows[3][1]), (None, rows[3][1]), (None, None), (501, ""), (502, ". ,!"), (503, "w1 " * 70000)]
    rows.append((504, "rare-only"))
    items = [(i, text(r.choice([1, 5, 30]))) for i in range(30)]
    items += [(3, text(4)), (None, text(4)), (40, None), (41, ""), (42, "unknown words"), (43, "W1 w1 w1 RARE"), (44, text(2000))]
    assert found(spark, rows, items, docs, k=k, shard_terms=shard) == ranking(rows, items, k)


def test_common_term_and_copies(spark, docs):
    """A term of every document has weight 0; copies tie by id."""
    rows = [(i, "all same words here") for i in range(200, 0, -1)]
    assert found(spark, rows, [(1, "all same")], docs) == ranking(rows, [(1, "all same")])
    rows += [(1000 + i, f"other text {i}") for i in range(300)]
    assert found(spark, rows, [(1, "all other 7")], docs) == ranking(rows, [(1, "all other 7")])


def test_empty_tables(spark, docs):
    assert found(spark, [], [(1, "a")], docs) == []
    assert found(spark, [(1, "a b")], [], docs) == []
    assert found(spark, [(1, None)], [(1, "a")], docs) == []


def test_query_blocks_and_added_shards(spark, docs, monkeypatch, tmp_root):
    r = random.Random(1)
    text = lambda n: " ".join(r.choice("abcdefghijklmnop") * r.randrange(1, 3) for _ in range(n))
    rows, items = [(i, text(20)) for i in range(120)], [(i, text(6)) for i in range(25)]
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 40)
    ranked_search.build_index(docs(rows[:50]), tmp_root + "/index")
    index = ranked_search.build_index(docs(rows[50:]), tmp_root + "/index")
    assert found(spark, rows, items, docs, index=index) == ranking(rows, items)


def test_blocks_are_packed_whole():
    """Gaps and counts of all widths come back, and no posting scores above its block."""
    r = np.random.default_rng(3)
    counts, found = [], []
    for i in range(3000):
        own = np.concatenate([np.zeros(r.integers(1, 4), np.int64), r.integers(0, 50, r.integers(1, 5)), np.full(70_000 if i == 9 else 300 if i % 500 == 1 else 0, 2)])
        counts.append(len(own))
        found.append(own)
    names = {f"t{i}".encode(): i for i in range(50)}
    head, *rows = ranked_search.shard_rows("s", list(range(3000)), counts, names, found)
    assert head[1:4] == (b"", 3000, sum(counts))
    norm = lambda n: 75 + n
    seen = 0
    for _, term, df, times, heads, fronts, packed in rows:
        p = ranked_search.Postings(heads, fronts, packed, norm)
        docs, tf = p.read(np.arange(len(p.n)))
        want = [(d, int((f == names[term]).sum())) for d, f in enumerate(found) if (f == names[term]).any()]
        assert list(zip(docs.tolist(), tf.tolist())) == want and df == len(want) and times == tf.sum()
        some = np.arange(0, len(p.n), 3)
        part, _ = p.read(some)
        assert set(part.tolist()) <= set(docs.tolist())
        score = ranked_search.impact(tf, norm(np.array(counts)[docs]))
        block = np.repeat(np.arange(len(p.n)), p.n)
        assert (np.maximum.reduceat(score, np.flatnonzero(np.r_[True, block[1:] != block[:-1]])) == p.tops).all()
        seen += df
    assert seen > 3000


def test_few_blocks_are_unpacked():
    """With a high bar, lists of common terms are not read whole."""
    r = np.random.default_rng(5)
    found = [np.concatenate([np.zeros(1, np.int64), r.integers(1, 6, 5), np.full(3 * (i < 40), 6)]) for i in range(20_000)]
    names = {f"t{i}".encode(): i for i in range(7)}
    counts = [len(f) for f in found]
    import pyarrow as pa

    rows = list(ranked_search.shard_rows("s", list(range(20_000)), counts, names, found))
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(("shard", "term", "df", "n_terms", "heads", "fronts", "packed"))})
    shard = ranked_search.Shard(table, 20_000, sum(counts))
    read, blocks = ranked_search.Postings.read, []
    ranked_search.Postings.read = lambda self, b: (blocks.append(len(b)), read(self, b))[1]
    try:
        docs, scores = shard.search([(b"t0", 1), (b"t1", 2), (b"t6", 5000)], 20, 1)
    finally:
        ranked_search.Postings.read = read
    assert len(docs) == 20 and set(docs.tolist()) <= set(range(40))
    assert sum(blocks) <= 5 and sum(len(p.n) for p in shard.lists.values()) > 1000


def test_registered_query(spark):
    got = queries()["op11_block_max"](spark, SF_SMALL).collect()
    read = lambda t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
    rows = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    assert sorted(map(tuple, got), key=str) == ranking(rows, items)
