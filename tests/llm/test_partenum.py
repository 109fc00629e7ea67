"""Similarity groups against brute force over all pairs."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest

from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import partenum
from stratum.llm.common import by_ids, words_of


def grams(text, n):
    w = words_of(text)
    m = min(n, len(w))
    return {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set()


def brute(rows, n, num, den):
    ids = sorted({d for d, _ in rows if d is not None})
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(d, grams(t, n)) for d, t in rows if d is not None]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and den * len(s & t) >= num * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def family(seed, count, words, edits):
    """Copies of one text with up to ``edits`` words replaced."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(count):
        own = list(base)
        for _ in range(r.randrange(edits + 1)):
            own[r.randrange(words)] = f"w{r.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_groups_equal_brute_force(spark, docs, n, num, den):
    texts = ["", None, " \n ", "one", "ONE", "one two", "a b c", "a b c d", "a b c d"]
    for seed, (count, words, edits) in enumerate([(60, 120, 9), (40, 300, 14), (30, 25, 2), (20, 9, 1), (8, 2000, 60)]):
        texts += family(seed, count, words, edits)
    random.Random(7).shuffle(texts)
    rows = list(enumerate(texts, 100))
    got = partenum.similar_groups(docs(rows), n, num, den).collect()
    want = brute(rows, n, num, den)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(grams(t, n)) for d, t in rows}


def test_signatures_meet_at_the_bound():
    r = np.random.default_rng(3)
    for num, den in ((90, 100), (80, 100)):
        signatures = partenum.Signatures(num, den)
        for _ in range(1500):
            a = np.unique(r.integers(0, 2**64, int(r.integers(2, 400)), dtype=np.uint64))
            k = int(r.integers(0, len(a) * (den - num) // num + 2))
            gone = int(r.integers(0, k + 1))
            b = np.unique(np.concatenate([r.permutation(a)[gone:], r.integers(0, 2**64, k - gone, dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if shared < len(a) + len(b) - shared and den * shared >= num * (len(a) + len(b) - shared):
                assert set(signatures.of(a).tolist()) & set(signatures.of(b).tolist())


def test_nulls_repeats_and_empty_table(spark, docs):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, long), (1, long), (None, long), (5, long + " more"), (None, None), (7, None), (None, "alone here")]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in partenum.similar_groups(docs(rows), 3, 90, 100).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 78, 1), (1, 78, 1), (None, 78, 1), (5, 79, 1), (None, 0, None), (7, 0, 7), (None, 1, None)], key=str
    )
    assert partenum.similar_groups(docs([]), 3, 90, 100).collect() == []


def test_one_of_each_keeps_columns_and_null_ids(spark, docs):
    long = " ".join(f"w{i}" for i in range(80))
    kept = partenum.one_of_each(docs([(3, long), (2, long), (None, long), (9, "other text")]))
    assert kept.columns[:2] == ["doc_id", "text"] and "label" in kept.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 9, None]


def union_find(pairs):
    root = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


def files_under(path):
    return sum(len(names) for _, _, names in os.walk(path.removeprefix("file:")))


def test_components_write_few_files_for_few_links(spark, monkeypatch):
    """A file is three processes that an executor starts; few links need no partition for each of a shuffle."""
    r = random.Random(11)
    chain = list(range(0, 60))
    r.shuffle(chain)
    graphs = [
        [], [(5, 5)], [(1, 2), (1, 3), (7, 9)], [(2, 1), (1, 2), (3, 3)], list(zip(chain, chain[1:])),
        [(r.randrange(400), r.randrange(400)) for _ in range(330)], [(-(1 << 63), (1 << 63) - 1), (0, (1 << 63) - 1)],
    ]
    own = spark.sparkContext.getCheckpointDir()
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for k, pairs in enumerate(graphs):
            links = spark.createDataFrame(pairs, "a long, b long")
            before = files_under(own)
            got = partenum.components(links)
            assert {x.node: x.label for x in got.collect()} == union_find(pairs), k
            assert got.count() == len(union_find(pairs)), k  # a row a node
            assert files_under(own) - before < 40, k
        # several partitions, as many as the links fill
        monkeypatch.setattr(partenum, "PART_ROWS", 100)
        got = partenum.components(spark.createDataFrame(graphs[5], "a long, b long"))
        assert {x.node: x.label for x in got.collect()} == union_find(graphs[5])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_stored_ids_write_nothing(spark, docs):
    frame = docs([(k, "x") for k in (1, 2, 2, 3, None)])
    ids = spark.createDataFrame([(2,), (2,), (None,), (9,)], "k long")
    before = files_under(spark.sparkContext.getCheckpointDir())
    for how, want in (("left_semi", [2, 2]), ("left_anti", [1, 3, None])):
        got = by_ids(frame, ids, "doc_id", how, stored=True)
        assert sorted((x.doc_id for x in got.collect()), key=str) == want
        assert got.columns == frame.columns
    assert files_under(spark.sparkContext.getCheckpointDir()) == before


def test_signatures_travel_in_a_few_bytes_each(spark, docs, monkeypatch):
    """What is in shuffle files while signatures meet, also where each task has few for a partition."""
    r = random.Random(5)
    rows = [(k, " ".join(f"w{r.randrange(10**6)}" for _ in range(100))) for k in range(5000)]
    rows += [(10000 + k, rows[k][1]) for k in range(5)]
    signatures = partenum.Signatures(80, 100)
    count = sum(len(signatures.of(next(partenum.each_set([batch_of(t)], 5))[1])) for _, t in rows)
    frame = docs(rows, extra=False).coalesce(2).checkpoint()

    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()))

    grown, release = [], partenum.release_shuffles
    release(spark)
    before = held()
    monkeypatch.setattr(partenum, "release_shuffles", lambda s: (grown.append(held() - before), release(s)))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        got = {x.doc_id: x.component_id for x in partenum.similar_groups(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == {k: k % 10000 for k, _ in rows}
    assert grown[0] < 14 * count, grown[0] / count


def batch_of(text):
    return pa.RecordBatch.from_pydict({"id": [0], "text": [text]})


def test_common_signatures_over_many_batches_and_cells(spark, docs, monkeypatch):
    """Copies and near copies that fill batch after batch: groups don't hang on how rows are dealt out."""
    near = family(3, 90, 60, 4)
    texts = near + near[:40] + [near[0]] * 60 + family(8, 20, 400, 30) + family(9, 30, 8, 1) + ["a b", "", None]
    random.Random(2).shuffle(texts)
    rows = [(k, t) for k, t in enumerate(texts, -20)]
    want = brute(rows, 5, 80, 100)
    frame = docs(rows, extra=False).repartition(3)
    for batch, cell in ((400, 300), (10**6, 10**6), (1, 10**6)):
        monkeypatch.setattr(partenum, "BATCH_ROWS", batch)
        monkeypatch.setattr(partenum, "CELL_GRAMS", cell)
        assert {x.doc_id: x.component_id for x in partenum.similar_groups(frame).collect()} == want


def test_lists_of_marks_and_keys_come_back():
    r = np.random.default_rng(1)
    top = np.uint64((1 << partenum.KEY_BITS) - 1)
    for size in (0, 1, 2, 900):
        marks, keys = r.integers(0, 2**64, size, dtype=np.uint64) & top, r.integers(0, 2**64, size, dtype=np.uint64) & top
        marks[size // 2 :] = marks[: size - size // 2]
        if size > 1:
            marks[:2], keys[:2] = (0, top), (top, 0)
        order = np.lexsort((keys, marks))
        got = partenum.unlisted([partenum.listed(marks[order], keys[order])] * bool(size))
        assert got[0].tolist() == marks[order].tolist() and got[1].tolist() == keys[order].tolist()
        for cells in (1, 7, 1000):
            low = partenum.low_ends(cells)
            assert low[0] == 0 and len(low) == cells and (np.diff(low) > 0).all() and low[-1] <= top
