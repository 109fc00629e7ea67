"""Word contexts and exact draws of the Pitman-Yor scores."""

import numpy as np

from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import pitman_yor


def test_draws_follow_their_conditional_at_every_count():
    n = 2000
    u = (np.arange(n) + 0.5) / n
    for c, a in ((400, 0.01), (400, 3.0), (700, 90.0), (300, 1e9)):
        t = pitman_yor.seat(np.full(n, c), np.full(n, a), 0.5, u)
        logits = np.arange(1, c + 1) * np.log(a) + pitman_yor.log_stirling(0.5, c)[c, 1:]
        p = np.exp(logits - logits.max())
        assert np.allclose(np.bincount(t.astype(int), minlength=c + 1)[1:] / n, p / p.sum(), atol=1.1e-3), (c, a)
    assert (pitman_yor.seat(np.full(3, 10**8), np.array([1e-200, 5.0, 1e6]), 0.5, np.full(3, 0.5)) >= 1).all()


def test_known_words_are_scored_by_the_word_before(spark, docs):
    """The same known words, in an order that training has and in one it hasn't."""
    from pyspark.sql import functions as F

    rows = [(i, "red fox blue sky") for i in range(40)] + [(100, "red fox blue sky"), (101, "red sky blue fox"), (102, "red fox new word")]
    frame = docs(rows).withColumn("held", F.col("doc_id") >= 100)
    got = {x.doc_id: x for x in pitman_yor.score(frame, "held").collect()}
    assert np.isclose(got[100].base_score, got[101].base_score)
    assert got[100].score > got[101].score + 2
    assert got[102].n_known == 3 and got[102].open_score < got[102].score


def test_scores_equal_the_probabilities_of_a_plain_model(spark, docs):
    """Every pair once: each has one table, so contexts follow from counts alone."""
    from pyspark.sql import functions as F

    frame = docs([(0, "a b"), (1, "c d"), (2, "a d"), (3, "x b")]).withColumn("held", F.col("doc_id") >= 2)
    words = pitman_yor.named(pitman_yor.vocabulary(frame, "text", "held")).checkpoint()
    pairs = pitman_yor.pair_counts(frame, "text", "held").where("c > 0")
    assert pairs.agg(F.max("c")).first()[0] == 1
    names = {x.w: x.word for x in words.collect()}
    kept = [{names[x.w]: x.p for x in part[0].collect()} for part in pitman_yor.train(words, pairs)]
    got = {x.doc_id: x.score for x in pitman_yor.score(frame, "held").collect()}
    seen = {("", "a"), ("a", "b"), ("b", ""), ("", "c"), ("c", "d"), ("d", "")}
    d, theta = pitman_yor.PAIR_D, pitman_yor.PAIR_THETA
    for doc, text in ((0, "a b"), (2, "a d"), (3, "x b")):
        want, last = 0.0, ""
        for word in (*text.split(), ""):
            n = sum(u == last for u, _ in seen)
            p = [(((last, word) in seen) * (1 - d) + (theta + d * n) * k[word]) / (theta + n) for k in kept]
            want += np.log10(np.mean(p))
            last = word
        assert np.isclose(got[doc], want), doc


def test_tokens_travel_in_a_few_bytes_each(spark, docs):
    """What the steps leave in shuffle files: no row for every token, no pair of hashes either."""
    from pyspark.sql import functions as F

    from stratum.llm.common import release_shuffles

    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()))

    rng = np.random.default_rng(3)
    words = [f"w{k:05d}" for k in range(20000)]
    rows = [(i, " ".join(words[k] for k in (rng.zipf(1.2, 1500) % 20000))) for i in range(400)]
    frame = docs(rows, extra=False).repartition(2).withColumn("held", F.col("doc_id") % 5 == 1).checkpoint()
    release_shuffles(spark)
    before = held()
    got = pitman_yor.score(frame, "held").collect()
    grown = held() - before
    assert len(got) == 400 and all(x.n_tokens == 1501 for x in got)
    assert grown < 12 * 400 * 1501, grown / (400 * 1501)


def test_scores_in_many_cells_are_the_scores_in_one(spark, docs, monkeypatch):
    """Scores don't hang on how tokens are dealt out; ids that are null or repeat are summed."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    rows = [(int(i) if i else None, " ".join(f"w{k}" for k in rng.zipf(1.4, 300) % 90)) for i in rng.integers(0, 25, 40)]
    frame = docs(rows, extra=False).withColumn("held", F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False)))

    def run():
        return {x.doc_id: x for x in pitman_yor.score(frame, "held").collect()}

    whole = run()
    monkeypatch.setattr(pitman_yor, "CELL_BYTES", 5000)  # of the driver alone
    frame = frame.repartition(7)
    parts = run()
    assert whole.keys() == parts.keys() and None in whole
    for k, x in whole.items():
        y = parts[k]
        assert x[1:4] == y[1:4] and np.allclose(x[4:], y[4:]), k


def test_rows_and_batches_stay_small_in_a_large_cell(spark, docs, monkeypatch):
    """An executor's memory: a cell's texts are stored in pieces, in small row groups, and
    batches to Python are small; other cells and
    pieces only round otherwise, which turns a draw here and there."""
    from pyspark.sql import functions as F

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    paths, limits, own = [], [], spark.conf.get(name)
    scratch, sample = pitman_yor.scratch, pitman_yor.sample
    monkeypatch.setattr(pitman_yor, "scratch", lambda *x: paths.append(scratch(*x)) or paths[-1])
    monkeypatch.setattr(pitman_yor, "sample", lambda *x: limits.append(int(spark.conf.get(name).removesuffix("b"))) or sample(*x))
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.2, 1500) % 20000)) for i in range(400)]
    frame = docs(rows, extra=False).repartition(2).withColumn("held", F.col("doc_id") % 5 == 1).checkpoint()

    def run():
        return {x.doc_id: x for x in pitman_yor.score(frame, "held").collect()}

    whole = run()
    largest = spark.read.parquet(paths[0]).where("kind > 0").agg(F.max(F.octet_length("body"))).first()[0]
    assert largest < 3 * pitman_yor.SLICE, largest
    assert limits[0] <= 4 << 20 and spark.conf.get(name) == own
    monkeypatch.setattr(pitman_yor, "CELL_BYTES", 300_000)  # of the driver alone
    parts = run()
    assert whole.keys() == parts.keys() and len(whole) == 400
    for k, x in whole.items():
        y = parts[k]
        assert x.n_tokens == 1501 and x[1:4] == y[1:4] and np.allclose(x[4:], y[4:], rtol=1e-3), k
