"""The pipeline against a brute-force version of its stages."""

import corpus_pipeline
from conftest import SF_SMALL
from frames import workers  # noqa: F401 - fixtures
from stratum.llm import langid, queries, spaced_seed
from test_native import brute_lines
from test_partenum import brute


def test_stages_equal_brute_force(spark):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.fit(documents.where(~langid.held_out("doc_id", 3)))
    rejected = {x.doc_id for x in langid.predict(documents, model).where("rejected").collect()}
    rows = [(x.doc_id, x.text) for x in documents.collect() if x.doc_id not in rejected]
    assert len(rows) > 190
    rows = [(d, t) for d, t, _, _ in brute_lines(rows)]
    first = brute(rows, 5, 80, 100)
    rows = [(d, t) for d, t in rows if first[d] == d]
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    whole = [(i, spaced_seed.words_of(t)) for i, t in items]
    # every item that lies whole in a text must take the text out
    inside = {d for d, t in rows if any(b" ".join(w) in b" ".join(spaced_seed.words_of(t)) for _, w in whole)}
    found = spaced_seed.overlaps(rows, spaced_seed.WordHashes(), spaced_seed.seeds_of(items), 13, (3, 10))
    gone = {x[0] for x in found}
    assert inside and inside <= gone and len(gone) <= len(inside) + 3
    got = {x.doc_id: x.n_tokens for x in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == {d for d, _ in rows} - gone


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("*", "'x' AS drops", "1 AS id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "drops", "id"], name
        empty = stage(spark, docs.where("false"), SF_SMALL)
        assert empty.columns == docs.columns and empty.count() == 0
    assert set(corpus_pipeline.run(spark, SF_SMALL).columns) >= {"doc_id", "n_tokens"}
    assert "op1_bpe" in queries.queries()
