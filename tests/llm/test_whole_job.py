"""Cases that the operators once left out: rejection, replaced words, very many words,
rows that share an id or have none."""

import base64
import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_CHECK
from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import bpe, langid, secret_scan, spaced_seed

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_unknown_languages_and_gibberish_are_rejected(spark, docs):
    documents = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    training = documents.where(~langid.held_out("doc_id", 3))
    r, letters = random.Random(0), "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(r.choice(letters) for _ in range(r.randrange(2, 11)))
    junk = [" ".join(word() for _ in range(60)) for _ in range(50)]
    junk += [base64.b64encode(r.randbytes(300)).decode() for _ in range(50)]
    junk += ["".join(r.choice(letters) for _ in range(400)) for _ in range(50)]
    model = langid.fit(training)
    share = lambda df, m: langid.predict(df, m).agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    assert share(docs(list(enumerate(junk))), model) > 0.95
    assert share(documents, model) < 0.005
    for lang in ("de", "es", "fr"):
        others = langid.fit(training.where(F.col("lang") != lang))
        assert share(documents.where(F.col("lang") == lang), others) > 0.95, lang


@pytest.mark.parametrize("masks,shortest", [(spaced_seed.MASKS, 13), (spaced_seed.SHORT_MASKS, 4)])
def test_no_three_tenths_of_replaced_words_escape_the_masks(masks, shortest):
    assert all(spaced_seed.least_escape(masks, n) > 3 * n // 10 for n in [*range(shortest, 61), 100, 200, 400])


@pytest.mark.parametrize("n", [4, 6, 10, 12, 13, 15, 17, 20, 40])
def test_every_accepted_overlap_is_found(n):
    r = np.random.default_rng(n)
    item = [f"w{k}" for k in range(n)]
    seeds = spaced_seed.seeds_of([(7, " ".join(item))])
    texts = []
    for k in range(400):
        gone = set((1 + r.permutation(n - 2)[: 3 * n // 10]).tolist())
        texts.append((k, " ".join(["before"] * 9 + [f"x{k}" if j in gone else w for j, w in enumerate(item)] + ["after"])))
    found = spaced_seed.overlaps(texts, spaced_seed.WordHashes(), seeds, 13, (3, 10))
    assert {x[0] for x in found} == set(range(400)) and all(x[2] == n for x in found)


def test_texts_of_very_many_distinct_words(spark, docs):
    own = Tokenizer.from_file(WORDS)
    own.no_truncation()
    own.no_padding()
    text = " ".join(np.base_repr(k + 50_000, 26).translate(str.maketrans("0123456789", "qrstuvwxyz")).lower() for k in range(450_000))
    assert len(set(text.split())) == 450_000
    ids = own.encode(text, add_special_tokens=False).ids
    b = bpe.Bpe(WORDS)
    n, spelled, decoded = b.encode_batch([text])[0]
    assert n == len(ids) and spelled == " ".join(map(str, ids))
    assert decoded == " ".join(map(b.text_of.__getitem__, ids))


def test_new_words_beside_many_remembered_ones(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_LIMIT", 400)
    b, plain = bpe.Bpe(WORDS), bpe.Bpe(WORDS)
    name = lambda k: "w" + chr(97 + k // 26 % 26) + chr(97 + k % 26)
    for a in (0, 150):
        b.encode_batch([" ".join(map(name, range(a, a + 150)))])
    assert len(b.known) == 300
    text = " ".join(map(name, range(450)))
    got = b.encode_batch([text, name(3)])
    monkeypatch.setattr(bpe, "WORD_LIMIT", 400_000)
    assert got == plain.encode_batch([text, name(3)]) and len(b.known) <= 400


def test_rows_that_share_an_id_or_have_none_are_judged_by_their_own_text(spark, tmp_path):
    """Copies of one id, null ids, and a clean text under a rejected text's id."""
    table = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    bench = spark.read.parquet(f"{SF_CHECK}/benchmark.parquet")
    item = next(x.text for x in bench.orderBy("item_id").collect() if len(spaced_seed.words_of(x.text)) >= 13)
    clean = [x.text for x in table.where("lang = 'en' AND length(text) > 1500").orderBy("doc_id").limit(3).collect()]
    sample = [(9000 + k, x.text, x.lang) for k, x in enumerate(table.orderBy("doc_id").limit(300).collect())]
    frame = lambda rows: spark.createDataFrame([(d, t, g, "s", len(t or "")) for d, t, g in rows], table.schema)
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: sorted(((x.doc_id, x.text) for x in df.where("doc_id IS NULL OR doc_id < 9000").collect()), key=str)

    got = stages["language"](spark, frame([*sample, (1, "12 34", "en"), (1, clean[0], "en"), (None, "...", "en"), (None, clean[1], "en")]), "")
    assert texts(got) == sorted([(1, clean[0]), (None, clean[1])], key=str)

    rows = [(5, clean[0], "en"), (5, clean[0], "en"), (None, clean[0], "en"), (None, clean[1], "en"), (None, clean[1], "en"),
            (6, clean[1] + " one", "en"), (6, clean[2], "en"), (4, clean[2] + " two", "en"), (7, None, "en"), (7, "", "en")]
    got = stages["near_dup"](spark, frame(rows), "")
    assert texts(got) == sorted([(5, clean[0]), (6, clean[1] + " one"), (4, clean[2] + " two"), (7, None), (7, "")], key=str)

    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    dirty = "before this " + item + " and after"
    plain = "nothing of a benchmark is in this short text"
    got = stages["decontaminate"](spark, frame([(1, dirty, "en"), (1, plain, "en"), (None, dirty, "en"), (None, plain, "en"), (2, None, "en")]), str(tmp_path))
    assert texts(got) == sorted([(1, plain), (None, plain), (2, None)], key=str)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
def test_random_letters_of_one_case_are_found(spark, docs, letters):
    r = random.Random(1)
    keys = ["".join(r.choice(letters) for _ in range(40)) for _ in range(100)]
    words = ["internationalization", "Donaudampfschifffahrtsgesellschaft", "otorrinolaringologo", "UNCONSTITUTIONALITY", "anticonstitutionnellement"]
    texts = [f"see {x} here" for x in [*keys, *words]]
    got = secret_scan.scan_secrets(docs(list(enumerate(texts))), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert {x.doc_id for x in got.collect() if x.n_random} == set(range(100))
