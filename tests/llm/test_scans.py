"""The scanning operators against the library, plain Python or held-out data."""

import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import bpe, langid, oracle, pitman_yor, queries, rule_ledger, secret_scan, spaced_seed

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " \n\t", "x", "ÀÉ Σς İ ﬁ 漢字 😀", "<|endoftext|> it's <|ENDOFTEXT|>", "ab " * 30000, "q" * 3000, "same text", "same text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_equals_the_library(spark, docs):
    r = random.Random(5)
    pool = "abzéÉßΣσςİıñÑ\u00a0\u2003\x1c\x1f\x85\u3000'sStTlL!?.,09٣四漢ひ😀가\t\n ﬁ\x00_-"
    texts = ODD + ["".join(r.choice(pool) for _ in range(r.randrange(40))) for _ in range(400)]
    own = Tokenizer.from_file(WORDS)
    own.no_truncation()
    own.no_padding()
    rows = list(enumerate(texts)) + [(None, "no id")]
    got = bpe.digests(docs(rows), WORDS).collect()
    want = {}
    for d, t in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(ids), sha(" ".join(map(str, ids))), sha(own.decode(ids, skip_special_tokens=False)))
    assert {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in got} == want
    encoded = bpe.encode(docs(rows[:40]), WORDS)
    assert {x.doc_id: sha(x.decoded) for x in bpe.decode(encoded, WORDS).collect()} == {d: want[d][2] for d, _ in rows[:40]}
    assert bpe.digests(docs([]), WORDS).collect() == []


def test_pair_test_agrees_with_exact_merging():
    b = bpe.load(WORDS)
    r = random.Random(2)
    for _ in range(1500):
        word = "".join(r.choice("aeinorstthe") for _ in range(r.randrange(1, 14))) + b.suffix
        ids = b.proposed(word)
        pairs = np.array(ids)
        exact = b.merged(b.symbols(word))
        assert bool(b.compatible(pairs[:-1], pairs[1:]).all()) == (ids == exact)


def test_secrets(spark, docs):
    key = "AKIA" + "A1B2C3D4E5F6"
    random_run = "zX9qK7vLw2RtY8mPbN4sD6fG"
    texts = [
        'Password: "hunter2secret" token=short api_key = abcdefgh', f"id {key}Z end", "0123456789abcdef" * 2, f"see {random_run} here",
        "da39a3ee5e6b4b0d3255bfef95601890afd80709", "deadbeef-0000-1111-2222-333344445555", *ODD,
    ]
    got = {x.doc_id: x for x in secret_scan.scan_secrets(docs(list(enumerate(texts))), RANKS, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(texts)
    assert (got[0].n_assign, got[1].n_access, got[2].n_hex, got[4].n_hex, got[5].n_random) == (2, 1, 1, 1, 0)
    assert got[3].spans == f"random:4:{4 + len(random_run)}" and got[3].base_sha256 == sha("")
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    for k, t in enumerate(texts):
        spans = [("assign", *m.span()) for m in assign.finditer(t or "") if len(m[2]) >= 8]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t or "") if len(m[0]) >= 16]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t or "") if len(m[0]) >= 32]
        spans.sort(key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))
        assert got[k].base_sha256 == sha(",".join(f"{a}:{b}:{c}" for a, b, c in spans))


def test_stirling_numbers_count_seatings():
    """S_d by summing the weights of all seatings of five customers."""

    def seatings(n):
        if not n:
            return [()]
        out = []
        for s in seatings(n - 1):
            out += [s[:i] + (s[i] + 1,) + s[i + 1 :] for i in range(len(s))] + [s + (1,)]
        return out

    d, table = 0.5, pitman_yor.log_stirling(0.5)
    for t in range(1, 6):
        want = sum(np.prod([np.prod([k - d for k in range(1, m)]) for m in s]) for s in seatings(5) if len(s) == t)
        assert np.isclose(np.exp(table[5, t]), want)


def test_seating_draws_follow_their_conditional():
    n = 20000
    u = (np.arange(n) + 0.5) / n
    t = pitman_yor.seat(np.full(n, 6), np.full(n, 2.0), 0.5, u, np.zeros(n))
    logits = np.arange(1, 7) * np.log(2.0) + pitman_yor.log_stirling(0.5)[6, 1:7]
    p = np.exp(logits) / np.exp(logits).sum()
    assert np.allclose(np.bincount(t.astype(int), minlength=7)[1:] / n, p, atol=1e-3)
    big = pitman_yor.seat(np.array([10**7]), np.array([3.0]), 0.5, np.array([0.5]), np.zeros(1))
    assert 1 <= big[0] <= 10**7


def test_scores(spark):
    import zlib

    got = {x.doc_id: x for x in queries.op3_pitman_yor(spark, SF_SMALL).collect()}
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    tokens = {d: [*(t or "").encode().lower().split(), b""] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    c: dict = {}
    for d, ts in tokens.items():
        for t in ts if not held[d] else ():
            c[t] = c.get(t, 0) + 1
    total, types = sum(c.values()), len(c)
    for d, ts in tokens.items():
        base = sum(np.log10((c.get(t, 0) + 0.5) / (total + 0.5 * (types + 1))) for t in ts)
        x = got[d]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[d], len(ts), sum(t in c for t in ts), total)
        assert np.isclose(x.base_score, base) and x.score < 0
    n = sum(x.n_tokens for x in got.values() if x.held_out)
    assert sum(x.score for x in got.values() if x.held_out) / n > sum(x.base_score for x in got.values() if x.held_out) / n


def test_scores_of_odd_rows(spark, docs):
    from pyspark.sql import functions as F

    frame = docs([*enumerate(ODD), (None, "null id"), (3, "again")]).withColumn("held", F.lit(False))
    got = {x.doc_id: x for x in pitman_yor.score(frame, "held").collect()}
    assert got[0].n_tokens == 1 and got[None].n_tokens == 3 and got[3].n_tokens == 2 + 2 and got[6].n_tokens == 30001
    assert pitman_yor.score(frame.where("doc_id < 0"), "held").collect() == []
    untrained = pitman_yor.score(frame.withColumn("held", F.lit(True)), "held").collect()
    assert all(x.score == 0 and x.open_score < 0 and x.n_known == 0 for x in untrained)


def test_language(spark, docs):
    got = queries.op6_langid(spark, SF_SMALL).toPandas().merge(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id"
    )
    held = got[got.held_out]
    assert len(held) > 30 and (held.lang == held.lang_pred).mean() > 0.93
    model = langid.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    odd = {x.doc_id: x for x in langid.predict(docs([*enumerate(ODD), (90, "123 ... 456"), (91, "漢" * 50)]), model).collect()}
    assert all(odd[k].lang_pred == "und" and odd[k].score == 0 and odd[k].rejected for k in (0, 1, 2, 90))
    assert odd[91].rejected and odd[91].lang_pred in model.langs and not got[got.lang_pred != "und"].rejected.any()
    none = langid.fit(docs([]).selectExpr("*", "'en' AS lang"))
    assert [x.lang_pred for x in langid.predict(docs([(1, "a text")]), none).collect()] == ["und"]


def test_term_counts_of_long_texts_in_pieces():
    whole = langid.term_counts("añ b " * 400_000)
    assert whole.sum() > 2**20 and (whole == langid.term_counts("añ b " * 400_000)).all()
    small = langid.term_counts("añ b " * 4)
    assert set(np.flatnonzero(small)) == set(np.flatnonzero(whole))


def test_ledger(spark, docs):
    texts = [*ODD, "a b c a b c", "l one\nl one\n\n\nl one", "#$ <x> | y", "é" * 10]
    got = {x.doc_id: x for x in rule_ledger.measure(docs(list(enumerate(texts)))).collect()}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) < 1000 else None
        assert (got[k].n_words, got[k].word_chars) == (len(w), sum(map(len, w)))
        assert got[k].n_symbols == len(re.findall(r"[#*$%&|<>]", t or ""))
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got[k].n_dup_lines == len(lines) - len(set(lines))
        if grams is not None:
            inside = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
            assert got[k].n_repeat_words == len(inside)
    book = rule_ledger.ledger(rule_ledger.measure(docs(list(enumerate(texts)))))
    policy = rule_ledger.POLICIES[2]
    rows = rule_ledger.apply_policy(book, policy).collect()
    ablation = {x.rule: (x.n_fail, x.n_only) for x in rule_ledger.ablation(book, policy).collect()}
    for rule in rule_ledger.RULES:
        bit = 1 << rule.bit
        assert ablation[rule.name] == (sum(bool(x.fail_bits & bit) for x in rows), sum(x.fail_bits & policy.mask == bit for x in rows))
    assert rule_ledger.measure(docs([])).collect() == []


def test_longest_overlap():
    r = np.random.default_rng(0)
    for _ in range(800):
        same = r.random(int(r.integers(1, 22))) < r.choice([0.3, 0.6, 0.9])
        best = (0, 0)
        for i in range(len(same)):
            for j in range(i + 1, len(same) + 1):
                if same[i] and same[j - 1] and 10 * (~same[i:j]).sum() <= 3 * (j - i) and j - i > best[1] - best[0]:
                    best = (i, j)
        assert spaced_seed.longest_overlap(same, (3, 10)) == best


def test_benchmark_overlaps(spark, docs):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    items = [[word() for _ in range(n)] for n in (40, 20, 14, 9, 5, 3)]
    fill = lambda n: [word() for _ in range(n)]
    edited = [w if k % 6 != 3 else word() for k, w in enumerate(items[0])]
    texts = [fill(50) + items[0] + fill(50), fill(9) + edited + fill(3), items[1][:16], items[1][:8] + fill(40), items[3], items[5] + fill(20),
             [w.upper() + "!!" for w in items[2]], fill(300), items[4] + items[0]]
    bench = spark.createDataFrame([*((k, " ".join(t), "x") for k, t in enumerate(items)), (90, None, "x"), (91, "", "x")], "item_id long, text string, doc_id string")
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(50, None), (51, ""), (None, " ".join(items[0]))]
    for block in (10**6, 120):
        found = {(x.doc_id, x.item_id) for x in spaced_seed.find_overlaps(docs(rows), bench, block_chars=block).collect()}
        assert found == {(0, 0), (1, 0), (2, 1), (4, 3), (6, 2), (8, 4), (8, 0), (None, 0)}
    left = spaced_seed.decontaminate(docs(rows), bench)
    assert sorted((x.doc_id for x in left.collect()), key=str) == sorted([3, 5, 7, 50, 51, None], key=str) and "label" in left.columns
    assert spaced_seed.find_overlaps(docs(rows), bench.limit(0)).collect() == []
    assert spaced_seed.find_overlaps(docs([]), bench).collect() == []


TWINS = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.queries()[name](spark, SF_SMALL)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({TWINS[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in df.select(*columns).collect())
