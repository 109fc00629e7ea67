"""The operators of DataFrame operations only."""

import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import license_digest, line_runs, queries, url_rules


def brute_lines(rows, min_chars=40, min_docs=5):
    ends = " \t\n\r\x0b\x0c"
    lower = {ord(a): b for a, b in zip(line_runs.UPPER, line_runs.LOWER)}
    holds: dict = {}
    for d, t in rows:
        for key in {x.strip(ends).translate(lower) for x in (t or "").split("\n")}:
            if len(key) >= min_chars:
                holds.setdefault(key, []).append(d)
    last = {k: max((d for d in v if d is not None), default=None) for k, v in holds.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if (k := x.strip(ends).translate(lower)) not in last or (d is not None and last[k] == d)]
        out.append((d, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 3), (7, 2)])
def test_lines_equal_brute_force(spark, docs, batches, fanout):
    r = random.Random(4)
    long = [f"{'Line ÄÉ' if k % 3 else 'Line'} {k} " + "x" * 45 for k in range(12)]
    pick = lambda: r.choice(long + ["short", "", "  " + long[0].upper() + "\t", long[1] + "\r", "Ünique " * 9 + str(r.random())])
    rows = [(k * 3, "\n".join(pick() for _ in range(r.randrange(9)))) for k in range(60)]
    rows += [(None, long[0]), (None, None), (700, ""), (701, None), (702, "\n\n"), (9, long[2] + "\n" + long[2]), (9, long[2])]
    got = line_runs.drop_repeated(docs(rows), batches=batches, fanout=fanout).collect()
    assert sorted([tuple(x) for x in got], key=str) == brute_lines(rows)


def test_runs_are_levelled_and_compacted(spark, docs):
    runs = line_runs.LineRuns(spark, fanout=2, min_chars=3)
    for k in range(5, 0, -1):
        runs.ingest(docs([(k, f"shared line\nown {k} line")]).selectExpr("doc_id AS id", "text"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
    assert sorted((x.n_docs, x.keeper) for x in runs.counts().collect()) == [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (5, 5)], runs.paths()


def test_a_store_is_reopened_and_survives_crashes(spark, docs, tmp_root, monkeypatch):
    batch = lambda k: docs([(k, f"shared line\nown {k} line")]).selectExpr("doc_id AS id", "text")
    state = lambda: sorted((x.n_docs, x.keeper) for x in line_runs.LineRuns(spark, tmp_root + "/s", 2, 3).counts().collect())
    for k in (9, 8, 7):
        line_runs.LineRuns(spark, tmp_root + "/s", 2, 3).ingest(batch(k))
    assert state() == [(1, 7), (1, 8), (1, 9), (3, 9)]
    # a run that was begun and never finished counts for nothing, and its number isn't used again
    store = line_runs.LineRuns(spark, tmp_root + "/s", 2, 3)
    left = f"{tmp_root}/s/level=0/run={store._next()}"
    spark.createDataFrame([(1, 1, 9, 9)], line_runs.RUN).write.parquet(left)
    line_runs.delete_path(spark, left + "/_SUCCESS")
    assert state() == [(1, 7), (1, 8), (1, 9), (3, 9)]
    # killed after the merged run is whole, before those it replaces are deleted
    monkeypatch.setattr(line_runs, "delete_path", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        store.ingest(batch(6))
    monkeypatch.undo()
    assert state() == [(1, 6), (1, 7), (1, 8), (1, 9), (4, 9)]
    line_runs.LineRuns(spark, tmp_root + "/s", 2, 3).ingest(batch(5))
    assert state() == [(1, 5), (1, 6), (1, 7), (1, 8), (1, 9), (5, 9)]


def test_runs_meet_a_batch_without_an_exchange(spark, docs):
    from test_plans import plan

    store = line_runs.LineRuns(spark, fanout=3, min_chars=3, buckets=8)
    for k in (3, 2):
        store.ingest(docs([(k, f"shared line\nown {k} line")]).selectExpr("doc_id AS id", "text"))
    keys = spark.range(1000).selectExpr("id AS h1", "id AS h2").hint("merge")
    runs = [store.read(p) for p in store.paths()]
    p = plan(keys.join(runs[0].hint("merge").select("h1", "h2"), ["h1", "h2"], "left_anti").join(runs[1].hint("merge").select("h1", "h2"), ["h1", "h2"], "left_anti"), "simple")
    assert p.count("SortMergeJoin") == 2 and p.count("Exchange") == 1 and p.count("Bucketed: true") == 2
    store.forget(store.paths())


def test_lines_of_very_long_texts(spark, docs):
    long = "This line is in five documents, and longer than forty characters."
    rows = [(k, "\n".join([f"line number {k} {i}" for i in range(20_000)] + [long])) for k in range(5)]
    got = line_runs.drop_repeated(docs(rows)).collect()
    assert sorted([tuple(x) for x in got], key=str) == brute_lines(rows)


def test_lines_of_an_empty_table(spark, docs):
    assert line_runs.drop_repeated(docs([])).collect() == []


def test_licenses(spark, docs):
    texts = license_digest.known_texts()
    mit = texts["MIT"]
    changed = mit.upper().replace("YEAR HOLDER", "2031 Someone, Inc.").replace(",", " ;").replace("\n", "\r\n").replace("LICENSE", "LICENCE")
    notice = "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, mit), (2, changed), (3, mit + "\nbut more"), (4, f"text\n  {notice.upper()}\nReleased under the MIT Licence"), (5, None), (6, ""),
            (None, texts["ISC"]), (7, "plain"), (7, notice), (8, mit.split("\n", 1)[1]), (9, "word " * 200_000 + notice), (8, "x")]
    got = sorted(((x.doc_id, x.license, x.notices) for x in license_digest.scan_licenses(docs(rows)).collect()), key=str)
    assert got == sorted([(1, "MIT", None), (2, "MIT", None), (3, None, None), (4, None, "GPL-3.0,MIT"), (5, None, None), (6, None, None),
                          (None, "ISC", None), (7, None, None), (7, None, "GPL-3.0"), (8, "MIT", None), (9, None, "GPL-3.0"), (8, None, None)], key=str)
    assert license_digest.scan_licenses(docs([])).collect() == []


def test_whole_licence_texts(spark, docs):
    """Every known text is found, also rewrapped, retitled and with another holder."""
    texts = license_digest.known_texts()
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "MIT", "ISC"} <= set(texts)
    names = sorted(texts)
    # lines broken elsewhere in the second half, but never so that one begins like a copyright line
    wrap = lambda t: re.sub(r"(?i)(\w) (?!copyright|copr|c\b|all rights)(\w)", r"\1\n   \2", t, count=40)
    wrapped = [t[: len(t) // 2] + wrap(t[len(t) // 2 :]) for t in map(texts.get, names)]
    bsd = texts["BSD-3-Clause"].replace("the copyright holder nor", "Example University, Inc. nor").replace("year holder", "1999, 2003 Example University")
    rows = list(enumerate([texts[n] for n in names] + wrapped + [bsd]))
    got = {x.doc_id: x.license for x in license_digest.scan_licenses(docs(rows)).collect()}
    assert [got[k] for k in range(len(names))] == names and got[2 * len(names)] == "BSD-3-Clause"
    assert [got[len(names) + k] for k in range(len(names))] == names


def test_notices_anywhere_in_a_text(spark, docs):
    said = {
        "Licensed under the MIT License.": "MIT", "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "some text. Released under the MIT License. And more": "MIT",
        'Copyright 2020 X. Licensed under the Apache License, Version 2.0 (the "License"); you may not use': "Apache-2.0",
        "you can redistribute it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under CC BY 4.0.": "CC-BY-4.0", "under the BSD 3-Clause Licence": "BSD-3-Clause",
        "# SPDX-License-Identifier: MIT-0\n# SPDX-License-Identifier:GPL-2.0-only WITH x": "GPL-2.0-only,MIT-0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
        "understand the mit license": None, "thunder the MIT license": None, "the committee": None, "under the GNU Lesser General Public License version 3": "LGPL-3.0",
    }
    got = {x.doc_id: x.notices for x in license_digest.scan_licenses(docs(list(enumerate(said)))).collect()}
    assert got == dict(enumerate(said.values()))


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")


def test_given_rules(spark):
    urls = ["http://A.Example.com/en/1?x#y", "https://www.example.com/en/2", "https://m.www.example.com/en/2", "ftp://x.net/es/", "x://net/fr/a/b", "http://net/es",
            "http://example.com", None, "no scheme", "", "://", "http://other.org/en/1", "http://xexample.com/en/1", "http://com/", "http://a.com?/en/"]
    none = spark.createDataFrame([], "url string, block boolean")
    got = url_rules.judge(pages(spark, urls), url_rules.rule_table(spark, queries.URL_RULES), none).collect()
    want = {0: ("a.example.com", "/en/1", "example.com/en/", "block"), 1: ("www.example.com", "/en/2", "www.example.com/en/", "allow"),
            2: ("m.www.example.com", "/en/2", "www.example.com/en/", "allow"), 3: ("x.net", "/es/", "net/es/", "block"), 4: ("net", "/fr/a/b", "net/fr/", "block"),
            5: ("net", "/es", None, "allow"), 6: ("example.com", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
            10: ("", "", None, "allow"), 11: ("other.org", "/en/1", None, "allow"), 12: ("xexample.com", "/en/1", "com/", "allow"), 13: ("com", "/", "com/", "allow"),
            14: ("a.com", "", None, "allow")}
    assert {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in got} == want
    assert url_rules.judge(pages(spark, []), url_rules.rule_table(spark, queries.URL_RULES), none).collect() == []


def test_mined_rules(spark):
    """Casino pages under /play are bad, other combinations are not."""
    labelled = [(f"http://{h}.casino.org/play/{k}", True) for h in ("a", "b") for k in range(10)]
    labelled += [(f"http://{h}.casino.org/help/{k}", False) for h in ("a", "b") for k in range(10)]
    labelled += [(f"http://{h}.games.org/play/{k}", False) for h in ("a", "b") for k in range(10)]
    labels = spark.createDataFrame(labelled, "url string, block boolean")
    urls = ["http://z.casino.org/play/77", "http://z.casino.org/help/1", "http://z.games.org/play/2", "http://a.org/"] * 2
    got = url_rules.judge(pages(spark, urls), url_rules.rule_table(spark, queries.URL_RULES), labels).collect()
    assert {x.page_id: x.verdict for x in got} == {k: "block" if k % 4 == 0 else "allow" for k in range(8)}
    assert {x.mined for x in got if x.verdict == "block"} == {"host=casino path=play"}


def tokens_of(url):
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    words = [re.sub(r"\.[a-z0-9]+$", "", w.lower()) for w in path.split("/")]
    return {f"host={x}" for x in host.lower().split(".") if x} | {f"path={w}" for w in words if w and not re.fullmatch("[0-9]+", w)}


def brute_verdicts(labelled, urls, support, confidence):
    """Every combination of tokens of a labelled url, counted over all of them."""
    rows = [(tokens_of(u), b) for u, b in labelled]
    rules = []
    for combo in sorted({c for t, _ in rows for n in range(1, len(t) + 1) for c in map(frozenset, combinations(sorted(t), n))}, key=len):
        held = [b for t, b in rows if combo <= t]
        if sum(held) >= support * len(rows) and sum(held) >= confidence * len(held) and not any(r < combo for r in rules):
            rules.append(combo)
    return ["block" if any(r <= tokens_of(u) for r in rules) else "allow" for u in urls]


def test_mined_rules_equal_every_combination(spark):
    r = random.Random(6)
    for turn in range(3):
        host = lambda: f"{r.choice('ab')}.{r.choice(['casino', 'games', 'news'])}.{r.choice(['org', 'test'])}"
        url = lambda: f"http://{host()}/{'/'.join(r.choice(['play', 'win', 'help', 'x.html', '7']) for _ in range(r.randrange(4)))}"
        labelled = [(u, r.random() < (0.95 if "casino" in u and "play" in u else 0.3)) for u in (url() for _ in range(120))]
        urls = [url() for _ in range(80)]
        frame = spark.createDataFrame(labelled, "url string, block boolean")
        mined, known = url_rules.mine(
            frame.select(url_rules.tokens(url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url"))).alias("tokens"), "block"), 0.02, 0.8)
        found = [set(x[0]) for x in mined.select("items").collect()]
        item = {x.token: x.item for x in known.collect()}
        got = ["block" if any(f <= {item.get(t) for t in tokens_of(u)} for f in found) else "allow" for u in urls]
        assert got == brute_verdicts(labelled, urls, 0.02, 0.8) and found


def test_deep_directories_are_mined_as_one_item(spark):
    """25 shared levels would be 2^25 combinations."""
    deep = "/".join(f"level{k}" for k in range(25))
    labelled = [(f"http://bad.org/{deep}/{k}", True) for k in range(20)] + [(f"http://good.org/{k}", False) for k in range(20)]
    labels = spark.createDataFrame(labelled, "url string, block boolean")
    urls = [f"http://else.com/{deep}/9", "http://bad.org/other", "http://good.org/1", "http://else.com/a/level7/b"]
    got = url_rules.judge(pages(spark, urls), url_rules.rule_table(spark, queries.URL_RULES[3:]), labels).collect()
    assert {x.page_id: x.verdict for x in got} == {0: "block", 1: "block", 2: "allow", 3: "block"}
    assert len({x.mined for x in got if x.mined}) == 1


def test_rules_given_twice_repeated_ids_and_long_urls(spark):
    rules = url_rules.rule_table(spark, [("x.com", "/a", "allow"), ("x.com", "/a", "block"), ("x.com", "/", "allow")])
    none = spark.createDataFrame([], "url string, block boolean")
    long = "http://x.com/a" + "b/" * 100_000
    page = spark.createDataFrame([(1, "http://x.com/ab"), (1, "http://x.com/b"), (None, long), (1, "http://x.com/ab")], "page_id long, url string")
    got = sorted(((x.page_id, len(x.path), x.rule, x.verdict) for x in url_rules.judge(page, rules, none).collect()), key=str)
    assert got == sorted([(1, 3, "x.com/a", "block"), (1, 3, "x.com/a", "block"), (1, 2, "x.com/", "allow"), (None, 200_002, "x.com/a", "block")], key=str)
