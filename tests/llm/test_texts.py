import hashlib
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from hardcourt.llm import cotraining, decontaminate, license_scan, pii, url_reputation
from tests.llm.fixtures import SF, docs, labels

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0


def valid(kind, t):
    d = re.sub("[^0-9]", "", t)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in t.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def base_by_force(t):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, t or "") if valid(k, m.group())]


def test_personal_data_by_force(spark):
    rnd = random.Random(1)
    letters = "a.b@1 2-+5().%_é\u00019😀25"
    rows = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 120)))) for i in range(1500)]
    rows += [(9001, None), (9002, "1" * 20000), (9003, "a." * 20000 + "@b.c" + ".c" * 20000), (9004, "4111111111111111 " * 300), (9005, "1 " * 20000), (9006, "x@y.z " * 1000), (9007, "+1((((" * 3000)]
    for df in (spark.createDataFrame(rows, "doc_id long, text string"), spark.read.parquet(f"{SF}/documents.parquet"), docs(spark, clash=True)):
        got = pii.with_spans(df).select("doc_id", "text", pii.listed(F.col("base")).alias("b"), pii.listed(F.col("spans")).alias("s")).collect()
        for r in got:
            assert [x for x in r.b.split(",") if x] == base_by_force(r.text)
            assert {*r.b.split(",")} <= {*r.s.split(",")} or not r.b
    assert pii.with_spans(docs(spark, rows=[])).count() == 0


def test_boosting_adds_what_looks_alike(spark):
    rows = [(i, f"call +1 ({200 + i % 700}) 555-{1000 + i} or order 12345678{i:04d}9999{i % 9}99 x") for i in range(400)] + [(1000 + i, f"call ({200 + i}) 555-{2000 + i} soon") for i in range(20)]
    got = {r.doc_id: r.s for r in pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    assert sum("phone" in got[1000 + i] for i in range(20)) >= 15


def test_decided_candidates_become_spans(spark):
    texts = ["4111  1111  1111  1111", "4111 - 1111 - 1111 - 1111", "jo.do @ host.com", "jo [@] mail.host.com", "4111  1111  1111  1112", "jo @ home. Then", "jo@mail.host.com"]
    df = spark.createDataFrame([(k, f"so {t}. Then so") for k, t in enumerate(texts)], "doc_id long, text string")
    got = [r.t for r in pii.with_spans(df).select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).orderBy("doc_id").collect()]
    assert got == [f"so {t}. Then so" for t in ("[CARD]", "[CARD]", "[EMAIL]", "[EMAIL]", texts[4], texts[5], "[EMAIL]")]


def test_sentence_ends_are_no_addresses(spark):
    rows = [(i, f"mail jo{i}@mail.example.com or as atatti. Inthin esth atannt. Thwhou and look at example.com") for i in range(200)]
    got = pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string")).select(pii.listed(F.col("spans")).alias("s")).collect()
    assert all(r.s.count("email") == 1 for r in got)
    decided = spark.createDataFrame(rows[:1], "doc_id long, text string").select(F.explode(pii.candidates(F.col("text"))).alias("c")).select("c.*")
    assert {r.label for r in decided.filter("kind = 0").collect()} == {0, 1}


def test_many_matches_in_one_text(spark):
    """Time grows with the number of matches: spans, candidates apart from them, and redaction."""
    n = 32_000
    rows = [(1, "a@b.cd " * n), (2, "4111  1111  1111  1111 a@b.cd, " * (n // 16)), (3, "4111111111111111, 4111  1111  1111  1111, " * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pii.with_spans(df.limit(0)).count()
    began = time.monotonic()
    found = pii.with_spans(df).select("doc_id", "text", "base", "spans", pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()
    took = time.monotonic() - began
    got = {r.doc_id: r for r in found}
    assert [(len(got[k].base), len(got[k].spans)) for k in (1, 2, 3)] == [(n, n), (n // 16, n // 8), (300, 600)]
    assert got[1].t == "[EMAIL] " * n and got[2].t == "[CARD] [EMAIL], " * (n // 16) and got[3].t == "[CARD], [CARD], " * 300
    assert took < 90, took


def test_spans_apart(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(60):
        base, at = [], 0
        for _ in range(rnd.randint(0, 400)):
            at += rnd.randint(0, 5)
            base.append((rnd.randrange(2), at, at + rnd.randint(1, 6)))
            at = base[-1][2]
        loose = [(rnd.randrange(3), s := rnd.randint(0, 1500), s + rnd.randint(1, 9)) for _ in range(rnd.randint(0, 300))]
        rows.append((sorted(base), sorted({*loose} - {*base})))
    spans = "array<struct<kind:int,s:int,e:int>>"
    df = spark.createDataFrame(rows, f"base {spans}, loose {spans}")
    got = df.select("base", "loose", F.transform(pii.apart(F.transform("loose", pii.coded), F.transform("base", pii.coded)), pii.decoded).alias("kept")).collect()
    for r in got:
        want = {tuple(x) for x in r.loose if not any(b[0] == x[0] and b[1] < x[2] and x[1] < b[2] for b in r.base)}
        assert {tuple(x) for x in r.kept} == want


def test_long_candidates(spark):
    """No length is too long for the generators."""
    local, host = "x" * 300, "-".join(["host"] * 40)
    texts = [f"{local} at {host} dot com", "4111" + " " * 40 + "1111" + " " * 40 + "1111 1111"]
    got = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").select("doc_id", F.explode(pii.candidates(F.col("text"))).alias("c")).select("doc_id", "c.*").collect()
    assert (0, 0, 0, len(texts[0])) in {(r.doc_id, r.kind, r.s, r.e) for r in got}
    assert (1, 2, 0, len(texts[1]), 1) in {(r.doc_id, r.kind, r.s, r.e, r.label) for r in got}


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é mail a@b.co or 10.0.0.1, 4111 1111 1111 1111 end"), (2, "none"), (3, None)], "doc_id long, text string")
    rows = pii.with_spans(df).select("doc_id", pii.redacted(F.col("text"), F.col("base")).alias("t")).orderBy("doc_id").collect()
    assert [r.t for r in rows] == ["é mail [EMAIL] or [IP], [CARD] end", "none", None]


def hits_by_force(text, items):
    from hardcourt.llm.words import words

    w, hit, who = words(text), set(), set()
    for item, t in items:
        x = words(t)
        runs = [x[i : i + 10] for i in range(max(1, len(x) - 9))] if x else []
        for run in runs:
            for s in range(len(w) - len(run) + 1):
                if w[s : s + len(run)] == run:
                    hit.update(range(s, s + len(run)))
                    who.update([] if item is None else [str(item)])
    return len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("most", [decontaminate.BLOCK_CHARS, 500])
def test_decontamination_by_force(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", most)
    blocks = decontaminate.blocks
    monkeypatch.setattr(decontaminate, "blocks", lambda items, size: blocks(items, size, most))
    items = [(1, "one two three"), (2, None), (3, ""), (10, "A b c D e f g h i j k l m"), (11, "c d e f g h i j k l"), (12, "ünï code"), (None, "no id here"), (12, "ünï code")]
    texts = ["x one TWO, three y one two three", None, "", "a b c d e f g h i j k l m n", "ones two three", "Ünï code ünï code", "a b c d e f g h i j", " ".join("abcdefghijklm" * 300), "there is no id here"]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.digest(decontaminate.contamination(df, bench)).collect()}
    assert got == {k: hits_by_force(t, items) for k, t in enumerate(texts)}
    spans = {r.doc_id: r.spans for r in decontaminate.digest(decontaminate.contamination(df, bench)).collect()}
    assert spans[0] == "2:16,19:32" and spans[1] == ""


def test_decontamination_of_odd_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.contamination(docs(spark).select("doc_id", "text"), bench)).filter("contaminated").count() == 0
    assert decontaminate.contamination(docs(spark, clash=True), bench).count() == 11
    few = spark.createDataFrame([(1, "the quick brown"), (2, "MIT license")], "item_id long, text string")
    odd = decontaminate.contamination(docs(spark, clash=True), few)
    assert odd.filter("state is not null").count() == 3
    assert decontaminate.contamination(docs(spark, rows=[]), spark.createDataFrame([(1, "x")], "item_id long, text string")).count() == 0


@pytest.mark.parametrize(("query", "sql"), [(decontaminate.op10_decontaminate, decontaminate.OP10_SQL), (url_reputation.op9_host_reputation, url_reputation.OP9_SQL)])
def test_queries_equal_sql(spark, query, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df, found = query(spark, SF), con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, found.fetchall()))


def test_urls(spark):
    urls = [None, "no scheme", "http://A.Example.ORG/es/x?q", "http://example.org/en/12#y", "https://x.com/fr/", "http://com/de/1", "http://notexample.org", "ftp://bad.net:80/a", "http://bad.net/b", "http://good.net/"] + ["http://bad.net/"] * 30 + ["http://good.net/"] * 30
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    out = spark.createDataFrame([(k, int("bad" in (u or ""))) for k, u in enumerate(urls) if k > 6], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judged(pages, out).collect()}
    assert [got[k] for k in range(7)] == [
        ("", "", None, got[0][3]), ("", "", None, got[0][3]), ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("x.com", "/fr/", "com/fr/", "allow"), ("com", "/de/1", "com/de/", "block"), ("notexample.org", "", None, got[6][3]),
    ]
    assert got[8][3] == "block" and got[9][3] == "allow"
    more = pages.unionByName(spark.createDataFrame([(None, "http://bad.net/x"), (8, "http://bad.net/b")], "page_id long, url string")).withColumns({"host": F.lit(1), "verdict": F.lit(2), "bad": F.lit(3)})
    odd = [(r.page_id, r.verdict) for r in url_reputation.judged(more, out).collect()]
    assert len(odd) == len(urls) + 2 and (None, "block") in odd and odd.count((8, "block")) == 2
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_reputation.judged(empty, out).count() == 0
    assert {r.verdict for r in url_reputation.judged(pages, out.filter("false")).filter("rule is null").collect()} == {"allow"}


def test_suffixes(spark):
    hosts = ["a.b.co.uk", "www.x.ac.jp:80", "u@shop.com.au", "x.y.com", "co.uk", "b.github.io", "localhost", ""]
    got = spark.createDataFrame([(h,) for h in hosts], "h string").select(*url_reputation.domain_parts(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("co.uk", "b.co.uk"), ("ac.jp", "x.ac.jp"), ("com.au", "shop.com.au"), ("com", "y.com"), ("co.uk", "co.uk"), ("io", "github.io"), ("localhost", "localhost"), ("", "")]
    more = spark.createDataFrame([("b.github.io",)], "h string").select(*url_reputation.domain_parts(F.col("h"), ("github.io",))).first()
    assert tuple(more) == ("github.io", "b.github.io")


def test_hosts_in_numbers_and_closing_dots(spark):
    hosts = ["10.0.0.1", "10.0.0.1:80", "9.8.0.1", "www.a.co.uk.", "b.example.com", "me@c.com:8080", "[::1]:80", ""]
    suffix, domain = url_reputation.domain_parts(F.col("h"))
    got = [tuple(r) for r in spark.createDataFrame([(h,) for h in hosts], "h string").select(suffix, domain).collect()]
    assert got == [("ip", "10.0.0.1"), ("ip", "10.0.0.1"), ("ip", "9.8.0.1"), ("co.uk", "a.co.uk"), ("com", "example.com"), ("com", "c.com"), ("ip", "[::1]"), ("", "")]


def test_addresses_of_many_labels():
    """Spelled-out addresses may have as many labels as a host name can."""
    loose = re.compile(pii.LOOSE["email"])
    for n in (1, 9, 60):
        text = "jo (at) " + ".".join(f"h{i}" for i in range(n)) + ".example.com"
        assert loose.search(f"write to {text} today").group(0) == text


def test_licenses_as_people_call_them():
    """Bare names and versions; what only resembles them is none."""
    found = lambda t: [name for name, *_ in license_scan.scan(t)]
    assert found("see the MIT License for more") == ["MIT"]
    assert found("Licensed under the GNU GPL v3, of course") == ["GPL-3.0"]
    assert found("under the GNU GPL version 2 or so") == ["GPL-2.0"]
    assert found("This work is licensed under a Creative Commons Attribution 3.0 Unported License.") == ["CC-BY-3.0"]
    assert found("This work is licensed under a Creative Commons Attribution 4.0 International License.") == ["CC-BY-4.0"]
    assert found("Licensed under CC BY-SA 2.5.") == ["CC-BY-SA-2.5"]
    assert found(f"x {license_scan.CALLED['LGPL-2.1'][-1]} y") == ["LGPL-2.1"]
    for t in ("all rights not reserved", "was all rights and reserved seats", "a license of MIT graduates", "Creative Commons Attribution 7.0 License", "GPL and v3 engines"):
        assert found(t) == [], t


def test_licenses(spark):
    df = docs(spark, clash=True).unionByName(docs(spark, clash=True, rows=[(20, "Text. This work is licensed under the GNU General Public License, version 3. More. Licensed under CC BY-NC 4.0. And Licensed under CC BY-NC 4.0.", "en", "s", 1), (21, "a license to thrill and permission slips", "en", "s", 1)]))
    got = sorted((r.doc_id, r.license, r.first_word, r.last_word) for r in license_scan.licenses(df).collect())
    assert got == [(8, "MIT", 0, 5), (20, "CC-BY-NC-4.0", 14, 21), (20, "CC-BY-NC-4.0", 22, 29), (20, "GPL-3.0", 1, 13)]
    assert license_scan.licenses(docs(spark, rows=[])).count() == 0


def test_rights_and_spellings(spark):
    opening = license_scan.TEMPLATES["MIT"][2]
    texts = [
        "Text. All rights reserved. More.", "Released under the MIT Licence.", opening.replace("Permission", "Leave"), license_scan.TEMPLATES["BSD-3-Clause"][0].replace("Redistribution", "Distribution"),
        "all of the many rights we had were then reserved", "all the rights. All rights reserved, all rights reserved", "Licensed under, and only under, the well known and widely used MIT License",
        "# SPDX-License-Identifier: GPL-3.0-only", "Licence: MIT", "Released under the Apache License.", "x Distributed under the Boost Software License, Version 1.0. y",
    ]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = sorted((r.doc_id, r.license, r.first_word, r.last_word) for r in license_scan.licenses(df).collect())
    n, m = (len(license_scan.words(t)) for t in texts[2:4])
    assert got == [
        (0, "All-Rights-Reserved", 1, 4), (1, "MIT", 0, 4), (2, "MIT", 1, n), (3, "BSD-3-Clause", 1, m), (5, "All-Rights-Reserved", 3, 6), (5, "All-Rights-Reserved", 6, 9), (6, "MIT", 0, 13),
        (7, "GPL-3.0", 0, 6), (8, "MIT", 0, 2), (10, "BSL-1.0", 1, 10),
    ]


def test_every_template_is_found_whole(spark):
    """Each license's longest text, some of its words changed and some put in; twice in one text, and as repeated rows."""
    rnd = random.Random(6)
    rows, want = [], []
    for k, (name, texts) in enumerate(license_scan.TEMPLATES.items()):
        w = max(texts, key=len).split(" ")
        if len(w) > 20:
            for at in rnd.sample(range(len(w)), len(w) // 20):
                w[at] = f"changed{at}" if at % 2 else f"{w[at]} added{at}"
        rows += [(k, " ".join(["Fore words.", *w, "Then more,", *w, "end."]))] * 2
        want += [(k, name)] * 4
    got = sorted((r.doc_id, r.license) for r in license_scan.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(want)
    own = {"House": ("Use of the house text is granted to guests of the house alone and to nobody else.",)}
    df = spark.createDataFrame([(1, "Here: use of the house text is granted to all guests of the house alone, and to nobody else. MIT License.")], "doc_id long, text string")
    assert [(r.license, r.first_word) for r in license_scan.licenses(df, templates=own).collect()] == [("House", 1)]


def aligned_by_force(a, b):
    """Patience alignment by its definition: recursive, and the longest increasing subsequence by the quadratic table."""
    out = []
    while a and b and a[0][1] == b[0][1]:
        out.append((a[0][0], b[0][0]))
        a, b = a[1:], b[1:]
    tail = []
    while a and b and a[-1][1] == b[-1][1]:
        tail.append((a[-1][0], b[-1][0]))
        a, b = a[:-1], b[:-1]
    words_a, words_b = [w for _, w in a], [w for _, w in b]
    both = [(i, words_b.index(w)) for i, w in enumerate(words_a) if words_a.count(w) == 1 and words_b.count(w) == 1]
    best = [1] * len(both)
    for x in range(len(both)):
        best[x] = 1 + max((best[y] for y in range(x) if both[y][1] < both[x][1]), default=0)
    return out, tail, a, b, both, max(best, default=0)


def test_patience():
    assert license_scan.increasing([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    assert license_scan.aligned([*"axbycz"], [*"abc"]) == [(0, 0), (2, 1), (4, 2)]
    rnd = random.Random(5)
    for _ in range(500):
        a, b = ([rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(0, 25))] for _ in range(2))
        got = license_scan.aligned(a, b)
        assert all(a[x] == b[y] for x, y in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
        head, tail, _, _, both, longest = aligned_by_force([*enumerate(a)], [*enumerate(b)])
        assert {*head, *tail} <= {*got}
        anchors = {(x + len(head), y + len(head)) for x, y in both}
        assert len(anchors & {*got}) >= longest


def test_cotraining_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    known = spark.read.parquet(f"{sf}/labels.parquet").withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0)
    got = cotraining.scored(df, known.filter("not held").drop("held")).select("doc_id", "p_quality", "p_toxic", "keep").join(known.filter("held"), "doc_id")
    r = got.agg(F.avg(((F.col("p_quality") >= 0.5) == (F.col("quality") == 1)).cast("int")), F.avg(((F.col("p_toxic") > 0.5) == (F.col("toxic") == 1)).cast("int")), F.count("*")).first()
    assert r[2] > 500 and r[0] > 0.98 and r[1] > 0.97


def test_few_labels_all_reach_the_fit(spark):
    """300 labels beside 10,000 documents: a share by the count of documents would take about 10 of them."""
    sf = "/root/testdata/sf0.1"
    df, known = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    few = known.orderBy(F.xxhash64("doc_id")).limit(300)
    assert "text" in cotraining.fitted(df, few, rows=400)["quality"]
    r = cotraining.scored(df, few, rows=400).join(known.join(few, "doc_id", "left_anti"), "doc_id").agg(F.avg(((F.col("p_quality") >= 0.5) == (F.col("quality") == 1)).cast("int"))).first()
    assert r[0] > 0.9


def test_rows_without_an_id_do_not_fill_the_sample(spark):
    """Their hash is one value; and rows that repeat id and text reach the driver once."""
    rows = [(None, f"text {i} of some words", "en", "s", 9) for i in range(3000)] + [(1, "the same", "en", "s", 8)] * 3000
    seen, kept = [], cotraining.cotrained
    try:
        cotraining.cotrained = lambda text, *a: seen.append(len(text)) or kept(text, *a)
        cotraining.fitted(docs(spark, rows=rows), labels(spark, [(1, 1, 0)]), rows=300)
    finally:
        cotraining.cotrained = kept
    assert 200 < seen[0] < 400


def test_cotraining_of_odd_tables(spark):
    got = cotraining.scored(docs(spark, clash=True), labels(spark, [(1, 1, None), (2, None, 0)])).collect()
    assert len(got) == 11 and all(r.keep for r in got)
    assert cotraining.scored(docs(spark, rows=[]), labels(spark)).count() == 0
    assert all(r.keep for r in cotraining.scored(docs(spark), labels(spark)).collect())


def test_personal_data_is_learnt_from_all_documents(spark, monkeypatch):
    """More documents than the sample of about 20,000 that was taken once: every candidate is counted."""
    seen = []
    monkeypatch.setattr(pii, "fit_trees", lambda cells: seen.extend(cells) or [])
    monkeypatch.setattr(pii, "tree_score", lambda trees, bits: 0.0)
    df = spark.range(50_000).selectExpr("id as doc_id", "concat('mail a', id, '@b.org or 1.2.3.', id % 300) as text")
    pii.trained(df)
    every = df.filter("crc32(cast(text as binary)) % 2 = 0").select(F.size(pii.decided(pii.candidates(F.col("text")))).alias("n"))
    assert sum(w for *_, w in seen) == every.agg(F.sum("n")).first()[0]
