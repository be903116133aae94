"""Secrets, URLs and licences against brute force and planted cases."""

import hashlib
import random
import re

from cinelake.llm import licenses, secret_scan, url_filter
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import documents

KINDS = secret_scan.KINDS


def _base(text):
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "") if len(m[1]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(4)
    bits = ["password", "PassWd", "api_key", "apikey", "ſecret", "token", "secret", '"', "'", " ", "  ", ":", "=", "==", "é", "😀", "\n", "abc", "abcdefgh",
            "AKIA", "AKIAABCDEFGHIJKL", "Z9", "0123456789abcdef" * 2, "0123456789abcdef", "ffff", "G", "-", "_.=+/"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "x " * 40_000 + "token=abcdefgh")]
    got = {r.doc_id: r for r in secret_scan.secret_rows(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = _base(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(b[0] == k for b in base) for k in KINDS[:3]]
        spans = [x for x in got[i].spans.split(",") if x]
        assert [x for x in spans if not x.startswith("markov")] == [f"{k}:{s}:{e}" for k, s, e in base]
        assert spans == sorted(spans, key=lambda x: (int(x.split(":")[1]), KINDS.index(x.split(":")[0])))


def test_models_tell_random_strings_from_identifiers(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = secret_scan.train(docs)
    randoms = ["wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLEKEY", "ghp_16C7e42F292c6912E7710c838347Ae178B4a", "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9"]
    ordinary = ["mail7.example.com.mail8.example", "anotheringthatstionthere", "ONESESTIONERREINGENTIONS", "44184525248425814418"]
    rows = [(k, f"see é {x} here") for k, x in enumerate(randoms + ordinary)]
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.find_secrets(documents(spark, rows), model).collect()}
    assert [spans[k] for k in range(len(rows))] == [[("markov", 6, 6 + len(x))] for x in randoms] + [[] for _ in ordinary]
    empty = documents(spark, rows).where("doc_id < 0")
    assert secret_scan.secret_rows(empty).count() == 0


def _markov(spark, docs, texts):
    found = secret_scan.find_secrets(documents(spark, list(enumerate(texts))), secret_scan.train(docs)).collect()
    spans = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "markov"] for r in found}
    return [spans[k] for k in range(len(texts))]


def test_short_attached_and_adjacent_secrets_are_found(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    short, long = "q7Zk2XvB9rTf4LwN", "q7Zk2XvB9rTf4LwNs8HdJ3mC"
    host = "www.example.com/the/other/station/of/another/mention/and/the/station/of/nation/"
    got = _markov(spark, docs, [f"é {short} here", f"see {host}{long} here", f"{long}/password=abcdefgh1", "see " + host + " here"])
    assert got[0] == [short]
    assert len(got[1]) == 1 and long[1:-1] in got[1][0] and len(got[1][0]) <= len(long) + 2
    assert len(got[2]) == 1 and long[1:-1] in got[2][0]
    assert got[3] == []


def test_encoded_data_in_a_source_hides_no_secrets(spark):
    rng = random.Random(8)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    blobs = [(10_000 + k, "\n".join("".join(rng.choice(letters) for _ in range(76)) for _ in range(20))) for k in range(docs.count() // 2)]
    mixed = docs.unionByName(spark.createDataFrame(blobs, "doc_id long, text string"))
    secret = "q7Zk2XvB9rTf4LwNs8HdJ3mC"
    assert _markov(spark, mixed, [f"see {secret} here", "see 44184525248425814418123 here"]) == [[secret], []]


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    host, path = re.match(r"([^/?#]*)([^?#]*)", url[url.index("://") + 3 :]).groups()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")


def test_verdicts_equal_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    urls = [None, "", "abc", "http://net", "http://net/", "https://A.NET/x?y", "http://example.net/en", "//org/fr/", "http:///", "http://.net/", "http://net./",
            "x://a://net/", "HTTP://EXAMPLE.COM/de/\nq", "http://" + "a." * 3000 + "net/" + "z" * 5000, "http://xexample.net/en/"]
    hosts = ["net", "example.net", "example.com", "org", "example.org"]
    for _ in range(400):
        urls.append("http" + rng.choice(["", "s"]) + "://" + rng.choice(["", "a.", "b.c.", "X."]) + rng.choice(hosts) + rng.choice(["", "/", "/en/", "/de/1", "/fr/z", "/EN/", "?a=/en/", "#/"]))
    pages = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, host string, path int")
    more = [(f"h{i}.example", "/", "block") for i in range(300)] + RULES
    for rules, blocks in ((RULES, 1 << 15), (more, 1 << 15), (more, 1)):  # one block: nearly all are possible hits
        monkeypatch.setattr(url_filter, "MOST_BLOCKS", blocks)
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
        assert got == {i: _judge(u, rules) for i, u in enumerate(urls)}
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.judge(pages, none).where("verdict = 'block'").count() == 0
    assert url_filter.judge(pages.where("page_id < 0"), spark.createDataFrame(RULES, "host string, path string, verdict string")).count() == 0


def test_license_lines_are_found_and_others_left(spark):
    lines = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    prose = "the quick work of this and that is under review by the software people in any form"
    rows = [(k, f"{prose}\n{prose}\n{t}.\n{prose}") for k, (_, t) in enumerate(lines)]
    rows += [(100 + k, prose + (f" version {k}\n" + prose) * (k % 4)) for k in range(60)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "word " * 50_000), (204, "MIT"), (205, "we used the license plate of a public car")]
    docs = documents(spark, rows)
    got = {r.doc_id: (r.n_licenses, r.families, r.paragraphs) for r in licenses.scan(docs).collect()}
    assert len(got) == len(rows)
    for k, (family, _) in enumerate(lines):
        assert got[k] == (1, family, f"{family}:2"), lines[k]
    assert {got[i] for i, _ in rows if i >= 100} == {(0, "", "")}
    assert licenses.scan(docs.where("doc_id < 0")).count() == 0


def test_license_scan_of_a_table_agrees_with_its_lines(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lines = {"Apache": "licensed under the apache license, version 2.0", "CC": "licensed under cc by-nc 4.0", "GPL": "licensed under the gnu general public license, version 3", "MIT": "released under the mit license"}
    got = {r.doc_id: r.paragraphs for r in licenses.scan(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        want = [f"{f}:{k}" for k, line in enumerate((r.text or "").split("\n")) for f, t in lines.items() if t in line.lower()]
        assert got[r.doc_id] == ",".join(want)


def _licences(spark, texts):
    prose = "the quick work of this and that is under review by the software people in any form"
    rows = list(enumerate(texts)) + [(1000 + k, prose) for k in range(40)]
    got = {r.doc_id: r.paragraphs for r in licenses.scan(documents(spark, rows)).collect()}
    return [got[k] for k in range(len(texts))]


def test_phrases_without_a_licence_name_are_no_licence(spark):
    texts = ["The patch was released under the old scheme", "He was licensed under the state board", "Released under the Foo License", "SPDX-License-Identifier: Zlib",
             "Licensed under the GNU Lesser General Public License, version 3", "Released under the ISC License"]
    assert _licences(spark, texts) == ["", "", "", "", "LGPL:0", "ISC:0"]
    for family, grams in licenses.fragments():
        assert grams not in (["released under", "under the"], ["licensed under", "under the"]), family
    assert licenses.least_probability([0.9, 0.7] + [0.0] * 998) > 0.7
    assert licenses.least_probability([0.0] * 1000) == 0.5


def test_every_licence_of_a_line_is_reported(spark):
    texts = ["Licensed under the MIT License or the Apache License, Version 2.0", "Released under the MIT License. Portions licensed under CC BY-NC 4.0.",
             "Licensed under the Apache License, Version 2.0 " + "some other words " * 500 + "This work is licensed under the GNU General Public License, version 3",
             "Released under the MIT License\nReleased under the MIT License\nReleased under the MIT License"]
    assert _licences(spark, texts) == ["Apache:0,MIT:0", "CC:0,MIT:0", "Apache:0,GPL:0", "MIT:0,MIT:1,MIT:2"]


def test_wrapped_notices_are_found(spark):
    def wrap(text, mark, width):
        lines = [mark]
        for word in text.split():
            if lines[-1] != mark and len(lines[-1]) + len(word) > width:
                lines.append(mark)
            lines[-1] += " " + word
        return "\n".join(lines)

    cases = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    texts = ["some prose here\n\n" + wrap(t, mark, 24) + "\n\nother prose" for _, t in cases for mark in ("", " *", "// ", "# ", "rem")]
    assert _licences(spark, texts) == [f"{f}:2" for f, _ in cases for _ in range(5)]
