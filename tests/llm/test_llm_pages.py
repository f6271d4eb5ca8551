"""Page, URL and vector operators against plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from larkspur.llm import bond, common, queries, urlrules, warc
from pyspark.sql import functions as F


def key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(2)
    big = ["<html>" + "".join(rnd.choice("abcé\n") for _ in range(1500)) + str(i) for i in range(8)]
    urls = [f"https://{h}.Example.{t}/{p}/{i}?a=1#x" for i, (h, t, p) in enumerate((rnd.choice("ab"), rnd.choice(["com", "net"]), rnd.choice(["en", "fr"])) for _ in range(12))]
    out = [(i, rnd.choice(urls), rnd.choice(big), "k", 1) for i in range(80)]
    out += [(100, None, None, "k", 1), (101, "no scheme", "", "k", 1), (102, "http://a b\r\nX: y/é", "short", "k", 1), (103, "http://x.org", "short", "k", 1), (None, urls[0], big[0], "k", 1), (104, "", "é" * 500, "k", 1), (105, "", "é" * 500, "k", 1)]
    return out + [out[3], out[3], (79, urls[1], out[79][2], "k", 1)]


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, offset long")


def expected(rows):
    top = defaultdict(list)
    for p, _, h, *_ in rows:
        if p is not None:
            top[h].append(p)
    out = []
    for p, _, h, *_ in rows:
        raw = (h or "").encode()
        most = max(top[h], default=None) if len(raw) >= 1000 else None
        again = most is not None and (p is None or p < most)
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", most if again else None))
    return out


def test_archives_give_back_what_was_written(spark, pages):
    archived = warc.archive(table(spark, pages), common.fresh_folder(spark, "warc"))
    got = warc.lookup(archived, table(spark, pages)).collect()
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(rows, key=key) == sorted(expected(pages), key=key)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes


def test_lookup_reads_only_the_asked_keys(spark, pages):
    captures = warc.write(table(spark, pages), folder := common.fresh_folder(spark, "warc"))
    parts = warc.index(captures, folder, lines=3)  # keys run over blocks and parts
    asked = table(spark, pages).where("page_id % 7 = 0").select("url")
    wanted = {warc.url_key(r.url) for r in asked.collect()}
    got = warc.find(spark, parts, asked).select("page").collect()
    assert sorted(map(str, (r.page for r in got))) == sorted(str(p[0]) for p in pages if warc.url_key(p[1]) in wanted)
    none = spark.createDataFrame([("http://nowhere.test/",)], "url string")
    assert warc.find(spark, parts, none).collect() == []


def test_archives_are_plain_gzip_records(spark, pages):
    import gzip

    captures = warc.write(table(spark, pages).coalesce(1), common.fresh_folder(spark, "warc")).collect()
    path = captures[0].file.removeprefix("file://")
    whole = gzip.open(path).read()
    assert whole.count(b"WARC/1.1\r\n") == len(pages)


def test_url_keys():
    assert warc.url_key("https://A.b.Org/x?q") == "org,b,a)/x?q"
    assert warc.url_key(None) == warc.url_key("") == ""


def test_no_pages_no_records(spark, pages):
    archived = warc.archive(table(spark, pages).limit(0), common.fresh_folder(spark, "warc"))
    assert warc.lookup(archived, table(spark, pages)).collect() == []


@pytest.mark.parametrize(
    ("url", "wanted"),
    [
        (None, ("", "")), ("", ("", "")), ("no scheme/x", ("", "")), ("HTTP://WWW.ÉX.com", ("www.Éx.com", "")), ("a://b?c/d", ("b", "")),
        ("x://h#f/g", ("h", "")), ("x://h/p?q://z", ("h", "/p")), ("://h/p#", ("h", "/p")), ("u://A://b", ("a:", "//b")),
    ],
)
def test_host_and_path(url, wanted):
    assert urlrules.split_url(url)[:2] == wanted


def test_fixed_rules_longest_wins():
    def own(host, path):
        r = urlrules.fixed_rule(host, path, queries.URL_RULES)
        return r and (r[1] + r[2], r[0])

    assert own("a.com", "/x") == ("com/", "allow")
    assert own("com", "/") == ("com/", "allow")
    assert own("a.com", "") is None
    assert own("b.example.com", "/en/1") == ("example.com/en/", "block")
    assert own("www.example.com", "/en/1") == ("www.example.com/en/", "allow")
    assert own("m.www.example.com", "/en/1") == ("www.example.com/en/", "allow")
    assert own("notexample.com", "/en/1") == ("com/", "allow")
    assert own("x.net", "/fr/") == ("net/fr/", "block")
    assert own("x.net", "/de/") is None


def labelled(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(600):
        host, path = rnd.choice(["good", "spam", "mixed"]), rnd.choice(["shop", "news", "cheap"])
        bad = int(host == "spam" or (host == "mixed" and path == "cheap"))
        rows.append((f"http://{host}.org/{path}/{i}", bad))
    return spark.createDataFrame([*rows, ("http://good.org/news", None), (None, 1), (None, None)], "url string, bad int")


def test_mined_rules_are_those_of_counting_all_combinations(spark):
    from itertools import combinations

    frame = labelled(spark)
    got = urlrules.mine(frame, support=0.01, confidence=0.9)
    assert ("h:spam",) in got and ("h:mixed", "p:cheap") in got
    rows = [(urlrules.tokens(r.url), r.bad) for r in frame.collect() if r.bad is not None and urlrules.tokens(r.url)]
    seen, bad = defaultdict(int), defaultdict(int)
    for items, label in rows:
        for n in range(1, len(items) + 1):
            for c in combinations(items, n):
                seen[c] += 1
                bad[c] += label
    rules = [(c, 1.0) for c in seen if bad[c] >= 0.01 * len(rows) and bad[c] >= 0.9 * seen[c]]
    assert got == urlrules.prune(rules)


def test_verdicts(spark):
    mined = [("h:spam",), ("h:mixed", "p:cheap")]
    urls = ["http://a.spam.org/x", "http://mixed.org/cheap", "http://mixed.org/news", None, "", "http://spam.com/", "http://b.example.com/en/spam"]
    frame = spark.createDataFrame([(u, "r", 3) for u in urls], "url string, rule string, host int")
    got = urlrules.judge(frame, mined, queries.URL_RULES).collect()
    assert [r.verdict for r in got] == ["block", "block", "allow", "allow", "allow", "allow", "block"]
    assert [r.rule for r in got] == [None] * 5 + ["com/", "example.com/en/"]
    empty = frame.limit(0)
    assert urlrules.judge(empty, [], []).collect() == []
    assert urlrules.mine(labelled(spark).limit(0)) == []
    assert urlrules.mine(labelled(spark).where("bad = 0")) == []


def brute_top(rows, k):
    own = [(i, [np.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in own:
        if i % 20 == 0:
            scores = [(-max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(q, c)))), j) for j, c in own if j != i]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize(("dims", "n"), [(1, 90), (16, 300), (40, 700)])
def test_top_k_is_exact(spark, dims, n, monkeypatch):
    monkeypatch.setattr(bond, "ROWS", 64)
    monkeypatch.setattr(bond, "QUERIES", 7)
    rnd = np.random.default_rng(dims)
    rows = [(i, rnd.normal(size=dims).round(1).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # one common vector: ties
    rows += [(2000, None), (2020, [None] * dims), (2040, [float("nan")] * dims), (2060, [float("inf")] * dims), (None, rows[1][1]), (2080, []), (2100, rows[2][1][: dims // 2])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score long")
    got = bond.top_k(frame, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(brute_top(rows, 20))


def test_top_k_of_huge_components_and_few_rows(spark):
    rows = [(0, [3e9, -1.0]), (1, [2e9, 5.0]), (2, [-4e9, 1e-9]), (20, [1e18, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, bond.top_k(frame, F.col("vec_id") % 20 == 0).collect())) == sorted(brute_top(rows, 20))
    assert bond.top_k(frame.limit(0), F.lit(True)).collect() == []
    assert bond.top_k(frame.limit(1), F.lit(True)).collect() == []


def test_repeated_ids_keep_their_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (0, [2.0]), (1, [1.0]), (1, [1.0])], "vec_id long, embedding array<double>")
    got = bond.top_k(frame, F.col("vec_id") == 0).collect()
    assert len(got) == 4 and {r.vec_id for r in got} == {1}
