"""Log mining on hand-written lines, edge rows included."""

import gzip
import re

import pytest
from larkspur.functions import logfields as lf
from larkspur.plans import weblog
from larkspur.sources import readers
from pyspark.sql import functions as F


def line(host, size="10", day=1, hour=0, request="GET / HTTP/1.0", status="200"):
    when = f"{day:02d}/Aug/1995:{hour:02d}:00:05 -0400"
    return f'{host} - - [{when}] "{request}" {status} {size}'


EDGE = [
    line("a.x.ac.uk"),
    line("a.x.ac.uk", request="GET /old"),
    line("b.x.ac.uk", size="-"),
    line("c.y.edu"),
    line("d.z.edu.au"),
    line("E.Y.EDU"),
    line("plain.com", request="GET /about.edu HTTP/1.0"),
    "junk",
    "",
    line("odd.com") + " trailing text",
    line("quote.com", request='GET /"x" HTTP/1.0'),
    line("late.com") + " more",
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(v,) for v in EDGE], "value string")


def test_strict_fields_equal_one_search_per_field(lines):
    want = [
        m.groups() if (m := re.search(lf.LINE_PATTERN, v)) else ("",) * 5 for v in EDGE
    ]
    got = [tuple(r) for r in weblog.parse_strict(lines).collect()]
    assert got == want
    single = lines.select(*[lf.field(F.col("value"), i) for i in range(1, 6)])
    assert [tuple(r) for r in single.collect()] == want


def test_dash_bytes_empty_the_strict_row_only(lines):
    strict = weblog.parse_strict(lines).collect()[2]
    typed = weblog.parse(lines).collect()[2]
    assert tuple(strict) == ("",) * 5
    assert (typed.host, typed.status, typed.bytes) == ("b.x.ac.uk", 200, None)


def test_country_rules_are_ordered_and_case_sensitive(spark):
    hosts = ["a.ac.uk", "a.edu", "a.edu.au", "a.edu.au.edu", "A.EDU", "a.com", ""]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [r.country for r in weblog.with_country(rows).collect()]
    assert got == ["UK", "US", "Australia", "US", "other", "other", "other"]


def test_line_counts_search_the_whole_line(lines):
    row = weblog.country_line_counts(lines).first()
    assert (row.n_lines, row.n_us, row.n_uk, row.n_australia, row.n_edu) == (12, 2, 3, 1, 3)


def test_distinct_hosts_include_the_empty_one(lines):
    assert weblog.distinct_hosts(weblog.parse_hosts(lines)).first().n_hosts == 9


def ranked_lines():
    """Five hosts per country; the last two tie."""
    out = []
    for suffix in (".ac.uk", ".edu", ".com"):
        for i, n in enumerate((9, 7, 5, 2, 2)):
            out += [line(f"h{i}{suffix}", hour=h % 24) for h in range(n)]
    return out


def test_ties_share_a_rank_and_stay_in_the_top(spark):
    lines = spark.createDataFrame([(v,) for v in ranked_lines()], "value string")
    hosts = weblog.parse_hosts(lines)
    ranks = {(r.country, r.host): r.rnk for r in weblog.host_ranks(hosts).collect()}
    assert [ranks["UK", f"h{i}.ac.uk"] for i in range(5)] == [1, 2, 3, 4, 4]
    assert weblog.top_hosts(hosts, 4).filter("country = 'UK'").count() == 5


def test_rest_bucket_conserves_the_total(spark):
    values = ranked_lines()
    lines = spark.createDataFrame([(v,) for v in values], "value string")
    slices = weblog.top_hosts_with_rest(weblog.parse_hosts(lines), 2)
    assert slices.agg(F.sum("n")).first()[0] == len(values)
    rest = {r.country: r.n for r in slices.filter("rnk = 0").collect()}
    assert rest == {"UK": 9, "US": 9, "other": 9}
    shares = weblog.host_shares(weblog.parse_hosts(lines), 2)
    for row in shares.groupBy("country").agg(F.sum("share").alias("s")).collect():
        assert row.s == pytest.approx(1.0)


def test_institution_rank_is_against_the_whole_country(spark):
    lines = spark.createDataFrame([(v,) for v in ranked_lines()], "value string")
    rows = weblog.institution_ranks(weblog.parse_hosts(lines), "h2.ac").collect()
    assert [(r.host, r.rnk) for r in rows] == [("h2.ac.uk", 3)]


def test_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame(
        [("31/Aug/1995:22:15:44 -0400",), ("01/Aug/1995:00:00:01 +0530",), ("",), ("x",)],
        "ts_raw string",
    )
    names = ["epoch_s", "day", "hour", "local_day", "local_hour"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results.append([tuple(r) for r in weblog.log_times(rows).select(*names).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert results[0] == results[1] == results[2]
    assert results[0][0] == (809921744, 1, 2, 31, 22)
    assert results[0][1][1:] == (31, 18, 1, 0)
    assert results[0][2] == results[0][3] == (None,) * 5


def test_heatmap_counts_the_leading_hosts_only(spark):
    values = [line("top.ac.uk", hour=h) for h in (1, 1, 2)] + [line("low.ac.uk", hour=1)]
    values += [line("x.edu", day=2), line("y.edu", day=3), line("big.com")] * 2
    lines = spark.createDataFrame([(v,) for v in values], "value string")
    cells = {(r.country, r.day, r.hour): r.n for r in weblog.heatmap(lines).collect()}
    assert cells == {
        ("UK", 1, 5): 2, ("UK", 1, 6): 1,
        ("US", 2, 4): 2, ("US", 3, 4): 2,  # both lead: they tie
    }
    wide = weblog.heatmap_pivot(weblog.heatmap(lines)).filter("country = 'UK' and hour = 5").first()
    assert wide.d01 == 2 and wide.d02 is None and len(wide) == 33
    assert weblog.busy_hours(lines, "UK", 1).count() == 1
    events = weblog.leading_host_events(lines)
    assert events.count() == 7


def test_gzip_lines_can_be_spread(spark, tmp_path):
    path = str(tmp_path / "log.gz")
    with gzip.open(path, "wt") as out:
        out.write("\n".join(ranked_lines()))
    plain = readers.log_lines(spark, path)
    spread = readers.log_lines(spark, path, spread=6)
    assert plain.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() == 6
    assert sorted(plain.collect()) == sorted(spread.collect())
