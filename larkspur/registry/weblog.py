"""Access-log queries over ``events`` written as log lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.plans import weblog
from larkspur.sources import standins

INSTITUTION = "h1"
INSTITUTION_SUFFIX = ".ac.uk"
BUSY_ABOVE = 1


def _lines(spark, folder):
    return standins.log_lines(spark, folder)


def _strict(spark, folder):
    return weblog.parse_strict(_lines(spark, folder))


def _hosts(spark, folder):
    return weblog.parse_hosts(_lines(spark, folder))


QUERIES = {
    "log_lines": _lines,
    "log_country_lines": lambda s, d: weblog.country_line_counts(_lines(s, d)),
    "log_lines_containing": lambda s, d: weblog.lines_containing(_lines(s, d), ".edu.au"),
    "log_parse": lambda s, d: weblog.parse(_lines(s, d)),
    "log_parse_strict": _strict,
    "log_country": lambda s, d: weblog.with_country(_strict(s, d)),
    "log_distinct_hosts": lambda s, d: weblog.distinct_hosts(_hosts(s, d)),
    "log_host_counts": lambda s, d: weblog.host_counts(_hosts(s, d)).orderBy(
        F.desc("n"), "country", "host"
    ),
    "log_host_rank": lambda s, d: weblog.host_ranks(_hosts(s, d)),
    "log_top9": lambda s, d: weblog.top_hosts(_hosts(s, d)),
    "log_top9_rest": lambda s, d: weblog.top_hosts_with_rest(_hosts(s, d)),
    "log_share": lambda s, d: weblog.host_shares(_hosts(s, d)).withColumn(
        "share", F.round("share", 6)
    ),
    "log_country_slice": lambda s, d: weblog.country_slice(_hosts(s, d), "UK"),
    "log_institution_rank": lambda s, d: weblog.institution_ranks(
        _hosts(s, d), INSTITUTION
    ).filter(F.col("host").endswith(INSTITUTION_SUFFIX)),
    "log_top_host": lambda s, d: weblog.leading_hosts(_lines(s, d)),
    "log_top_host_events": lambda s, d: weblog.leading_host_events(_lines(s, d)),
    "log_timestamps": lambda s, d: weblog.log_times(_strict(s, d)).select(
        "host", "ts_raw", "epoch_s", "day", "hour", "local_day", "local_hour"
    ),
    "log_heatmap": lambda s, d: weblog.heatmap(_lines(s, d)),
    "log_heatmap_pivot": lambda s, d: weblog.heatmap_pivot(weblog.heatmap(_lines(s, d))),
    "log_busy_hours": lambda s, d: weblog.busy_hours(_lines(s, d), "UK", BUSY_ABOVE),
}

_LINES = """
lines AS (
  SELECT 'h' || user_id || CASE user_id % 4 WHEN 0 THEN '.ac.uk' WHEN 1 THEN '.edu'
           WHEN 2 THEN '.edu.au' ELSE '.com' END
         || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "GET /' || event_type
         || ' HTTP/1.0" ' || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END || ' '
         || CASE WHEN event_id % 50 = 0 THEN '-'
                 ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS value
  FROM events)"""

_PATTERN = r"""'^(.*?) - - \[(.*?)\] "(.*?)" (\d+) (\d+)'"""
_PATTERN_NULL_BYTES = r"""'^(.*?) - - \[(.*?)\] "(.*?)" (\d+) (\d+|-)'"""

_STRICT = f"""{_LINES},
parsed AS (
  SELECT regexp_extract(value, {_PATTERN}, 1) AS host,
         regexp_extract(value, {_PATTERN}, 2) AS ts_raw,
         regexp_extract(value, {_PATTERN}, 3) AS request,
         regexp_extract(value, {_PATTERN}, 4) AS status,
         regexp_extract(value, {_PATTERN}, 5) AS bytes
  FROM lines),
located AS (
  SELECT *, CASE WHEN host LIKE '%.ac.uk' THEN 'UK' WHEN host LIKE '%.edu' THEN 'US'
                 WHEN host LIKE '%.edu.au%' THEN 'Australia' ELSE 'other' END AS country
  FROM parsed)"""

_COUNTED = f"""{_STRICT},
counted AS (SELECT country, host, count(*) AS n FROM located GROUP BY country, host),
ranked AS (
  SELECT country, host, n, rank() OVER (PARTITION BY country ORDER BY n DESC) AS rnk
  FROM counted)"""

_SLICES = f"""{_COUNTED},
slices AS (
  SELECT country, host, rnk, n FROM ranked WHERE rnk <= 9
  UNION ALL
  SELECT country, 'other institutions', 0, CAST(sum(n) AS BIGINT)
  FROM ranked WHERE rnk > 9 GROUP BY country)"""

_TIMES = f"""{_STRICT},
stamped AS (
  SELECT *, try_strptime(substr(ts_raw, 1, 20), '%d/%b/%Y:%H:%M:%S') AS local_ts
  FROM located),
timed AS (SELECT *, local_ts + INTERVAL 4 HOUR AS utc_ts FROM stamped)"""

_HEATMAP = f"""{_TIMES},
totals AS (SELECT country, host, count(*) AS n FROM timed WHERE country <> 'other'
           GROUP BY country, host),
leaders AS (SELECT host FROM (
              SELECT host, rank() OVER (PARTITION BY country ORDER BY n DESC) AS rnk
              FROM totals) WHERE rnk = 1),
cells AS (
  SELECT country, CAST(day(utc_ts) AS INTEGER) AS day, CAST(hour(utc_ts) AS INTEGER) AS hour,
         count(*) AS n
  FROM timed WHERE host IN (SELECT host FROM leaders) AND country <> 'other'
  GROUP BY ALL)"""

_PIVOT = ", ".join(
    f"nullif(count(*) FILTER (WHERE day(utc_ts) = {d}), 0) AS d{d:02d}" for d in range(1, 32)
)

ORACLES = {
    "log_lines": f"WITH {_LINES} SELECT value FROM lines",
    "log_country_lines": f"""WITH {_LINES}
        SELECT count(*) AS n_lines,
               count(*) FILTER (WHERE contains(value, '.edu ')) AS n_us,
               count(*) FILTER (WHERE contains(value, '.ac.uk')) AS n_uk,
               count(*) FILTER (WHERE contains(value, '.edu.au')) AS n_australia,
               count(*) FILTER (WHERE contains(value, '.edu')) AS n_edu
        FROM lines""",
    "log_lines_containing": f"""WITH {_LINES}
        SELECT value FROM lines WHERE contains(value, '.edu.au')""",
    "log_parse": f"""WITH {_LINES}
        SELECT regexp_extract(value, {_PATTERN_NULL_BYTES}, 1) AS host,
               regexp_extract(value, {_PATTERN_NULL_BYTES}, 2) AS ts_raw,
               regexp_extract(value, {_PATTERN_NULL_BYTES}, 3) AS request,
               TRY_CAST(regexp_extract(value, {_PATTERN_NULL_BYTES}, 4) AS INTEGER) AS status,
               TRY_CAST(regexp_extract(value, {_PATTERN_NULL_BYTES}, 5) AS BIGINT) AS bytes
        FROM lines""",
    "log_parse_strict": f"WITH {_STRICT} SELECT * FROM parsed",
    "log_country": f"WITH {_STRICT} SELECT * FROM located",
    "log_distinct_hosts": f"WITH {_STRICT} SELECT count(DISTINCT host) AS n_hosts FROM parsed",
    "log_host_counts": f"WITH {_COUNTED} SELECT * FROM counted",
    "log_host_rank": f"WITH {_COUNTED} SELECT * FROM ranked",
    "log_top9": f"WITH {_COUNTED} SELECT * FROM ranked WHERE rnk <= 9",
    "log_top9_rest": f"WITH {_SLICES} SELECT * FROM slices",
    "log_share": f"""WITH {_SLICES}
        SELECT country, host, rnk, n,
               round(n / CAST(sum(n) OVER (PARTITION BY country) AS DOUBLE), 6) AS share
        FROM slices""",
    "log_country_slice": f"WITH {_SLICES} SELECT host, n FROM slices WHERE country = 'UK'",
    "log_institution_rank": f"""WITH {_COUNTED}
        SELECT * FROM ranked WHERE host LIKE '%{INSTITUTION}%{INSTITUTION_SUFFIX}'""",
    "log_top_host": f"""WITH {_COUNTED}
        SELECT * FROM ranked WHERE rnk = 1 AND country <> 'other'""",
    "log_top_host_events": f"""WITH {_COUNTED}
        SELECT country, host, ts_raw FROM located
        WHERE host IN (SELECT host FROM ranked WHERE rnk = 1 AND country <> 'other')""",
    "log_timestamps": f"""WITH {_TIMES}
        SELECT host, ts_raw, CAST(epoch(utc_ts) AS BIGINT) AS epoch_s,
               CAST(day(utc_ts) AS INTEGER) AS day, CAST(hour(utc_ts) AS INTEGER) AS hour,
               CAST(day(local_ts) AS INTEGER) AS local_day,
               CAST(hour(local_ts) AS INTEGER) AS local_hour
        FROM timed""",
    "log_heatmap": f"WITH {_HEATMAP} SELECT * FROM cells",
    "log_heatmap_pivot": f"""WITH {_HEATMAP}
        SELECT country, CAST(hour(utc_ts) AS INTEGER) AS hour, {_PIVOT}
        FROM timed WHERE host IN (SELECT host FROM leaders) AND country <> 'other'
        GROUP BY country, hour(utc_ts)""",
    "log_busy_hours": f"""WITH {_HEATMAP}
        SELECT * FROM cells WHERE country = 'UK' AND n > {BUSY_ABOVE}""",
}
