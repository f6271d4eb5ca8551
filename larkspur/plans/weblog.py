"""Access-log mining: parsed lines to host ranks, shares and day-by-hour maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import logfields as lf
from larkspur.operators.durable import cut
from larkspur.operators.ranking import (
    count_rows,
    rank_in_group,
    top_k,
    top_k_with_rest,
)

FIELDS = ["host", "ts_raw", "request", "status", "bytes"]
TOP = 9
DAYS = range(1, 32)


def _matched(lines: DataFrame, pattern: str) -> DataFrame:
    """Lines as rows of five text fields.

    The fields leave through ``inline``, which filters are not pushed through:
    a later filter on a field reads the field instead of matching the pattern
    again.
    """
    parts = lines.select(lf.all_fields(F.col("value"), pattern).alias("parts"))
    row = F.struct(*[F.get("parts", F.lit(i)).alias(name) for i, name in enumerate(FIELDS)])
    return parts.select(F.inline(F.array(row)))


def parse_strict(lines: DataFrame) -> DataFrame:
    """Five text fields; a line that misses the pattern gives ``''`` in all five."""
    return _matched(lines, lf.LINE_PATTERN)


def parse_hosts(lines: DataFrame) -> DataFrame:
    """The host alone, as ``parse_strict`` gives it, for jobs that need no other field."""
    return lines.select(lf.field(F.col("value"), 1).alias("host"))


def parse(lines: DataFrame) -> DataFrame:
    """Typed fields; ``-`` bytes are null and do not spoil the line."""
    return _matched(lines, lf.LINE_PATTERN_NULL_BYTES).select(
        "host",
        "ts_raw",
        "request",
        F.col("status").try_cast("int").alias("status"),
        F.col("bytes").try_cast("long").alias("bytes"),
    )


def with_country(parsed: DataFrame) -> DataFrame:
    return parsed.select("*", lf.country_of(F.col("host")).alias("country"))


def lines_containing(lines: DataFrame, text: str) -> DataFrame:
    """Lines with ``text`` anywhere, the request included."""
    return lines.filter(F.col("value").contains(text))


def country_line_counts(lines: DataFrame) -> DataFrame:
    """Lines in all and per country marker, counted in one scan.

    The markers are looked for in the whole line; ``n_edu`` is the wider search
    without the space that ends the host.
    """
    value = F.col("value")
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(value.contains(lf.US_SUFFIX + " ")).alias("n_us"),
        F.count_if(value.contains(lf.UK_SUFFIX)).alias("n_uk"),
        F.count_if(value.contains(lf.AUSTRALIA_PART)).alias("n_australia"),
        F.count_if(value.contains(lf.US_SUFFIX)).alias("n_edu"),
    )


def distinct_hosts(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.countDistinct("host").alias("n_hosts"))


def host_counts(parsed: DataFrame) -> DataFrame:
    """Lines per (country, host)."""
    return count_rows(with_country(parsed), ["country", "host"])


def host_ranks(parsed: DataFrame) -> DataFrame:
    """All hosts with their rank inside the country."""
    return rank_in_group(host_counts(parsed), "country")


def institution_ranks(parsed: DataFrame, part: str) -> DataFrame:
    """Ranks of the hosts whose name contains ``part``.

    The filter would otherwise be pushed into a second scan of the log; the
    counts, far smaller than the log, are stored once and read twice.
    """
    counted = cut(host_counts(parsed))
    return rank_in_group(
        counted, "country", only=counted.filter(F.col("host").contains(part))
    )


def top_hosts(parsed: DataFrame, k: int = TOP) -> DataFrame:
    """Hosts ranked up to ``k`` per country, in that order; ties are kept."""
    return top_k(host_counts(parsed), "country", k).orderBy("country", "rnk")


def top_hosts_with_rest(parsed: DataFrame, k: int = TOP) -> DataFrame:
    """Top hosts per country and one row for all its other hosts."""
    return top_k_with_rest(host_counts(parsed), "country", "host", k, lf.REST_LABEL)


def host_shares(parsed: DataFrame, k: int = TOP) -> DataFrame:
    """Share of each country's lines that a top host (or the rest) has.

    The totals are one row per country and there are four countries, so they
    may be broadcast at any size.
    """
    slices = top_hosts_with_rest(parsed, k)
    totals = slices.groupBy("country").agg(F.sum("n").alias("total"))
    return slices.join(F.broadcast(totals), "country").select(
        "country", "host", "rnk", "n", (F.col("n") / F.col("total")).alias("share")
    )


def country_slice(parsed: DataFrame, country: str, k: int = TOP) -> DataFrame:
    """Top hosts and rest of one country; its lines are picked before any ranking."""
    counted = host_counts(parsed).filter(F.col("country") == country)
    return top_k_with_rest(counted, "country", "host", k, lf.REST_LABEL).select("host", "n")


def named_country_rows(lines: DataFrame, country: str | None = None) -> DataFrame:
    """Strictly parsed rows of the hosts in a named country (all, or the given one).

    A named host leaves its marker in the line, so a substring test drops most
    lines before any pattern is matched against them.
    """
    value = F.col("value")
    marked = lines.filter(value.contains(lf.UK_SUFFIX) | value.contains(lf.US_SUFFIX))
    wanted = F.col("country") == country if country else F.col("country") != "other"
    return with_country(parse_strict(marked)).filter(wanted & F.col("host").isNotNull())


def leading_hosts(lines: DataFrame) -> DataFrame:
    """The first-ranked host(s) of every named country."""
    return top_k(count_rows(named_country_rows(lines), ["country", "host"]), "country", 1)


def leading_host_events(lines: DataFrame) -> DataFrame:
    """The log rows of the leading hosts.

    Leading hosts are hot by nature; the adaptive planner broadcasts the few of them
    and splits hot hosts if so many tie for first place that it cannot.
    """
    leaders = leading_hosts(lines).select("host")
    rows = named_country_rows(lines).join(leaders, "host", "left_semi")
    return rows.select("country", "host", "ts_raw")


def log_times(parsed: DataFrame) -> DataFrame:
    """Epoch second with day and hour in UTC and in the log's own zone."""
    seconds = parsed.select("*", lf.epoch_seconds(F.col("ts_raw")).alias("epoch_s"))
    local = F.col("epoch_s") + lf.zone_offset_seconds(F.col("ts_raw"))
    return seconds.select(
        "*",
        lf.day_of_month(F.col("epoch_s")).alias("day"),
        lf.hour_of_day(F.col("epoch_s")).alias("hour"),
        lf.day_of_month(local).alias("local_day"),
        lf.hour_of_day(local).alias("local_hour"),
    )


def heatmap(lines: DataFrame, country: str | None = None) -> DataFrame:
    """Lines per country, day and hour of the country's leading host(s).

    Lines are counted per (host, day, hour) first: a host then has at most 744
    rows however much of the log it wrote, and both the ranking and the join
    read those counts from the same shuffle.
    """
    hourly = count_rows(
        log_times(named_country_rows(lines, country)), ["country", "host", "day", "hour"]
    )
    totals = hourly.groupBy("country", "host").agg(F.sum("n").alias("n"))
    leaders = top_k(totals, "country", 1).select("country", "host")
    return (
        hourly.join(leaders, ["country", "host"], "left_semi")
        .groupBy("country", "day", "hour")
        .agg(F.sum("n").alias("n"))
    )


def heatmap_pivot(cells: DataFrame) -> DataFrame:
    """One row per country and hour, one column per day of month."""
    wide = cells.groupBy("country", "hour").pivot("day", list(DAYS)).agg(F.sum("n"))
    return wide.select(
        "country", "hour", *[F.col(f"`{d}`").alias(f"d{d:02d}") for d in DAYS]
    )


def busy_hours(lines: DataFrame, country: str, above: int) -> DataFrame:
    """Heatmap cells of one country with more than ``above`` lines."""
    return heatmap(lines, country).filter(F.col("n") > above)
