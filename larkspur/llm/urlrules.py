"""URL filters by association rules.

URLs become sets of tokens: host labels, path parts and query keys.  FP-growth mines token
combinations of labelled pages; combinations that point to bad pages with enough support
and confidence are the rules, less those that a shorter rule already covers.  A URL
matches a rule if it has all its tokens: an inverted index from token to rules counts them.
Fixed (host, path) rules go before: the longest that fits decides alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common

SUPPORT, CONFIDENCE = 0.002, 0.8
#: Bad rows that a rule must hold on, however few rows there are.
LEAST_ROWS = 20
BAD, GOOD = "!bad", "!good"
ALLOW, BLOCK = "allow", "block"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")
_PART = re.compile(r"[^\W\d_]+")

Rule = tuple[str, str, str]  # verdict, host, path


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, rest): host behind the first `://`, A-Z lower-cased; all empty without one."""
    _, found, tail = (url or "").partition("://")
    if not found:
        return "", "", ""
    host = _HOST.match(tail).group()
    path = _PATH.match(tail, len(host)).group()
    return host.translate(_LOWER), path, tail[len(host) + len(path) :]


def tokens(url: str | None) -> list[str]:
    """Sorted tokens of a URL; numbers are left out, as they name single pages."""
    host, path, rest = split_url(url)
    out = {f"h:{x}" for x in host.split(".") if x}
    out |= {f"p:{x.lower()}" for x in _PART.findall(path)}
    out |= {f"q:{x.partition('=')[0]}" for x in re.split(r"[?&#]", rest) if x}
    return sorted(out)


def mine(labelled: DataFrame, url: str = "url", bad: str = "bad", support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST_ROWS) -> list[tuple[str, ...]]:
    """Token combinations that mark bad pages, from rows with a URL and a 0/1 label.

    A rule holds on at least `least` bad rows and at least the share `support` of all rows.  Single
    tokens are judged by counts; those that are rules take no part in combinations, which they would
    only repeat, nor do tokens that are too rare among bad rows.  Tokens that occur on exactly the
    same URLs (the query keys of one template) are mined as one of them, the least.  FP-growth then
    mines what is left, bad rows marked; confidences are joined and rules filtered in Spark, so the
    driver gets rules only.  Rows without a label or tokens teach nothing; without bad rows there
    are no rules; repeated rows count as often as they occur.
    """

    def make():
        def work(urls: pa.Array) -> list[pa.Array]:
            return [pa.array([tokens(u) for u in urls.to_pylist()], pa.list_(pa.string()))]

        return work

    known = labelled.select(common.quoted(url).alias("url"), common.quoted(bad).cast("int").alias("label")).where("label is not null")
    items = common.add_columns(known, ["url"], [("tokens", T.ArrayType(T.StringType()))], make).where("size(tokens) > 0")
    rows = common.stored(items.select(F.xxhash64("url").alias("page"), F.monotonically_increasing_id().alias("row"), (F.col("label") > 0).alias("bad"), "tokens"), "url-items")
    n = rows.count()
    need = max(least, math.ceil(support * n))
    single = rows.select("page", "row", "bad", F.explode("tokens").alias("token"))
    counts = single.groupBy("token").agg(
        F.count_if("bad").alias("n_bad"), F.count(F.lit(1)).alias("n"),
        F.bit_xor("page").alias("same"), F.sum(F.col("page").bitwiseAND(0xFFFFFFFF)).alias("alike"),
    )
    counts = common.stored(counts.where(F.col("n_bad") >= need), "url-tokens")
    sure = F.col("n_bad") >= confidence * F.col("n")
    found = [((r.token,), r.n_bad / r.n) for r in counts.where(sure).collect()]
    mixed = counts.where(~sure).groupBy("n_bad", "n", "same", "alike").agg(F.min("token").alias("token")).select("token")
    baskets = single.join(mixed, "token").groupBy("row").agg(F.collect_set("token").alias("tokens"), F.first("bad").alias("bad"))
    baskets = common.stored(baskets.select(F.when(F.col("bad"), F.array_append("tokens", BAD)).otherwise(F.col("tokens")).alias("items")), "url-baskets")
    left = baskets.count()
    if left:
        frequent = FPGrowth(itemsCol="items", minSupport=min(1.0, (need - 0.5) / left)).fit(baskets).freqItemsets
        frequent = common.stored(frequent.select(F.array_sort("items").alias("items"), "freq"), "url-itemsets")
        marked = frequent.where(F.array_contains("items", BAD) & (F.size("items") > 2))
        marked = marked.select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("n_bad"))
        confident = marked.join(frequent, "items").where(F.col("n_bad") >= confidence * F.col("freq"))
        found += [(tuple(r["items"]), r.n_bad / r.freq) for r in confident.collect()]
    return prune(found)


def tried(labelled: DataFrame, mined: list[tuple[str, ...]], url: str = "url", bad: str = "bad") -> DataFrame:
    """What mined rules do on labelled rows, best rows they were not mined from: n_rows, n_bad, n_matched, n_right."""
    judged = judge(labelled.where(common.quoted(bad).isNotNull()).select(common.quoted(url).alias("url"), (common.quoted(bad) > 0).alias("is_bad")), mined, [])
    hit = F.col("n_matched") > 0
    return judged.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_bad").alias("n_bad"), F.count_if(hit).alias("n_matched"), F.count_if(hit & F.col("is_bad")).alias("n_right")
    )


def prune(found: list[tuple[tuple[str, ...], float]]) -> list[tuple[str, ...]]:
    """Leave out rules that hold all tokens of a kept, shorter one: it matches wherever they do."""
    kept: list[frozenset[str]] = []
    for rule, _ in sorted(found, key=lambda r: (len(r[0]), r[0])):
        if not any(k <= set(rule) for k in kept):
            kept.append(frozenset(rule))
    return sorted(tuple(sorted(k)) for k in kept)


class Index:
    """Inverted index of mined rules."""

    def __init__(self, rules: list[tuple[str, ...]]):
        self.sizes = [len(r) for r in rules]
        self.of: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            for t in rule:
                self.of.setdefault(t, []).append(i)

    def matches(self, found: list[str]) -> list[int]:
        hits = Counter(i for t in found for i in self.of.get(t, ()))
        return sorted(i for i, n in hits.items() if n == self.sizes[i])


def fixed_rule(host: str, path: str, rules: list[Rule]) -> Rule | None:
    """The longest rule (host and path together) whose host is this one or above it and whose path starts this one."""
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: (len(r[1]) + len(r[2]), r)) if fits else None


def judge(df: DataFrame, mined: list[tuple[str, ...]], fixed: list[Rule], url: str = "url") -> DataFrame:
    """`df` with host, path, rule (the fixed rule as text, else null), n_matched and verdict.

    Without a fixed rule the verdict is block if a mined rule matches, else allow.  A URL that
    is null or has no `://` has an empty host and path, fits nothing and is allowed.
    """
    fields = [("host", T.StringType()), ("path", T.StringType()), ("rule", T.StringType()), ("n_matched", T.IntegerType()), ("verdict", T.StringType())]

    def make():
        index = Index(mined)

        def work(urls: pa.Array) -> list[pa.Array]:
            rows = []
            for u in urls.to_pylist():
                host, path, _ = split_url(u)
                own = fixed_rule(host, path, fixed)
                n = len(index.matches(tokens(u)))
                rows.append((host, path, own and own[1] + own[2], n, own[0] if own else BLOCK if n else ALLOW))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]
            return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]

        return work

    return common.add_columns(df, [url], fields, make)
