"""SpotSigs document fingerprints.

Each common word of a text is an anchor; the chain of the next `CHAIN` content words behind
it is a signature.  A fingerprint is the set of a text's signatures, written as sorted
hashes.  Two sets can only be alike in t parts if their lengths are, so sets fall
into length partitions and only sets of near partitions are compared; the Jaccard
comparison itself stops once too many hashes of the shorter side have missed.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common

CHAIN = 2
#: Frequent function words of English, French, German and Spanish.
COMMON = frozenset(
    """
    a an and are as at be by for from has he in is it of on or that the this to was were which with
    au avec ce dans de des du elle en est et il la le les ou par pas pour que qui sur un une
    auf aus bei das dem den der die ein eine er es ist mit nicht sich sie sind und von zu
    al con del el ella lo los las más no por se su sus una y
    """.split()
)
_TOKEN = re.compile(r"[^\W_]+")


def signatures(text: str, chain: int = CHAIN, common_words: frozenset[str] = COMMON) -> set[int]:
    """32-bit hashes of the text's chains.

    A text in which no chain is complete is described by its single words; one without
    words has the empty set.
    """
    found = _TOKEN.findall(text.lower())
    out: set[int] = set()
    behind: list[str] = [""] * chain
    seen = 0
    for w in reversed(found):
        if w in common_words:
            if seen >= chain:
                out.add(xxhash.xxh32_intdigest(" ".join([w, *behind])))
        else:
            behind = [w, *behind[:-1]]
            seen += 1
    return out or {xxhash.xxh32_intdigest(w) for w in found}


def written(found: set[int]) -> str:
    """A set as text: its sorted hashes, eight hex digits each."""
    return np.sort(np.fromiter(found, dtype=">u4", count=len(found))).tobytes().hex()


def length_partition(size: int, threshold: float) -> int:
    """Sets whose partitions differ by more than one cannot reach the threshold."""
    return -1 if size == 0 else int(math.log(size) / -math.log(threshold)) if threshold < 1 else size


def likeness(a: set[int], b: set[int], threshold: float = 0.0) -> float:
    """Jaccard likeness of two sets; 0 as soon as it cannot reach the threshold.

    Two empty sets are alike (1), an empty and another one are not (0).
    """
    if not a or not b:
        return float(not a and not b)
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if threshold > 0:
        if threshold < 1 and abs(length_partition(len(small), threshold) - length_partition(len(large), threshold)) > 1:
            return 0.0
        misses = len(small) - math.ceil(threshold * (len(small) + len(large)) / (1 + threshold) - 1e-9)
        if misses < 0:
            return 0.0
        for h in small:
            if h not in large:
                misses -= 1
                if misses < 0:
                    return 0.0
    shared = len(small & large)
    return shared / (len(a) + len(b) - shared)


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """`df` with the fingerprint of `text` (null counts as empty)."""

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([written(signatures(t or "")) for t in texts.to_pylist()], pa.string())]

        return work

    return common.add_columns(df, [text], [(out, T.StringType())], make)


def read(fingerprint: str) -> set[int]:
    return set(np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4").tolist())


def compared(df: DataFrame, left: str, right: str, threshold: float = 0.0, out: str = "likeness") -> DataFrame:
    """`df` with the likeness of two fingerprint columns, 0 below the threshold."""

    def make():
        def work(a: pa.Array, b: pa.Array) -> list[pa.Array]:
            pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
            got = [likeness(read(x or ""), read(y or ""), threshold) for x, y in pairs]
            return [pa.array([g if g >= threshold else 0.0 for g in got], pa.float64())]

        return work

    return common.add_columns(df, [left, right], [(out, T.DoubleType())], make)


def edited_text(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the start of the following one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against its edited form and the following text, by descending key.

    After the last text comes the first again.  Null texts count as empty, null keys
    come last, rows with one key follow each other by text.  Rows are dealt out in key
    ranges; the first rows of a range are lent to the range before it, so neighbours
    meet without a sort in one task.
    """
    spark = df.sparkSession
    ranges = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = df.select(common.quoted(key).cast("long").alias("doc"), F.coalesce(common.quoted(text), F.lit("")).alias("text"))
    ids = docs.select("doc")
    probs = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(ids.agg(F.percentile_approx("doc", probs, max(10_000, 10 * ranges))).first()[0] or []))
    tops = {r.at: r.top for r in ids.mapInArrow(_range_tops(cuts), "at int, top long").groupBy("at").agg(F.max("top").alias("top")).collect()}
    order = sorted(tops)
    # the top of each range follows the last row of the next higher one; the highest top follows the lowest
    lent: dict[int | None, list[int]] = {}
    for at, upper in zip(order, order[1:] + order[:1], strict=True):
        lent.setdefault(tops[at], []).append(upper)
    dealt = docs.mapInArrow(_deal(cuts, lent), "at int, lent boolean, doc long, text string")
    sorted_rows = dealt.repartition("at").sortWithinPartitions("at", "lent", F.col("doc").desc_nulls_last(), "text")
    schema = f"`{key}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sorted_rows.mapInArrow(_compare_neighbours(key), schema)


def _at(doc: int | None, cuts: list[int]) -> int:
    return -1 if doc is None else bisect.bisect_right(cuts, doc)


def _range_tops(cuts: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, int | None] = {}
        for batch in batches:
            for doc in batch.column(0).to_pylist():
                at = _at(doc, cuts)
                tops[at] = doc if doc is None else max(doc, tops.get(at, doc))
        yield pa.RecordBatch.from_arrays([pa.array(list(tops), pa.int32()), pa.array(list(tops.values()), pa.int64())], names=["at", "top"])

    return run


def _deal(cuts: list[int], lent: dict[int | None, list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_pylist()
            rows, at, flag = [], [], []
            for i, doc in enumerate(docs):
                for n, place in enumerate([_at(doc, cuts), *lent.get(doc, ())]):
                    rows.append(i)
                    at.append(place)
                    flag.append(n > 0)
            took = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(flag), batch.column(0).take(took), batch.column(1).take(took)], names=["at", "lent", "doc", "text"])

    return run


def _compare_neighbours(key: str):
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (range, doc, text, signatures) of the row whose follower comes next
        for batch in batches:
            out, chars = [], 0
            for at, borrowed, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if waiting is None and borrowed:
                    continue
                own = signatures(text)
                if waiting is not None:
                    out.append(_row(waiting, text, own))
                    chars += len(out[-1][3]) + len(out[-1][4])
                waiting = None if borrowed else (at, doc, text, own)
                if chars > 8_000_000:
                    yield _rows(out, kinds, names)
                    out, chars = [], 0
            if out:
                yield _rows(out, kinds, names)

    return run


def _row(waiting: tuple, following: str, next_signatures: set[int]) -> tuple:
    _, doc, text, own = waiting
    new = edited_text(text, following)
    changed = own if new == text else signatures(new)
    digest = hashlib.sha256(new.encode()).hexdigest()
    return doc, len(text), digest, written(own), written(changed), likeness(own, changed), likeness(own, next_signatures)


def _rows(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
