"""SimHash near-duplicates with pigeonring candidate filtering.

A 64-bit fingerprint is cut into `SEGMENTS` consecutive segments on a ring.  If two
fingerprints differ in at most `bits` bits, then by the pigeonring principle there is a
start from which every chain of l segments differs in at most l * bits / SEGMENTS bits.
While that budget is below one the chain's segments are equal, so the first
`clean_run(bits)` segments form a join key; the longer chains prune what the key lets
through, and the full Hamming distance decides.

Equal fingerprints are one node, so copies cost nothing.  A key shared by more than
`CROWD` fingerprints is not compared pair by pair: its members are grouped by the
fingerprints one bit away (two within two bits of each other share one), which links
the same pairs with a bounded number of rows per fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common
from larkspur.llm.components import components

SEED = 42
SEGMENTS = 8
CROWD = 512
_BYTES_OF = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of the text's `width`-word shingles, repeats included; 0 for no words."""
    found = common.words(text.lower())  # of bytes: A-Z only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - width + 1)
    last = ends[-n:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)],
        dtype=np.uint64,
    )
    octets = hashes.view(np.uint8).reshape(n, 8).astype(np.int64) + np.arange(8) * 256
    seen = np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _BYTES_OF).ravel()  # bit i of octet j, little end first
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(df: DataFrame, text: str = "text", out: str = "simhash", width: int = 3) -> DataFrame:
    """`df` with the fingerprint of `text` as a signed 64-bit column.  Null texts count as empty."""

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            got = np.array([fingerprint(t, width) for t in common.as_bytes(texts)], dtype=np.uint64)
            return [pa.array(got.view(np.int64))]

        return work

    return common.add_columns(df, [text], [(out, T.LongType())], make)


def clean_run(bits: int, segments: int = SEGMENTS) -> int:
    """Longest chain whose whole budget stays below one differing bit."""
    return -(-segments // bits) - 1 if bits else segments


def links(prints: DataFrame, bits: int = 2, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b), a < b, whose components are those of all pairs within `bits` bits.

    `prints` has one long column `fp` of distinct values.
    """
    if not 0 <= bits <= 2 or 64 % segments or segments <= bits:
        raise ValueError("bits must be 0, 1 or 2; segments must divide 64")
    run, step = clean_run(bits, segments), 64 // segments
    keyed = prints.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(i).alias("start"), _chain(F.col("fp"), i, run, step).alias("key")) for i in range(segments)))).alias("at")
    ).select("fp", F.col("at.start").alias("start"), F.col("at.key").alias("key"))
    sizes = keyed.groupBy("start", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # three outcomes by the number of fingerprints behind a key: one is alone, few are
    # compared at once, a crowd is regrouped; only the few are ever gathered
    shared = keyed.join(sizes, ["start", "key"])
    few = shared.where(F.col("members") <= crowd).groupBy("start", "key").agg(F.collect_list("fp").alias("fps"))
    near = few.select("start", "fps").mapInArrow(_compare(bits, segments, step), "a long, b long")
    many = shared.where(F.col("members") > crowd).select("fp").distinct()
    return near.unionByName(_crowd_links(many, bits)).distinct()


def _chain(fp: Column, start: int, run: int, step: int) -> Column:
    """`run` segments from `start` on, as one number; the ring closes after the last."""
    turned = fp if not start else F.shiftleft(fp, start * step).bitwiseOR(F.shiftrightunsigned(fp, 64 - start * step))
    return turned if run * step == 64 else F.shiftrightunsigned(turned, 64 - run * step)


def _compare(bits: int, segments: int, step: int):
    """Pairs of a key's fingerprints that pass every chain budget and the Hamming check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for start, fps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.array(sorted(fps), dtype=np.int64)
                i, j = ring_pairs(own, start, bits, segments, step)
                a.append(own[i])
                b.append(own[j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def ring_pairs(own: np.ndarray, start: int, bits: int, segments: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j kept by the chain from `start` and then by the Hamming distance."""
    i, j = np.triu_indices(len(own), 1)
    diff = own.view(np.uint64)[i] ^ own.view(np.uint64)[j]
    total = np.zeros(len(diff), dtype=np.uint8)
    for length in range(1, segments + 1):
        shift = np.uint64(64 - step * ((start + length - 1) % segments + 1))
        total = total + np.bitwise_count((diff >> shift) & np.uint64((1 << step) - 1))
        keep = total <= length * bits // segments
        i, j, diff, total = i[keep], j[keep], diff[keep], total[keep]
    keep = np.bitwise_count(diff) <= bits
    return i[keep], j[keep]


def _crowd_links(prints: DataFrame, bits: int) -> DataFrame:
    """Edges inside crowds, with at most 65 rows for a fingerprint.

    Each is filed under itself and every value one flip away.  Two that are within two
    bits of one another share such a value, and any two under one value are within two
    bits: each group is linked as a star.  For one bit, the values that are
    fingerprints themselves are the neighbours; for none there are no pairs.
    """
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)))
    filed = prints.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    if bits == 2:
        heads = filed.groupBy("mid").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("mid", "a")
        return filed.join(heads, "mid").where("fp > a").select("a", F.col("fp").alias("b"))
    near = filed.join(prints.select(F.col("fp").alias("mid")), "mid") if bits else filed
    return near.where("fp < mid").where(F.lit(bits > 0)).select(F.col("fp").alias("a"), F.col("mid").alias("b"))


def grouped(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 2, width: int = 3) -> DataFrame:
    """One row per row of `df`: key, simhash (long), component_id.

    component_id is the smallest key reachable over links.  Null keys are linked
    like others but never name a component unless it holds nothing else (then null).
    Repeated rows and keys keep their rows.
    """
    slim = df.select(common.quoted(key).alias("key"), common.quoted(text).alias("text"))
    marked = common.stored(fingerprints(slim, "text", "simhash", width).select("key", "simhash"), "simhash")
    nodes = marked.groupBy(F.col("simhash").alias("fp")).agg(F.min("key").alias("least"))
    member = components(nodes.select("fp"), links(nodes.select("fp"), bits), "fp")
    named = member.join(nodes, "fp")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(roots, "root").select("fp", "component_id")
    return marked.join(of, marked.simhash == of.fp).select(F.col("key").alias(key), "simhash", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 2, width: int = 3) -> DataFrame:
    """The rows of `df` whose key is the smallest of its group; repeated rows of it count once.

    A group that only holds null keys keeps one row.  Rows are repeated if they agree in the key
    and in the hash of all columns.  Columns of any name are kept.
    """
    mark, kept_key, kept_mark = (common.unused(df, n) for n in ("row_mark", "kept_key", "kept_mark"))
    own = df.withColumn(mark, F.xxhash64(*(common.quoted(c) for c in df.columns)))
    slim = own.select(common.quoted(key).alias("key"), common.quoted(text).alias("text"), F.col(mark).alias("mark"))
    marked = common.stored(fingerprints(slim, "text", "simhash", width).select("key", "mark", "simhash"), "simhash")
    row = F.struct(F.col("key").isNull().alias("no_key"), "key", "mark")
    nodes = marked.groupBy(F.col("simhash").alias("fp")).agg(F.min(row).alias("least"))
    nodes = common.stored(nodes, "simhash-nodes")
    member = components(nodes.select("fp"), links(nodes.select("fp"), bits), "fp")
    kept = member.join(nodes, "fp").groupBy("root").agg(F.min("least").alias("least"))
    kept = kept.select(F.col("least.key").alias(kept_key), F.col("least.mark").alias(kept_mark))
    met = common.quoted(key).eqNullSafe(F.col(kept_key)) & (F.col(mark) == F.col(kept_mark))
    out = own.join(kept, met).drop(kept_key, kept_mark)
    # repeats of kept rows go; only rows known to repeat are shuffled for it
    many = marked.groupBy("key", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("mark").alias(kept_mark)).distinct()
    repeated = F.col(mark) == F.col(kept_mark)
    single = out.join(many, repeated, "left_anti")
    repeats = out.join(many, repeated, "left_semi").dropDuplicates([key, mark])
    return single.unionByName(repeats).drop(mark)
