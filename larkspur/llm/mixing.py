"""Mixing sources to target weights by blocks of words.

The texts of a source, in a fixed order, form one stream that is cut into blocks of
`BLOCK` words.  The blocks that a source gives in all follow from its target; how many of them
each output shard gets is drawn from a multinomial, source by source, so that every source ends
at its target and any task can draw its part.  The k-th draw of a source is slot k; slots map to blocks through pseudorandom
permutations of the source's block numbers, a fresh one for every pass over the
source, so no block is taken more than one time more often than another.  Joining the
slots to the texts' blocks by number gives what each text contributes.

Only one row per source (not per text) goes to the driver, which works out the targets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common

BLOCK = 64
SHARDS = 1024
SEED = 11
CAP = 3
WEIGHTS = (1, 2, 3)
#: Parts a source's stream is laid out in; a hot source is summed over as many groups.
PARTS = 1024
#: Draws of a source that one task maps to blocks, about; copies of a row that one task unfolds.
RANGE_DRAWS, COPIES = 50_000, 1024
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> list[float]:
    """Words wanted of each source: shares of the whole by weight, at most cap times its size.

    What a capped source cannot give is shared among the others by weight, until none is above.
    """
    share = np.array([weights[i % len(weights)] for i in range(len(sizes))], dtype=np.float64)
    most = cap * np.array(sizes, dtype=np.float64)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), float(sum(sizes))
    while free.any():
        want = left * share / share[free].sum()
        over = free & (want > most)
        if not over.any():
            out[free] = want[free]
            break
        out[over] = most[over]
        left -= most[over].sum()
        free &= ~over
    return out.tolist()


def shard_counts(draws: int, source_no: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Blocks of one source that each output shard takes: a multinomial that adds up to `draws`.

    It depends on the seed and the source only, so any task can work out its part of it.
    """
    rng = np.random.default_rng((seed, source_no))
    return rng.multinomial(draws, np.full(shards, 1 / shards))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of [0, n): four Feistel rounds, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(xxhash.xxh64_intdigest(f"{key}:{r}")) for r in range(4)]
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            x = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(31)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (x >> np.uint64(40)) & mask
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def sized(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", mark: Column | None = None) -> DataFrame:
    """(key, mark, source, size) of each row; size is its number of words (null: 0), mark tells rows of one key apart."""
    mark = F.xxhash64(common.quoted(text)) if mark is None else mark
    size = F.coalesce(F.regexp_count(common.quoted(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    return df.select(common.quoted(key).alias("key"), mark.alias("mark"), common.quoted(source).cast("string").alias("source"), size)


class Mix:
    """The plan of one mix: per source its size, target and number of blocks and draws."""

    def __init__(self, totals: dict[str | None, int], block: int, seed: int, shards: int):
        self.names = sorted((s for s in totals if s is not None)) + ([None] if None in totals else [])
        self.sizes = [totals[s] for s in self.names]
        self.targets = targets(self.sizes)
        self.blocks = [-(-n // block) for n in self.sizes]
        self.draws = [min(CAP * b, round(b * t / n)) if n else 0 for b, t, n in zip(self.blocks, self.targets, self.sizes, strict=True)]
        self.block, self.seed, self.shards = block, seed, shards

    def slots(self, spark) -> DataFrame:
        """(shard, source_no, slot, block): one row for each block taken.

        Work is dealt by (source, range of shards): a source of many draws has many ranges.
        """
        shards, seed = self.shards, self.seed
        work = [
            (no, blocks, draws, first, min(first + step, shards))
            for no, (blocks, draws) in enumerate(zip(self.blocks, self.draws, strict=True)) if draws
            for step in (-(-shards // max(1, min(shards, draws // RANGE_DRAWS))),)
            for first in range(0, shards, step)
        ]
        names = ["shard", "source_no", "slot", "block"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for no, blocks, draws, first, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    counts = shard_counts(draws, no, shards, seed)
                    start = int(counts[:first].sum())
                    shard = np.repeat(np.arange(first, end), counts[first:end])
                    for a in range(0, len(shard), 1 << 18):
                        own = shard[a : a + (1 << 18)]
                        slot = np.arange(start + a, start + a + len(own))
                        turn, at = slot // blocks, slot % blocks
                        block = np.concatenate([permuted(at[turn == e], blocks, xxhash.xxh64_intdigest(f"{seed}:{no}:{e}")) for e in np.unique(turn).tolist()])
                        cols = [own, np.full(len(slot), no, np.int32), slot, block]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

        todo = spark.createDataFrame(work, "source_no int, blocks long, draws long, first int, end int")
        return todo.repartition(max(1, min(len(work), sum(self.draws) // RANGE_DRAWS)), "source_no", "first").mapInArrow(run, "shard long, source_no int, slot long, block long")

    def table(self, spark) -> DataFrame:
        rows = [(i, s, n, float(t)) for i, (s, n, t) in enumerate(zip(self.names, self.sizes, self.targets, strict=True))]
        return spark.createDataFrame(rows, "source_no int, name string, source_size long, target double")


def laid_out(rows: DataFrame, block: int = BLOCK, seed: int = SEED, shards: int = SHARDS) -> tuple[DataFrame, Mix]:
    """Rows of `sized` with source_no, source_size, target and `start`, their place in the stream.

    Repeated rows are counted before anything else, so a group of copies is one row of the
    layout; they get their places one behind the other afterwards.  The order of a stream is
    by part (a hash of key and mark), key, mark and size.
    """
    spark = rows.sparkSession
    counted = rows.groupBy("key", "mark", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    counted = common.stored(counted.withColumn("part", F.pmod(F.xxhash64("key", "mark"), F.lit(PARTS)).cast("int")), "sizes")
    words = F.col("size") * F.col("n")
    sums = counted.groupBy("source", "part").agg(F.sum(words).alias("words"))
    totals = sums.groupBy("source").agg(F.sum("words").alias("words")).toArrow().to_pydict()
    mix = Mix(dict(zip(totals["source"], totals["words"], strict=True)), block, seed, shards)
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("base", F.coalesce(F.sum("words").over(order), F.lit(0))).select(F.col("source").alias("s"), F.col("part").alias("p"), "base")
    inside = Window.partitionBy("source", "part").orderBy("key", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    placed = placed.join(base, placed.source.eqNullSafe(base.s) & (placed.part == base.p))
    placed = placed.select("key", "mark", "source", "size", "n", (F.col("base") + F.col("before")).alias("start"))
    named = mix.table(spark)
    return _each_copy(placed.join(named, placed.source.eqNullSafe(named.name)).drop("name")), mix


def _each_copy(placed: DataFrame) -> DataFrame:
    """A row per copy, with the copy's own place; many copies are dealt out before they unfold."""
    single = placed.where("n = 1").withColumn("copy", F.lit(0).cast("long"))
    some = placed.where("n > 1").withColumn("some", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))))
    some = some.repartition("key", "mark", "some")
    last = F.least(F.col("n") - 1, F.col("some") * COPIES + COPIES - 1)
    each = some.withColumn("copy", F.explode(F.sequence(F.col("some") * COPIES, last))).drop("some")
    return single.unionByName(each).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))


def _pieces(placed: DataFrame, mix: Mix) -> DataFrame:
    """Each copy's stretches by block, with the times the block is taken: a, b are word places.

    Both sides are as large as the corpus' blocks, so they are merged, whatever their size.
    """
    block = mix.block
    end = F.col("start") + F.col("size")
    cut = placed.where("size > 0").select("key", "mark", "source_no", "start", "size", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    times = mix.slots(placed.sparkSession).groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
    joined = cut.join(times.hint("merge"), ["source_no", "block"])
    a = F.greatest("start", F.col("block") * block) - F.col("start")
    b = F.least(end, (F.col("block") + 1) * block) - F.col("start")
    return joined.withColumn("a", a).withColumn("b", b)


def taken(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, seed: int = SEED, shards: int = SHARDS) -> DataFrame:
    """Per row of `df`: key, size, source, source_size, target and taken (words the mix has of it).

    Sources are ordered by code point, null last, and weigh 1, 2, 3, 1, ...  A null or empty
    text has size 0 and nothing is taken of it.  Repeated rows and keys keep their rows; which
    of several equal rows has which words does not matter.
    """
    placed, mix = laid_out(sized(df, key, text, source), block, seed, shards)
    placed = common.stored(placed, "streams")
    sums = _pieces(placed, mix).groupBy("source_no", "start").agg(F.sum((F.col("b") - F.col("a")) * F.col("times")).alias("got"))
    full = placed.where("size > 0").join(sums, ["source_no", "start"], "left")
    rows = full.unionByName(placed.where("size = 0").withColumn("got", F.lit(0).cast("long")))
    return rows.select(F.col("key").alias(key), "size", "source", "source_size", "target", F.coalesce("got", F.lit(0)).alias("taken"))


def mixed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, seed: int = SEED, shards: int = SHARDS) -> DataFrame:
    """The mixed corpus with the columns of `df`.

    A row comes out up to `CAP` times: its n-th copy holds the words whose block is taken n
    times or more.  A copy that holds all words keeps the text as it is, another joins
    its words by one space; a copy without words does not appear, so rows with null, empty or
    wordless texts go.  Repeated rows are rows of their own; rows are repeated if they agree in the
    key and in the hash of all columns.  Columns of any name are kept.
    """
    mark = common.unused(df, "mark")
    own = df.withColumn(mark, F.xxhash64(*(common.quoted(c) for c in df.columns)))
    placed, mix = laid_out(sized(own, key, text, source, F.col(mark)), block, seed, shards)
    placed = common.stored(placed, "streams")
    parts = _pieces(placed, mix).groupBy("source_no", "start", "key", "mark").agg(F.collect_list(F.struct("a", "b", "times")).alias("parts"))
    lists = parts.select(F.col("key").alias("_key"), F.col("mark").alias("_mark"), "parts")
    repeated = placed.where("copy = 1").select(F.col("key").alias("_key"), F.col("mark").alias("_mark")).distinct()
    others = [c for c in df.columns if c != text]
    packed = own.select(common.quoted(key).alias("own_key"), F.col(mark).alias("own_mark"), common.quoted(text).alias("own_text"), F.struct(F.lit(True), *(common.quoted(c) for c in others)).alias("others"))
    met = packed.own_key.eqNullSafe(repeated["_key"]) & (packed.own_mark == repeated["_mark"])
    once = packed.join(repeated, met, "left_anti").unionByName(packed.join(repeated, met, "left_semi").dropDuplicates(["own_key", "own_mark"]))
    joined = once.join(lists, once.own_key.eqNullSafe(lists["_key"]) & (once.own_mark == lists["_mark"])).select("own_text", "others", "parts")

    def make():
        def work(texts: pa.Array, parts: pa.Array) -> list[pa.Array]:
            out = []
            for t, p in zip(texts, parts, strict=True):
                t = t.as_py() or ""
                found = common.words(t.encode())
                times = np.zeros(len(found), dtype=np.int64)
                for x in p.as_py():
                    times[x["a"] : x["b"]] = x["times"]
                copies = []
                for n in range(1, int(times.max(initial=0)) + 1):
                    at = np.flatnonzero(times >= n)
                    copies.append(t if len(at) == len(found) else b" ".join([found[i] for i in at.tolist()]).decode())
                out.append(copies)
            return [pa.array(out, pa.list_(pa.string()))]

        return work

    many = common.add_columns(joined, ["own_text", "parts"], [("copies", T.ArrayType(T.StringType()))], make)
    done = many.select("others", F.explode("copies").alias("copy"))
    return done.select(*(F.col("copy").alias(c) if c == text else F.col("others").getField(c).alias(c) for c in df.columns))
