"""Conversation prefix trie from vertical bitmaps.

Conversations are dealt into shards by ranges of their id.  A shard indexes (place, turn) to a bitset of
its conversations and grows its part of the trie depth first: a node's bitset, intersected with the
postings of the next place, gives its children, popcounts give their sizes, and the bitset of
conversations that end there gives the end list.  Nodes of different shards are the same node if their
chained SHA-256 over the turns is the same; their parts are then added up.

Long conversations are cut into bands of BAND places and each band is sharded on its own, so no task
holds a whole long conversation.  A band starts from the key of the prefix before it; these keys are
chained from one digest per band.  Sums over subtrees come from each node's owner, its smallest member:
a node's weight is added in the one shard that holds the owner, summed over the shard's part of the
tree, and passed up from band to band through the key of the band's first prefix.

Only digests, byte counts and ids move; texts stay where they are read.

Defined cases: null and empty roles and texts are the same; null turns come first; turns that tie are
ordered by role, then by the SHA-256 of role and text; repeated rows are repeated turns; rows with a
null conv_id belong to no conversation and are left out; an empty table has no trie and gives no rows;
texts of any length count by digest and bytes; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common
from larkspur.llm.turns import batched, rows_of

#: Places of a conversation that one shard holds.
BAND = 256
#: Most conversations and, about, most turns of a shard.
SHARD_CONVERSATIONS = 1024
SHARD_TURNS = 1 << 16
#: Key of the root.
ROOT = hashlib.sha256(b"").digest()
#: Turns at most that a rebuilt conversation takes from another, ids that share one, hash values.
HEAD, FAMILY = 8, 5


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


_LONG, _BYTES = T.LongType(), T.BinaryType()


def numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, place, mark, n_bytes) of (conv_id, turn, role, text), (conv_id, n) per conversation).

    Ranges of (conversation, turn) are counted task by task, so one conversation may fill many tasks;
    what a task adds to the places of its first conversation is a table of one row per task.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    light = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), mark.alias("mark"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]
    placed = light.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "mark", "n_bytes")
    schema = T.StructType([*placed.schema.fields, _field("part", _LONG), _field("local", _LONG)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            counted = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
            if own[0] == current:
                counted[: starts[1] if len(starts) > 1 else len(own)] += done
            current, done = own[-1], int(counted[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(len(own), part, np.int64)), pa.array(counted.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    counted = common.stored(placed.mapInArrow(count, schema), "turns")
    parts = counted.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("offset", F.sum("n").over(before)).where(F.col("offset") > 0).select("conv_id", "part", "offset")
    place = F.col("local") + F.coalesce("offset", F.lit(0))
    found = counted.join(F.broadcast(offsets), ["conv_id", "part"], "left").select("conv_id", place.alias("place"), "mark", "n_bytes")
    return found, parts.groupBy("conv_id").agg(F.sum("n").alias("n"))


def plain(rows: DataFrame) -> DataFrame:
    """Places of the conversations as they are: input of `trie`."""
    found, sizes = numbered(rows)
    return found.join(sizes, "conv_id").withColumnRenamed("n", "length")


def rebuilt(rows: DataFrame) -> DataFrame:
    """Places of rebuilt conversations: the first h turns of conversation c - c % 5, then the own ones behind the
    first h, where h is the CRC of the decimal c modulo 9.  One without turns has a single row at place -1."""
    found, sizes = numbered(rows)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    turn = F.struct("place", "mark", "n_bytes")
    heads = found.where((F.col("place") < HEAD) & (F.col("conv_id") % FAMILY == 0))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("head"))
    plan = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")).join(heads, "base", "left")
    taken = F.when(F.col("head").isNull(), F.array().cast(heads.schema["head"].dataType)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    plan = plan.select("conv_id", "n", "h", taken.alias("taken"))
    plan = plan.withColumn("length", F.size("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = found.join(plan.select("conv_id", "h", F.size("taken").alias("m"), "length"), "conv_id").where(F.col("place") >= F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("place"), "mark", "n_bytes", "length")
    first = plan.select("conv_id", "length", F.explode("taken").alias("t")).select("conv_id", "t.place", "t.mark", "t.n_bytes", "length")
    none = plan.where(F.col("length") == 0).select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("binary").alias("mark"), F.lit(0).cast("long").alias("n_bytes"), "length")
    return own.unionByName(first).unionByName(none)


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()


def _prefixes(places: DataFrame, width: int) -> DataFrame:
    """(conv_id, band, prefix) for every band but the first: the key of the places before it."""
    banded = places.where((F.col("length") > width) & (F.col("place") < F.floor((F.col("length") - 1) / width) * width))
    banded = banded.select("conv_id", F.floor(F.col("place") / width).alias("band"), "place", "mark")
    folded = T.StructType([_field("conv_id", _LONG), _field("band", _LONG), _field("chain", _BYTES)])
    keyed = T.StructType([_field("conv_id", _LONG), _field("band", _LONG), _field("prefix", _BYTES)])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own() -> Iterator[tuple]:
            at, chain = None, b""
            for conv, band, mark in rows_of(batches):
                if at != (conv, band):
                    if at:
                        yield (*at, chain)
                    at, chain = (conv, band), b""
                chain = _digest(chain, mark)
            if at:
                yield (*at, chain)

        return batched(own(), folded)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own() -> Iterator[tuple]:
            current, key = None, ROOT
            for conv, band, chain in rows_of(batches):
                key = _digest(ROOT if conv != current else key, chain)
                current = conv
                yield conv, band + 1, key

        return batched(own(), keyed)

    dealt = banded.repartitionByRange("conv_id", "band").sortWithinPartitions("conv_id", "band", "place").drop("place")
    chains = dealt.mapInArrow(fold, folded).repartition("conv_id").sortWithinPartitions("conv_id", "band")
    return common.stored(chains.mapInArrow(chained, keyed), "band-prefixes")


NODE = T.StructType(
    [
        _field("shard", _LONG),
        _field("nth", _LONG),
        _field("key", _BYTES),
        _field("parent", _BYTES),
        _field("depth", _LONG),
        _field("n_convs", _LONG),
        _field("low", _LONG),
        _field("n_bytes", _LONG),
        _field("first_end", _LONG),
        _field("ends", T.StringType()),
    ]
)


class Shard:
    """Conversations of one band, in ascending order of id, indexed by (place, turn)."""

    def __init__(self, band: int, width: int):
        self.start, self.width = band * width, width
        self.ids: list[int] = []
        self.turns: list[list[tuple[bytes, int]]] = []
        self.lengths: list[int] = []
        self.prefixes: list[bytes] = []
        self.n_turns = 0

    def add(self, conv: int, mark: bytes | None, n_bytes: int, length: int, prefix: bytes) -> None:
        if not self.ids or self.ids[-1] != conv:
            self.ids.append(conv)
            self.turns.append([])
            self.lengths.append(length)
            self.prefixes.append(prefix)
        if mark is not None:
            self.turns[-1].append((mark, n_bytes))
            self.n_turns += 1

    def nodes(self) -> Iterator[tuple]:
        """Nodes in preorder: (key, parent, depth, members, smallest, bytes, smallest end, ends)."""
        postings: dict[tuple[int, bytes], int] = defaultdict(int)
        more, ends, roots = defaultdict(int), defaultdict(int), defaultdict(int)
        for i, own in enumerate(self.turns):
            bit = 1 << i
            for j, (mark, _) in enumerate(own):
                postings[j, mark] |= bit
                more[j] |= bit
            if self.lengths[i] <= self.start + self.width:
                ends[len(own)] |= bit
            roots[self.prefixes[i]] |= bit
        for prefix, members in roots.items():
            if not self.start:
                yield self._row(ROOT, None, 0, members, 0, members & ends[0])
            stack = self._children(prefix, b"", 0, members, prefix, postings, more)
            while stack:
                key, parent, chain, depth, members, n_bytes = stack.pop()
                yield self._row(key, parent, self.start + depth, members, n_bytes, members & ends[depth])
                stack += self._children(key, chain, depth, members, prefix, postings, more)

    def _children(self, key, chain, depth, members, prefix, postings, more) -> list[tuple]:
        """Intersections of a node's bitset with the postings that meet it."""
        left, found = members & more[depth], []
        while left:
            mark, n_bytes = self.turns[(left & -left).bit_length() - 1][depth]
            child = members & postings[depth, mark]
            below = _digest(chain, mark)
            found.append((_digest(prefix, below), key, below, depth + 1, child, n_bytes))
            left ^= child
        return found

    def _row(self, key, parent, depth, members, n_bytes, ends) -> tuple:
        listed = []
        while ends:
            low = ends & -ends
            listed.append(self.ids[low.bit_length() - 1])
            ends ^= low
        low = self.ids[(members & -members).bit_length() - 1]
        return (key, parent, depth, members.bit_count(), low, n_bytes, listed[0] if listed else None, ",".join(map(str, listed)) if listed else None)


def _sharded(places: DataFrame, prefixes: DataFrame, width: int, conversations: int) -> DataFrame:
    band = F.greatest(F.floor(F.col("place") / width), F.lit(0)).cast("long")
    root = F.lit(ROOT)
    keyed = places.select("conv_id", "place", "mark", "n_bytes", "length", band.alias("band"))
    later = keyed.where(F.col("band") > 0).join(prefixes, ["conv_id", "band"]).select(*keyed.columns, "prefix")
    rows = keyed.where(F.col("band") == 0).withColumn("prefix", root).unionByName(later)
    order = ["band", "conv_id", "place"]
    dealt = rows.repartitionByRange("band", "conv_id").sortWithinPartitions(*order)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def own() -> Iterator[tuple]:
            shard, at, seq = None, None, 0
            for conv, mark, n_bytes, length, its_band, prefix in rows_of(batches):
                full = shard and conv != shard.ids[-1] and (len(shard.ids) >= conversations or shard.n_turns >= SHARD_TURNS)
                if shard and (its_band != at or full):
                    yield from ((part << 32 | seq, i, *node) for i, node in enumerate(shard.nodes()))
                    shard, seq = None, seq + 1
                if shard is None:
                    shard, at = Shard(its_band, width), its_band
                shard.add(conv, mark, n_bytes, length, prefix)
            if shard:
                yield from ((part << 32 | seq, i, *node) for i, node in enumerate(shard.nodes()))

        return batched(own(), NODE)

    wanted = dealt.select("conv_id", "mark", "n_bytes", "length", "band", "prefix")
    return common.stored(wanted.mapInArrow(grow, NODE), "trie-shards")


_SUMS = T.StructType([_field("key", _BYTES), _field("saved", _LONG), _field("leaves", _LONG)])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of shards in reverse preorder -> sums over their part of the subtree."""

    def own() -> Iterator[tuple]:
        current, open_ = None, {}
        for shard, key, depth, saved, leaves in rows_of(batches):
            if shard != current:
                current, open_ = shard, {}
            below = open_.pop(depth + 1, (0, 0))
            saved, leaves = saved + below[0], leaves + below[1]
            beside = open_.get(depth, (0, 0))
            open_[depth] = (beside[0] + saved, beside[1] + leaves)
            if saved or leaves:
                yield key, saved, leaves

    return batched(own(), _SUMS)


_ENDS = T.StructType([_field("key", _BYTES), _field("ends_sha256", T.StringType())])


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """End lists sorted by (node, smallest id) -> one digest per node, streamed."""

    def own() -> Iterator[tuple]:
        current, digest = None, None
        for key, ends in rows_of(batches):
            if key == current:
                digest.update(b",")
            else:
                if digest:
                    yield current, digest.hexdigest()
                current, digest = key, hashlib.sha256()
            digest.update(ends.encode())
        if digest:
            yield current, digest.hexdigest()

    return batched(own(), _ENDS)


def _below(nodes: DataFrame, prefixes: DataFrame, width: int) -> DataFrame:
    """(key, below_saved, below_leaves): what the owners of later bands' nodes pass up to a band's last prefix."""
    owned = nodes.where(F.col("depth") > width).groupBy("conv_id", F.floor((F.col("depth") - 1) / width).alias("band"))
    owned = owned.agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    passed = prefixes.join(owned, ["conv_id", "band"], "left").select(
        F.col("prefix").alias("key"), F.sum("weight").over(later).alias("weight"), F.sum("leaf").over(later).alias("leaf")
    )
    return passed.groupBy("key").agg(F.sum("weight").alias("below_saved"), F.sum("leaf").alias("below_leaves"))


def _or(name: str, value) -> Column:
    return F.coalesce(F.col(name), F.lit(value))


def trie(places: DataFrame, width: int = BAND, conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """Nodes of the trie of (conv_id, place, mark, n_bytes, length): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  A conversation without turns has a row at place -1."""
    places = common.stored(places, "trie-places")
    prefixes = _prefixes(places, width)
    shards = _sharded(places, prefixes, width, conversations)
    merged = shards.groupBy("key").agg(
        F.first("parent", ignorenulls=True).alias("parent"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.min("low").alias("conv_id"), F.max("n_bytes").alias("n_bytes"),
    )
    merged = common.stored(merged, "trie-nodes")
    children = merged.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = merged.join(children, "key", "left").withColumn("n_children", _or("n_children", 0))
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("n_bytes")).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    nodes = nodes.join(_below(nodes, prefixes, width), "key", "left")
    own = nodes.select("key", "conv_id", (F.col("weight") + _or("below_saved", 0)).alias("weight"), (F.col("leaf") + _or("below_leaves", 0)).alias("leaf"))
    held = F.col("low") == F.col("conv_id")
    weighed = shards.join(own, "key").select(
        "shard", "nth", "key", "depth", F.when(held, F.col("weight")).otherwise(0).alias("weight"), F.when(held, F.col("leaf")).otherwise(0).alias("leaf")
    )
    ordered = weighed.repartition("shard").sortWithinPartitions("shard", F.desc("nth")).select("shard", "key", "depth", "weight", "leaf")
    sums = ordered.mapInArrow(_subtrees, _SUMS).groupBy("key").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    ends = shards.where(F.col("ends").isNotNull()).select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    digests = ends.select("key", "ends").mapInArrow(_end_digests, _ENDS)
    parents = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, "key", "left").join(digests, "key", "left").join(parents, "parent", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", _or("n_leaves", 0).alias("n_leaves"),
        _or("saved_tokens", 0).alias("saved_tokens"), _or("ends_sha256", hashlib.sha256(b"").hexdigest()).alias("ends_sha256"),
    )
