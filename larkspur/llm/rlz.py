"""Substring dedup by relative Lempel-Ziv parsing.

A window is `width` consecutive words.  Every window has an anchor: the least hashed
`ANCHOR`-word run in it, leftmost on ties, so equal windows have equal anchors.

1. Anchors are dealt out by their hash, each with its documents in order, and every later
   document learns the first document of each anchor it shares (its reference blocks).
   Anchors that very many documents share are spread over all tasks instead.
2. The passages around those anchors travel to the reference block, the whole first
   document, indexed by its anchor runs.  Each passage is factored greedily, left to right,
   into the longest runs of words that the block holds.  Factors of `width` words or
   more are duplicate spans; windows across a factor's end are tried at every other
   place of the block.
3. Windows that no factor covers though their anchor is shared (the first document holds the
   anchor in another context, so the parse of that one block cannot tell) are settled by
   their words: grouped over all documents, those with an earlier document are
   duplicates too.  This step is no parsing; it is small, a window of one in a thousand words.

A text that an earlier document holds as a whole is one factor: every word of it goes, if it has
a window at all, and it needs no parse.  Everything is compared word by word, or by SHA-256 for whole
texts; hashes of words only choose what is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common
from larkspur.llm.turns import batched, rows_of

WIDTH = 13
ANCHOR = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 28) - 1)
_LEVEL = 1
#: Words that a match compares at once; where the span of a whole text ends until its words are counted.
_MANY, WHOLE = 32, (1 << 31) - 1
#: One document in so many is looked at for hot anchors: those that so many of them share, at most this number.
SAMPLE, OFTEN, HOT_ANCHORS = 32, 8, 1 << 16
#: Bytes of a long text that are hashed at a time.
SLICE = 1 << 18
_SPACE = b" \t\n\v\f\r"


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word; long texts are worked on in slices cut at white space."""
    if len(text) <= 2 * SLICE:
        return _word_hashes(text)
    out, start = [], 0
    while start < len(text):
        end = start + SLICE
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        out.append(_word_hashes(text[start:end]))
        start = end
    return np.concatenate(out)


def _word_hashes(text: bytes) -> np.ndarray:
    """Hashes from one running polynomial sum over the bytes."""
    raw = np.frombuffer(text, dtype=np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _powers(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])))
    out = (sums[ends] - sums[starts]) * inverse[starts]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept for the longest text so far."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        base, back = np.uint64(0xD1342543DE82EF95), np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
        _POWERS[:] = [np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, x)))) for x in (base, back)]
    return _POWERS[0], _POWERS[1]


def run_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` words."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = values[:n].copy()
    for k in range(1, width):
        out *= _ODD
        out += values[k : k + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def least_runs(runs: np.ndarray, span: int) -> np.ndarray:
    """For every `span` consecutive runs the place of the least, leftmost on ties.

    A run's rank is the upper part of its hash with its place below, so that one minimum
    gives both; minima over spans of 1, 2, 4, ... are joined to the whole.
    """
    least = (runs & ~_PLACE) | np.arange(len(runs), dtype=np.uint64)
    have = 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least & _PLACE).astype(np.int64)


def anchors(values: np.ndarray, width: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, hashes, first windows) of the runs that are the anchor of some window.

    An anchor's windows follow one another; the next anchor's first window ends them.
    """
    runs = run_hashes(values, size)
    span = width - size + 1  # runs in a window
    if len(runs) < span:
        return np.zeros(0, dtype=np.int64), runs[:0], np.zeros(0, dtype=np.int64)
    at = least_runs(runs, span)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[first], runs[at[first]], first


def _emit_anchors(width: int, size: int, hot: np.ndarray | None = None):
    """(doc, text) -> (key, h, doc) of each distinct anchor; a hot one is keyed by itself and the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in common.sliced(whole, [1])):
            docs, hashes, counts = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), common.as_bytes(batch.column(1)), strict=True):
                own = np.unique(anchors(word_hashes(text), width, size)[1])
                docs.append(doc)
                hashes.append(own)
                counts.append(len(own))
            if sum(counts):
                h = np.concatenate(hashes)
                doc = np.repeat(np.array(docs, dtype=np.int64), counts)
                key = h
                if hot is not None and len(hot):
                    key = np.where(np.isin(h, hot), (h ^ doc.view(np.uint64)) * _ODD, h)
                yield from _slices([key.view(np.int64), h.view(np.int64), doc], ["key", "h", "doc"])

    return run


def _first_of_each(hot: np.ndarray):
    """(h, doc) sorted by key, h and doc -> (doc, first, h) of documents behind the first of their anchor.

    Hot anchors are spread over many tasks, so their rows pass with a null for the first document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_h, last_first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate(([last_h is None or h[0] != last_h], h[1:] != h[:-1]))
            starts = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
            first = np.where(starts >= 0, doc[starts], last_first if last_first is not None else 0)
            last_h, last_first = h[-1], first[-1]
            is_hot = np.isin(h.view(np.uint64), hot)
            keep = is_hot | (doc > first)
            if keep.any():
                firsts = pa.array(first[keep], mask=is_hot[keep])
                yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), firsts, pa.array(h[keep])], names=["doc", "first", "h"])

    return run


def _hot_anchors(docs: DataFrame, width: int, size: int) -> np.ndarray:
    """Anchors that many documents share, at most HOT_ANCHORS, judged by a sample of the documents.

    They are only dealt out differently; which anchors are found changes no result.
    """
    some = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0)
    counts = some.mapInArrow(_emit_anchors(width, size), _ANCHORS).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    often = counts.where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "h").limit(HOT_ANCHORS)
    return np.sort(np.array([r.h for r in often.collect()], dtype=np.int64).view(np.uint64))


_ANCHORS = "key long, h long, doc long"


def _routes(docs: DataFrame, width: int, size: int) -> DataFrame:
    """(doc, first, h): the first document of each anchor that a later document shares."""
    hot = _hot_anchors(docs, width, size)
    emitted = docs.mapInArrow(_emit_anchors(width, size, hot), _ANCHORS)
    dealt = emitted.repartition("key").sortWithinPartitions("key", "h", "doc").select("h", "doc")
    found = common.stored(dealt.mapInArrow(_first_of_each(hot), "doc long, first long, h long"), "routes")
    spread = found.where("first is null").drop("first")
    firsts = spread.groupBy("h").agg(F.min("doc").alias("first"))
    known = spread.join(F.broadcast(firsts), "h").where("doc > first").select("doc", "first", "h")
    return found.where("first is not null").unionByName(known)


def _slices(cols: list[np.ndarray], names: list[str], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(cols[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + rows]) for c in cols], names=names)


def passages(seeds: list[tuple], width: int) -> list[list]:
    """Word ranges [a, b) that hold all windows of some seeds, merged, each with its seeds.

    A seed is (place, hash, first window, behind the last window), in order of place.
    """
    out: list[list] = []
    for seed in seeds:
        a, b = seed[2], seed[3] - 1 + width
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
            out[-1][2].append(seed)
        else:
            out.append([a, b, [seed]])
    return out


_SEED = T.StructType([T.StructField(n, T.LongType()) for n in ("place", "h", "low", "high")])
_PART = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("words", T.StringType()), T.StructField("seeds", T.ArrayType(_SEED))])
_PASSAGES = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "doc", "mark")] + [T.StructField("parts", T.ArrayType(_PART))])


def _emit_passages(width: int, size: int):
    """(doc, mark, text, routes) -> a row per reference: the passages that may be in it, with their seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: list[int] = []

        def pairs() -> Iterator[tuple]:
            for doc, mark, text, routes in rows_of(batches):
                raw = unpack(text)
                found = common.words(raw)
                first_of = {r["h"]: r["first"] for r in routes}
                at, hashes, low = anchors(word_hashes(raw), width, size)
                high = np.append(low[1:], max(0, len(found) - width + 1))
                by: dict[int, list[tuple]] = {}
                for seed in zip(at.tolist(), hashes.view(np.int64).tolist(), low.tolist(), high.tolist(), strict=True):
                    if seed[1] in first_of:
                        by.setdefault(first_of[seed[1]], []).append(seed)
                for first, seeds in by.items():
                    parts = [(a, b" ".join(found[a:b]).decode(), own) for a, b, own in passages(seeds, width)]
                    sizes.append(sum(len(t) + 32 * len(own) for _, t, own in parts))
                    yield first, doc, mark, [{"start": a, "words": t, "seeds": [dict(zip(_SEED.names, x, strict=True)) for x in own]} for a, t, own in parts]

        def taken() -> Iterator[int]:
            while True:
                yield sizes.pop()

        return batched(pairs(), _PASSAGES, taken())

    return run


class Block:
    """A reference document, indexed by its anchors: equal windows have equal anchors at equal offsets."""

    def __init__(self, text: bytes, width: int, size: int):
        self.words, self.at = common.words(text), {}
        places, hashes, _ = anchors(word_hashes(text), width, size)
        for place, h in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
            own = self.at.setdefault(h, [])
            if not own or own[-1] != place:
                own.append(place)

    def match(self, part: list[bytes], p: int, q: int) -> tuple[int, int]:
        """Longest stretch of `part` around p that equals the block around q; many words are compared at once."""
        ref, a, b = self.words, 0, 0
        m, n = min(p, q), min(len(part) - p, len(ref) - q)
        while a + _MANY <= m and part[p - a - _MANY : p - a] == ref[q - a - _MANY : q - a]:
            a += _MANY
        while a < m and part[p - a - 1] == ref[q - a - 1]:
            a += 1
        while b + _MANY <= n and part[p + b : p + b + _MANY] == ref[q + b : q + b + _MANY]:
            b += _MANY
        while b < n and part[p + b] == ref[q + b]:
            b += 1
        return p - a, p + b


def factor(block: Block, part: list[bytes], seeds: list[tuple], width: int) -> tuple[list[tuple[int, int]], list[int]]:
    """(spans of `part` with `width` words or more that the block holds, windows no span covers).

    Greedy parsing from the left: the seed's longest factor is taken and the parse goes on behind
    it.  At a factor's end every seed with a window that reaches across is tried at all its places.
    """
    out: list[tuple[int, int]] = []
    left: list[int] = []
    at = (0, 0)  # the long factor that reaches furthest
    for p, h, low, high in seeds:
        end = high - 1 + width
        if at[0] <= low and end <= at[1]:
            continue  # all windows of this seed lie inside the factor
        near = [at]
        for q in block.at.get(h, ()):
            a, b = block.match(part, p, q)
            if b - a >= width and b > p:
                out.append((a, b))
                near.append((a, b))
                at = max(at, (a, b), key=lambda f: f[1])
                if a <= low and end <= b:
                    break
        else:
            left += [i for i in range(low, high) if not any(a <= i and i + width <= b for a, b in near)]
    return out, left


def _emit_spans(width: int, size: int):
    """(doc, mark, parts, reference) -> a row per pair: merged spans, and windows left to settle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple]:
            last, block = None, None
            for doc, mark, parts, ref, _ in rows_of(batches):
                if block is None or ref != last:
                    last, block = ref, Block(unpack(ref), width, size)
                spans, windows = [], []
                for one in parts:
                    start, part = one["start"], common.words(one["words"].encode())
                    seeds = [(x["place"] - start, x["h"], x["low"] - start, x["high"] - start) for x in one["seeds"]]
                    found, left = factor(block, part, seeds, width)
                    spans += [(start + a, start + b) for a, b in found]
                    windows += [{"a": start + i, "window": b" ".join(part[i : i + width]).decode()} for i in left]
                if spans or windows:
                    yield doc, mark, [{"a": a, "b": b} for a, b in _merged(spans)], windows

        return batched(pairs(), _FOUND)

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order; spans that touch stay apart only if a word lies between them."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPAN = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
_LEFT = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("window", T.StringType())])
_FOUND = T.StructType(
    [
        T.StructField("doc", T.LongType()),
        T.StructField("mark", T.LongType()),
        T.StructField("spans", T.ArrayType(_SPAN)),
        T.StructField("windows", T.ArrayType(_LEFT)),
    ]
)


def _copies(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """((doc, mark, spans) of whole texts that an earlier document holds too, documents with no other text).

    The span of a whole text ends at WHOLE; only texts with a window have one.
    """
    has_window = F.col("text").rlike(rf"^[ \t\n\x0B\f\r]*([^ \t\n\x0B\f\r]+[ \t\n\x0B\f\r]+){{{width - 1}}}[^ \t\n\x0B\f\r]")
    rows = common.stored(docs.select("doc", F.sha2("text", 256).alias("digest"), F.xxhash64("text").alias("mark"), has_window.alias("long")), "digests")
    firsts = rows.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("digest", "first")
    told = rows.join(firsts, "digest", "left").withColumn("copy", F.coalesce(F.col("doc") > F.col("first"), F.lit(False)))
    told = common.stored(told.select("doc", "mark", "long", "copy"), "copies")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.lit(WHOLE).alias("b")))
    spans = told.where("copy and long").select("doc", "mark", whole.alias("spans")).distinct()
    return spans, told.groupBy("doc").agg(F.bool_and("copy").alias("copy")).where("copy").select("doc")


def duplicate_spans(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, size: int = ANCHOR) -> DataFrame:
    """(doc, mark, spans): word spans [a, b) of each text that earlier documents hold.

    A document is earlier if its key is smaller.  `mark` is xxhash64 of the text and tells
    repeated keys apart; rows with equal keys do not count as earlier than one another.
    Null keys and null texts take no part.  `key` must be an integer column.
    """
    if not 0 < size < width:
        raise ValueError("the anchor must be shorter than the window")
    docs = df.select(common.quoted(key).cast("long").alias("doc"), common.quoted(text).alias("text")).where("doc is not null and text is not null")
    common.small_batches(df.sparkSession)
    copies, settled = _copies(docs, width)
    packed = _packed(docs)
    met = _routes(docs, width, size).join(settled, "doc", "left_anti")
    routes = met.groupBy("doc").agg(F.collect_list(F.struct("first", "h")).alias("routes"))
    later = packed.join(routes, "doc").select("doc", "mark", "text", "routes").mapInArrow(_emit_passages(width, size), _PASSAGES)
    # the same columns on both sides, so that the texts are dealt out once for both
    references = packed.select(F.col("doc").alias("ref"), F.col("mark").alias("ref_mark"), "text")
    pairs = later.join(references, later["first"] == F.col("ref")).select(later["doc"], later["mark"], "parts", "text", "ref_mark")
    found = common.stored(pairs.mapInArrow(_emit_spans(width, size), _FOUND), "factors")
    left = found.select("doc", "mark", F.inline("windows"))
    again = left.groupBy("window").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("window", "first")
    more = left.join(again, "window").where("doc > first").select("doc", "mark", F.array(F.struct("a", (F.col("a") + width).alias("b"))).alias("spans"))
    spans = found.where(F.size("spans") > 0).select("doc", "mark", "spans").unionByName(more).unionByName(copies)
    return spans.groupBy("doc", "mark").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))


def kept_words(found: list[bytes], spans: list[dict] | None) -> list[bytes]:
    if not spans:
        return found
    gone = np.zeros(len(found), dtype=bool)
    for s in spans:
        gone[s["a"] : s["b"]] = True
    return [found[i] for i in np.flatnonzero(~gone).tolist()]


def with_spans(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, size: int = ANCHOR, out: str = "spans") -> DataFrame:
    """`df` with the duplicate spans of each row (null: none).  Texts travel compressed.

    A column that bears the name `out` is replaced; other columns of any name are kept.
    """
    mark, packed, found_key, found_mark, found_spans = (common.unused(df, n) for n in ("mark", "packed", "doc", "found_mark", "found"))
    found = duplicate_spans(df, key, text, width, size).select(F.col("doc").alias(found_key), F.col("mark").alias(found_mark), F.col("spans").alias(found_spans))
    own = df.select(*(common.quoted(c) for c in df.columns if c.lower() != out.lower())).withColumn(mark, F.xxhash64(common.quoted(text)))
    slim = common.add_columns(own, [text], [(packed, T.BinaryType())], _packing)
    slim = slim.select(*(common.quoted(c) for c in slim.columns if c != text))
    met = (common.quoted(key).cast("long") == F.col(found_key)) & (F.col(mark) == F.col(found_mark))
    joined = slim.join(found, met, "left").withColumn(out, F.col(found_spans)).drop(found_key, found_mark, found_spans, mark)
    whole = common.add_columns(joined, [packed, out], [(text, T.StringType()), (out, T.ArrayType(_SPAN))], _unpacking).drop(packed)
    return whole.select(*(common.quoted(c) for c in df.columns if c.lower() != out.lower()), out)


def _packing() -> Callable:
    pack = zstandard.ZstdCompressor(level=_LEVEL).compress
    return lambda texts: [pa.array([None if t is None else pack(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())]


def _unpacking() -> Callable:
    """Texts again, and spans that hold a whole text cut at its last word."""

    def ended(found: list[dict] | None, text: bytes | None) -> list[dict] | None:
        if not found or all(s["b"] < WHOLE for s in found):
            return found
        return [{"a": 0, "b": len(common.words(text))}]

    def work(packed: pa.Array, spans: pa.Array) -> list[pa.Array]:
        texts = [None if p is None else unpack(p) for p in packed.to_pylist()]
        cut = [ended(f, t) for f, t in zip(spans.to_pylist(), texts, strict=True)]
        return [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(cut, spans.type)]

    return work


def unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, mark, text) with the text compressed, for the two joins that move texts."""
    marked = docs.withColumn("mark", F.xxhash64("text"))
    return common.add_columns(marked, ["text"], [("packed", T.BinaryType())], _packing).select("doc", "mark", F.col("packed").alias("text"))


def remove(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """`df` with duplicate spans taken out of `text`.

    A text without any stays as it is; else its kept words are joined by one space.
    Rows of which nothing is left go; empty and null texts stay.
    """

    def make() -> Callable:
        def work(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
            new = []
            for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
                new.append(b" ".join(kept_words(common.words(t.encode()), s)).decode() if s else t)
            return [pa.array(new, pa.string())]

        return work

    spans = common.unused(df, "spans_of")
    spanned = with_spans(df, key, text, width, out=spans)
    done = common.add_columns(spanned, [text, spans], [(text, T.StringType())], make)
    return done.where(F.col(spans).isNull() | (common.quoted(text) != "")).select(*(common.quoted(c) for c in df.columns))


def digests(spanned: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Add n_words, n_removed and the hash of the kept words to rows with their spans."""

    def make() -> Callable:
        def work(texts: pa.Array, found: pa.Array) -> list[pa.Array]:
            n, gone, sums = [], [], []
            for t, s in zip(common.as_bytes(texts), found.to_pylist(), strict=True):
                own = common.words(t)
                kept = kept_words(own, s)
                n.append(len(own))
                gone.append(len(own) - len(kept))
                sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            return [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sums, pa.string())]

        return work

    fields = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_sha256", T.StringType())]
    return common.add_columns(spanned, [text, spans], fields, make)
