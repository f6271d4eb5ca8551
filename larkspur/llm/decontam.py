"""Benchmark decontamination by a generalised suffix automaton of the test items.

The normalised words of all items go into one automaton: a state stands for the word sequences that
occur at the same places of the items.  A document's words are streamed through it once; after every
word the state and the length of the longest match that ends there are known.  A match of at least
`window` words, or of a whole item that is shorter, marks its words.

Items are dealt into blocks of bounded size, one automaton each, so what a task holds and what is
broadcast never grows with the benchmark; a document meets the blocks one after the other.

Defined cases: null, empty and wordless texts (documents or items) have no words; an empty item table
marks nothing; repeated documents are judged each on its own; items that share a window are all
reported; repeated item rows and rows under one item_id count as one item; a null item_id is one item
whose id is written as the empty string; texts of any length are streamed in slices; columns of the
documents that bear the name of a result column are replaced.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common

WINDOW = 10
#: Words of items in one automaton, about; a longer item is cut into overlapping parts.
BLOCK_WORDS = 1 << 17
PART_WORDS = 1 << 14
#: Bytes of a text that are split into words at a time.
SLICE = 1 << 20

#: Word characters are 0-9, a-z and everything beyond ASCII; A-Z is lower-cased, the rest separates.
_SPELLING = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")

FIELDS = [
    ("n_words", T.LongType()),
    ("spans", T.ArrayType(T.LongType(), False)),
    ("item_ids", T.ArrayType(T.StringType(), False)),
    ("longest_match", T.LongType()),
]


def words(text: bytes) -> list[bytes]:
    return text.translate(_SPELLING).split()


def streamed(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; a slice ends between two words."""
    start = 0
    while start < len(text):
        end = start + SLICE
        while end < len(text) and _SPELLING[text[end]] != 32:
            end += 1
        yield words(text[start:end])
        start = end


class Automaton:
    """Suffix automaton of several word sequences, with what each state means for the items."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.edges: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.items_of: dict[int, set[str]] = {}
        paths = []
        for name, sequence in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in sequence]
            if own:
                self._add(own)
                paths.append((name, own))
        self._mean(paths)

    def _state(self, edges: dict[int, int], longest: int, link: int) -> int:
        self.edges.append(edges)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.edges) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """The state of `parent` + `word`, parted from longer sequences if need be."""
        if self.longest[child] == self.longest[parent] + 1:
            return child
        part = self._state(dict(self.edges[child]), self.longest[parent] + 1, self.link[child])
        self.link[child] = part
        while parent >= 0 and self.edges[parent].get(word) == child:
            self.edges[parent][word] = part
            parent = self.link[parent]
        return part

    def _add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            known = self.edges[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new = self._state({}, self.longest[last] + 1, 0)
            parent = last
            while parent >= 0 and word not in self.edges[parent]:
                self.edges[parent][word] = new
                parent = self.link[parent]
            if parent >= 0:
                self.link[new] = self._split(parent, word, self.edges[parent][word])
            last = new

    def _mean(self, paths: list[tuple[str, list[int]]]) -> None:
        """Per state: the state of its last `window` words, the nearest whole short item, the length that matters."""
        size, window = len(self.edges), self.window
        self.window_state, self.short, self.floor = [-1] * size, [-1] * size, [1 << 60] * size
        whole = set()
        for name, own in paths:
            if len(own) < window:
                at = 0
                for word in own:
                    at = self.edges[at][word]
                whole.add(at)
                self.items_of.setdefault(at, set()).add(name)
        for state in sorted(range(1, size), key=self.longest.__getitem__):
            above = self.link[state]
            if self.longest[state] >= window:
                self.window_state[state] = state if self.longest[above] < window else self.window_state[above]
                self.floor[state] = window
            inherited = self.short[above] if above > 0 else -1
            self.short[state] = state if state in whole else inherited
            if inherited >= 0:
                self.floor[state] = 1
            elif state in whole:
                self.floor[state] = self.longest[state]
        for name, own in paths:
            if len(own) >= window:
                at = 0
                for i, word in enumerate(own):
                    at = self.edges[at][word]
                    if i >= window - 1:
                        self.items_of.setdefault(self.window_state[at], set()).add(name)

    def packed(self) -> dict:
        """Plain arrays, for shipping."""
        own = [(s, w, t) for s, out in enumerate(self.edges) for w, t in out.items()]
        return {
            "window": self.window, "words": list(self.vocabulary), "items_of": {s: sorted(n) for s, n in self.items_of.items()},
            "edges": np.array(own, np.int32).reshape(-1, 3), "per_state": np.array([self.link, self.longest, self.window_state, self.short, np.minimum(self.floor, 2**30)], np.int32),
        }


class Matcher:
    """Streams words through a packed automaton."""

    def __init__(self, packed: dict):
        self.number = {w: i for i, w in enumerate(packed["words"])}
        self.width = max(1, len(self.number))
        edges = packed["edges"].astype(np.int64)
        self.edge = dict(zip((edges[:, 0] * self.width + edges[:, 1]).tolist(), edges[:, 2].tolist(), strict=True))
        self.link, self.longest, self.window_state, self.short, self.floor = packed["per_state"].tolist()
        self.window, self.items_of = packed["window"], packed["items_of"]

    def match(self, text: bytes) -> tuple[int, list[list[int]], set[str], int]:
        """(words, merged [first, behind the last) word places of matches, items, longest match)."""
        edge, link, longest, floor, width, number = self.edge, self.link, self.longest, self.floor, self.width, self.number
        spans: list[list[int]] = []
        seen: set[int] = set()
        state = length = most = place = 0
        for some in streamed(text):
            for word in map(number.get, some):
                place += 1
                if word is None:
                    state = length = 0
                    continue
                to = edge.get(state * width + word)
                while to is None:
                    state = link[state]
                    length = longest[state]
                    to = edge.get(state * width + word)
                state = to
                length += 1
                if length > most:
                    most = length
                if length >= floor[state]:
                    self._mark(state, length, place, spans, seen)
        return place, spans, {name for s in seen for name in self.items_of[s]}, most

    def _mark(self, state: int, length: int, place: int, spans: list[list[int]], seen: set[int]) -> None:
        taken = 0
        if length >= self.window:
            seen.add(self.window_state[state])
            taken = length
        short = self.short[state]
        if short == state and length < self.longest[state]:
            short = self.short[self.link[state]]
        while short > 0:
            seen.add(short)
            taken = max(taken, self.longest[short])
            short = self.short[self.link[short]]
        if taken:
            start = place - taken
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, place])


def _parts(items: DataFrame, item_id: str, text: str, window: int, part_words: int) -> DataFrame:
    """Distinct (item, words) with long items cut into parts that overlap by window - 1 words."""
    fields = [("item", T.StringType()), ("parts", T.ArrayType(T.StringType(), False))]

    def make():
        def work(ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
            parts = []
            for t in common.as_bytes(texts):
                own = words(t)
                last = max(1, len(own) - window + 1)
                parts.append([b" ".join(own[i : i + part_words + window - 1]).decode() for i in range(0, last, part_words)] if own else [])
            return [pa.array(["" if i is None else i for i in ids.to_pylist()], pa.string()), pa.array(parts, pa.list_(pa.string()))]

        return work

    own = items.select(common.quoted(item_id).cast("string").alias("__id"), common.quoted(text).alias("__text"))
    split = common.add_columns(own, ["__id", "__text"], fields, make).select("item", F.explode("parts").alias("part"))
    return split.distinct()


def automata(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[dict]:
    """Packed automata of the items, block after block; each is built in a task and fetched on its own."""
    spark = items.sparkSession
    parts = common.stored(_parts(items, item_id, text, window, min(PART_WORDS, block_words)), "decontam-items")
    total = parts.agg(F.sum(F.size(F.split("part", " ")))).first()[0] or 0
    blocks = -(-total // block_words)
    dealt = parts.withColumn("block", F.pmod(F.xxhash64("item", "part"), F.lit(max(1, blocks))))
    listed = dealt.groupBy("block").agg(F.collect_list(F.struct("item", "part")).alias("own"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("packed", T.BinaryType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                pairs = sorted((p["item"], p["part"]) for p in own.as_py())
                packed = Automaton(((i, p.encode().split(b" ")) for i, p in pairs), window).packed()
                yield pa.RecordBatch.from_pylist([{"block": block, "packed": pickle.dumps(packed)}])

    built = common.stored(listed.mapInArrow(build, schema), "decontam-automata")
    for block in range(blocks):
        found = built.where(F.col("block") == block).first()
        if found is not None:
            yield spark.sparkContext.broadcast(bytes(found["packed"]))


def _passed(docs: DataFrame, text: str, blob) -> DataFrame:
    """One block's matches joined to those of the blocks before it."""
    before = [n for n in ("spans", "item_ids", "longest_match") if n in docs.columns]

    def make():
        matcher = Matcher(pickle.loads(blob.value))

        def work(texts: pa.Array, *known: pa.Array) -> list[pa.Array]:
            rows = []
            for i, t in enumerate(texts.cast(pa.binary())):
                n, spans, items, most = matcher.match(t.as_py() or b"")
                if known:
                    flat, old, most_known = (k[i].as_py() for k in known)
                    spans = _merged(spans + [flat[j : j + 2] for j in range(0, len(flat), 2)])
                    items, most = items | set(old), max(most, most_known)
                rows.append((n, [p for s in spans for p in s], sorted(items), most))
            return [pa.array([r[k] for r in rows], a) for k, a in enumerate((pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64()))]

        return work

    return common.add_columns(docs, [text, *before], FIELDS, make)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


_NOTHING = {"window": 1, "words": [], "items_of": {}, "edges": np.zeros((0, 3), np.int32), "per_state": np.array([[-1], [0], [-1], [-1], [2**30]], np.int32)}


def find(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with n_words, n_hit, spans (first and behind-the-last word of each marked stretch, flat),
    item_ids (ids, as strings, sorted, of items with a match), longest_match and contaminated."""
    taken = {n for n, _ in FIELDS} | {"n_hit", "contaminated"}
    found = docs.select(*(common.quoted(c) for c in docs.columns if c == text or c.lower() not in taken))
    passes = 0
    for blob in automata(items, item_id, item_text, window, block_words):
        found = _passed(common.stored(found, "decontam-pass") if passes else found, text, blob)
        passes += 1
    if not passes:
        found = _passed(found, text, docs.sparkSession.sparkContext.broadcast(pickle.dumps(_NOTHING)))
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_hit", hit).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, items: DataFrame, text: str = "text", most: float = 0.5, **how) -> DataFrame:
    """`docs` without test passages: marked stretches are cut out of the text, and documents of whose
    words more than the share `most` is marked go.  Clean documents keep their text byte for byte."""
    others = [c for c in docs.columns if c != text]
    packed = docs.select(F.struct(F.lit(True), *(common.quoted(c) for c in others)).alias("others"), common.quoted(text).alias("own"))
    found = find(packed, items, "own", **how).where(F.col("n_hit") <= F.lit(most) * F.col("n_words"))

    def make():
        def work(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
            out = []
            for t, own in zip(texts, spans, strict=True):
                flat = own.as_py()
                out.append(_without(t.as_py().encode(), flat).decode() if flat else t.as_py())
            return [pa.array(out, pa.string())]

        return work

    cut = common.add_columns(found.select("others", "own", "spans"), ["own", "spans"], [("own", T.StringType())], make)
    return cut.select(*(F.col("own").alias(c) if c == text else F.col("others").getField(c).alias(c) for c in docs.columns))


def _without(text: bytes, flat: list[int]) -> bytes:
    """The text without the words in the given stretches; what stands between kept words stays."""
    spelled, keep, at, place, edges = text.translate(_SPELLING), [], 0, 0, iter(flat)
    start, end = next(edges), next(edges)
    for found in _WORD.finditer(spelled):
        if place == start:
            keep.append(text[at : found.start()])
        place += 1
        if place == end:
            at = found.end()
            start, end = next(edges, -1), next(edges, -1)
    keep.append(text[at:])
    return b"".join(keep)
