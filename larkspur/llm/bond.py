"""Exact top-k by columnar branch-and-bound.

Candidates are written once to the shared folder, in blocks of vertical layout: for every `STEP`
dimensions the block's components, dimension by dimension, and in front of them the mass (norm)
of what follows in each vector.  A query block meets the blocks one after the other; the inner
product grows dimension block by dimension block, and by Cauchy-Schwarz what is left cannot add
more than the product of the remaining masses.  Candidates that cannot reach a query's k-th score
so far are dropped and the survivors moved together; the next dimensions are only read while
there are survivors.

Queries are a stated set, taken in blocks.  Each query block first meets one candidate block, which
gives every query a score to beat; then it is dealt to as many tasks as there are groups of
`BLOCKS` candidate blocks, and the groups' best are merged at the end.  What moves are the query
blocks and the names of the candidate blocks, never the candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm import common

ROWS = 4096
QUERIES = 512
STEP = 16
#: Candidate blocks that one task reads for one query block.
BLOCKS = 4
SCALE = 64
_EXACT = 2.0**53
#: Components from here on are packed apart, so that products of all others stay exact in doubles.
_LARGE = 2.0**22


def _packed(per_block: int, scale: float, pack: Callable):
    """Rows (id, vector) -> what `pack` makes of each block of ids and floored vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        no, state = TaskContext.get().partitionId() << 32, {}
        held: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not v.is_valid or v.values.null_count:
                    continue
                own = np.floor(v.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if not np.isfinite(own).all():
                    continue
                ids, vectors = held[bool(np.abs(own).max(initial=0) >= _LARGE)]
                ids.append(i)
                vectors.append(own)
                if len(ids) == per_block:
                    yield pack(no, ids, vectors, state)
                    no += 1
                    ids.clear()
                    vectors.clear()
        for ids, vectors in held.values():
            if ids:
                yield pack(no, ids, vectors, state)
                no += 1
        if "out" in state:
            state["out"].close()

    return run


def _columns(vectors: list[np.ndarray]) -> np.ndarray:
    """One row per dimension; vectors of fewer dimensions than the longest are filled up with zeros."""
    cells = np.zeros((max(len(v) for v in vectors), len(vectors)))
    for j, v in enumerate(vectors):
        cells[: len(v), j] = v
    return cells


def _kind(cells: np.ndarray) -> type:
    """The smallest of three number types that holds the cells exactly."""
    most = np.abs(cells).max(initial=0)
    return np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64


_KINDS = {2: np.int16, 4: np.int32, 8: np.float64}
_QUERY = "block long, n int, dims int, width int, ids binary, cells binary"
_QUERY_NAMES = ["block", "n", "dims", "width", "ids", "cells"]
_CANDIDATE = "file string, at long, n int, dims int, width int, most double"
_CANDIDATE_NAMES = ["file", "at", "n", "dims", "width", "most"]


def _row(names: list[str], schema: list[pa.DataType], values: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema, strict=True)], names=names)


def _pack_queries(no: int, ids: list[int], vectors: list[np.ndarray], _) -> pa.RecordBatch:
    cells = _columns(vectors)
    kind = _kind(cells)
    values = (no, len(ids), len(cells), np.dtype(kind).itemsize, np.array(ids, np.int64).tobytes(), cells.astype(kind).tobytes())
    return _row(_QUERY_NAMES, [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()], values)


def _write_candidates(folder: str):
    """Appends each block to the task's file: ids, then per step the mass behind it and its cells."""

    def pack(no: int, ids: list[int], vectors: list[np.ndarray], state: dict) -> pa.RecordBatch:
        if "out" not in state:
            from pyspark import TaskContext

            # one file per attempt: only the attempt that counts is named in the rows
            state["name"] = f"{folder}/blocks-{no >> 32:05d}-{TaskContext.get().taskAttemptId()}"
            system, path = fs.FileSystem.from_uri(state["name"])
            system.create_dir(path.rpartition("/")[0], recursive=True)
            state["out"], state["at"] = system.open_output_stream(path, compression=None), 0
        cells = _columns(vectors)
        kind = _kind(cells)
        mass = np.sqrt(np.cumsum((cells**2)[::-1], axis=0)[::-1])
        raw = [np.array(ids, np.int64).tobytes()]
        for d in range(0, len(cells), STEP):
            behind = mass[d + STEP] if d + STEP < len(cells) else np.zeros(len(ids))
            # rounded up, so that a bound never comes out too low
            raw += [np.nextafter(behind.astype(np.float32), np.float32(np.inf)).tobytes(), cells[d : d + STEP].astype(kind).tobytes()]
        at = state["at"]
        state["at"] += state["out"].write(b"".join(raw))
        values = (state["name"], at, len(ids), len(cells), np.dtype(kind).itemsize, float(np.abs(cells).max(initial=0)))
        return _row(_CANDIDATE_NAMES, [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()], values)

    return pack


class Block:
    """A candidate block in its file, read step by step."""

    def __init__(self, file, at: int, n: int, dims: int, width: int, most: float):
        self.file, self.at, self.n, self.dims, self.width, self.most = file, at, n, dims, width, most
        self.ids = np.frombuffer(file.read_at(8 * n, at), np.int64)

    def step(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """(cells, mass behind them) of the dimensions from d to the end of their step."""
        rows = min(STEP, self.dims - d)
        before = d // STEP * 4 * self.n + d * self.width * self.n
        raw = self.file.read_at((4 + rows * self.width) * self.n, self.at + 8 * self.n + before)
        cells = np.frombuffer(raw, _KINDS[self.width], offset=4 * self.n).reshape(rows, self.n)
        return cells.astype(np.float64), np.frombuffer(raw, np.float32, self.n).astype(np.float64)

    def all(self) -> np.ndarray:
        return np.concatenate([np.zeros((0, self.n)), *(self.step(d)[0] for d in range(0, self.dims, STEP))])


class Best:
    """The best k (score, id) of each query of a block so far, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray, k: int, least: np.ndarray | None = None):
        self.ids, self.cells, self.k = ids, cells, k
        self.scores = [np.zeros(0, np.int64)] * len(ids)
        self.found = [np.zeros(0, np.int64)] * len(ids)
        self.least = np.full(len(ids), -np.inf) if least is None else least.copy()
        self.most = np.abs(cells).max(initial=0)
        self.mass = np.sqrt(np.cumsum((cells**2)[::-1], axis=0)[::-1])  # of the dimensions from d on

    def meet(self, block: Block) -> None:
        dims = min(block.dims, len(self.cells))
        if dims and dims * block.most * self.most >= _EXACT:
            self._meet_large(block.ids, block.all()[:dims])
            return
        queries = np.arange(len(self.ids))
        alive, part = np.arange(block.n), np.zeros((len(self.ids), block.n))
        for d in range(0, dims, STEP):
            cells, behind = block.step(d)
            to = min(d + len(cells), dims)
            part = part + self.cells[d:to, queries].T @ cells[: to - d, alive]
            if to < dims:
                bound = part + np.outer(self.mass[to, queries], behind[alive]) * (1 + 1e-9) + 1e-6
                can = bound >= self.least[queries, None]
                queries, alive, part = _compact(can, queries, alive, part)
                if not len(queries) or not len(alive):
                    return
        for row, q in enumerate(queries.tolist()):
            good = np.flatnonzero((part[row] >= self.least[q]) & (block.ids[alive] != self.ids[q]))
            if len(good):
                self._add(q, part[row, good].astype(np.int64), block.ids[alive[good]])

    def _meet_large(self, ids: np.ndarray, cells: np.ndarray) -> None:
        """Products beyond what doubles hold exactly: whole numbers, cut to 64 bits at the end."""
        wide = [[int(x) for x in row] for row in cells.T.tolist()]
        for q, own in enumerate([[int(x) for x in row] for row in self.cells[: len(cells)].T.tolist()]):
            scores = [max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(own, c, strict=True)))) for c in wide]
            other = np.flatnonzero(ids != self.ids[q])
            self._add(q, np.array(scores, dtype=np.int64)[other], ids[other])

    def _add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores[q], scores)), np.concatenate((self.found[q], ids))
        if len(scores) > self.k:
            order = np.lexsort((ids, ~scores))[: self.k]  # ~ turns the order without overflow
            scores, ids = scores[order], ids[order]
        self.scores[q], self.found[q] = scores, ids
        if len(scores) == self.k:
            self.least[q] = max(self.least[q], scores.min())

    def rows(self) -> list[np.ndarray]:
        counts = [len(s) for s in self.scores]
        return [np.repeat(self.ids, counts), np.repeat(np.arange(len(self.ids)), counts), np.concatenate([*self.found, np.zeros(0, np.int64)]), np.concatenate([*self.scores, np.zeros(0, np.int64)])]


def _compact(can: np.ndarray, queries: np.ndarray, alive: np.ndarray, part: np.ndarray):
    """Leave out candidates no query needs and queries no candidate can serve."""
    rows, cols = can.any(axis=1), can.any(axis=0)
    if rows.all() and cols.mean() > 0.9:
        return queries, alive, part
    return queries[rows], alive[cols], part[np.ix_(rows, cols)]


def _query_block(n: int, dims: int, width: int, ids: bytes, cells: bytes, k: int, least: bytes | None = None) -> Best:
    own = np.frombuffer(cells, _KINDS[width]).reshape(dims, n).astype(np.float64)
    return Best(np.frombuffer(ids, np.int64), own, k, None if least is None else np.frombuffer(least, np.float64))


def _to_beat(k: int, first: tuple):
    """Query blocks with the k-th score that each query reaches in one candidate block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(first[0])
        with system.open_input_file(path) as file:
            for batch in batches:
                least = []
                for n, dims, width, ids, cells in zip(*(c.to_pylist() for c in batch.columns[1:6]), strict=True):
                    best = _query_block(n, dims, width, ids, cells, k)
                    best.meet(Block(file, *first[1:]))
                    least.append(best.least.tobytes())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.binary())], names=[*_QUERY_NAMES, "least"])

    return run


def _search(k: int):
    """Rows of (group, split): the query block, then its candidate blocks by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best, name, file = None, None, None, None
        for batch in batches:
            for own, split, q, c in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (own, split) != at:
                    if best is not None:
                        yield _found(at[0], best)
                    at, best = (own, split), None
                if q is not None:
                    best = _query_block(q["n"], q["dims"], q["width"], q["ids"], q["cells"], k, q["least"])
                elif best is not None:
                    if c["file"] != name:
                        name = c["file"]
                        system, path = fs.FileSystem.from_uri(name)
                        file = system.open_input_file(path)
                    best.meet(Block(file, *(c[x] for x in _CANDIDATE_NAMES[1:])))
        if best is not None:
            yield _found(at[0], best)

    return run


def _found(group: int, best: Best) -> pa.RecordBatch:
    cols = best.rows()
    cols = [np.full(len(cols[0]), group), *cols]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["group", "query_id", "place", "vec_id", "score"])


def top_k(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, scale: float = SCALE) -> DataFrame:
    """The k best candidates of each query row by inner product of floor(scale * x).

    (query_id, rank from 1, vec_id, score); ties go to the smaller id.  Every row but the
    query's own id is a candidate.  Null ids and vectors that are null or hold null or
    non-finite components take no part.  Shorter vectors count as filled up with zeros.  Scores
    beyond 64 bits are cut to the nearest.  Repeated ids are searched and found once for each row.
    An empty table, or one without queries, gives no rows; further columns are not looked at.
    """
    spark = df.sparkSession
    rows = df.select(common.quoted(key).cast("long").alias("id"), common.quoted(vector).alias("v"), is_query.alias("q")).where("id is not null")
    asked = common.stored(rows.where("q").select("id", "v").mapInArrow(_packed(QUERIES, scale, _pack_queries), _QUERY), "query-blocks")
    folder = common.fresh_folder(spark, "candidates")
    blocks = common.stored(rows.select("id", "v").mapInArrow(_packed(ROWS, scale, _write_candidates(folder)), _CANDIDATE), "candidate-blocks")
    first = blocks.orderBy("most", "file", "at").first()
    groups = asked.count()
    if not groups or first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    splits = -(-blocks.count() // BLOCKS)
    asked = common.stored(asked.mapInArrow(_to_beat(k, tuple(first)), _QUERY + ", least binary"), "scores-to-beat")
    numbered = asked.select("block").distinct().select("block", F.row_number().over(Window.orderBy("block")).alias("group"))
    query, candidate = F.struct(*_QUERY_NAMES[1:], "least"), F.struct(*_CANDIDATE_NAMES)
    left = asked.join(numbered, "block").select("group", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"), query.alias("query"), F.lit(None).cast(_struct(blocks)).alias("candidate"))
    split = F.pmod(F.hash("file", "at"), F.lit(splits)).cast("int")
    right = blocks.select(F.explode(F.sequence(F.lit(1), F.lit(groups))).alias("group"), split.alias("split"), F.lit(None).cast(left.schema["query"].dataType).alias("query"), candidate.alias("candidate"))
    met = left.unionByName(right).repartition(groups * splits, "group", "split")
    met = met.sortWithinPartitions("group", "split", F.col("query").isNull(), "candidate.file", "candidate.at")
    found = met.mapInArrow(_search(k), "group long, query_id long, place long, vec_id long, score long")
    order = Window.partitionBy("group", "place").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _struct(blocks: DataFrame) -> str:
    return blocks.select(F.struct(*_CANDIDATE_NAMES).alias("c")).schema["c"].dataType.simpleString()
