"""Conversations in turn order, packed into pieces of bounded size.

Rows are dealt by ranges of (conversation, turn), so a conversation that holds a large part of all rows
is spread over many tasks, and each task packs consecutive turns into pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larkspur.llm import common

#: Most turns and, about, most bytes of text of a piece.
PIECE_ROWS = 2048
PIECE_BYTES = 4 << 20
#: Characters of a text that take part in the choice of ranges.
LEAD = 32
_STEP = 256


def piece_schema(conv_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("conv_id", conv_type),
            T.StructField("part", T.LongType()),
            T.StructField("seq", T.LongType()),
            T.StructField("whole", T.BooleanType()),
            T.StructField("turns", T.ArrayType(T.LongType())),
            T.StructField("roles", T.ArrayType(T.StringType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
        ]
    )


def batched(rows: Iterator[tuple], schema: T.StructType, sizes: Iterator[int] | None = None, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most `most` rows and, for rows that end in their size, about PIECE_BYTES."""
    own, held, size = to_arrow_schema(schema), [], 0
    for row in rows:
        held.append(row)
        if sizes is not None:
            size += next(sizes)
        if len(held) >= most or size >= PIECE_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), own, strict=True)], schema=own)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), own, strict=True)], schema=own)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches, a few at a time as Python values."""
    for batch in batches:
        step = max(1, min(_STEP, PIECE_BYTES * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, step).columns), strict=True)


def pieces(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Pieces of (conv_id, turn, role, text, gone): turns in order, ties by role and text.

    Rows that are `gone` only keep their conversation alive.  A conversation's pieces are ordered by
    (part, seq).  `whole` ones hold all turns of a conversation; one that touches the edge of a task
    or exceeds a piece is not whole, even if no other piece follows.
    """
    schema = piece_schema(rows.schema["conv_id"].dataType)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sizes = TaskContext.get().partitionId(), []

        def cut() -> Iterator[tuple]:
            held, size, seq, current, begun, first = [], 0, 0, None, False, True

            def piece(whole: bool) -> tuple:
                sizes.append(size + 64)
                return (current, part, seq, whole, [r[0] for r in held], [r[1] for r in held], [r[2] for r in held])

            cuts = 0
            for conv, turn, role, text, gone in rows_of(batches):
                if begun and conv != current:
                    yield piece(not first and not cuts)
                    held, size, cuts, first, seq = [], 0, 0, False, seq + 1
                elif held and (len(held) >= piece_rows or size >= PIECE_BYTES):
                    yield piece(False)
                    held, size, cuts, seq = [], 0, cuts + 1, seq + 1
                current, begun = conv, True
                if not gone:
                    held.append((turn, role, text))
                    size += len(text)
            if begun:
                yield piece(False)

        def taken() -> Iterator[int]:
            while True:
                yield sizes.pop()

        return batched(cut(), schema, taken())

    lead = F.substring("text", 1, LEAD)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first()]
    dealt = rows.select("conv_id", "turn", "role", "text", "gone").repartitionByRange(*order, lead.asc_nulls_first())
    placed = dealt.sortWithinPartitions(*order, F.col("text").asc_nulls_first())
    return common.stored(placed.mapInArrow(pack, schema), "pieces")
