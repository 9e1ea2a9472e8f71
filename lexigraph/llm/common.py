"""Shared pieces: Arrow row functions with bounded batches, and the character classes that the operators agree on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: The white space of the word and line operators: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of Arrow data that a Python row function holds at once (a single longer row is one piece).
PIECE_BYTES = 4 << 20


def pieces(batch: pa.RecordBatch, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batch of about `most` bytes, at least a row each; rows are halved until they fit, so one long text does not drag its neighbours along."""
    if batch.num_rows <= 1 or batch.nbytes <= most:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from pieces(batch.slice(0, half), most)
    yield from pieces(batch.slice(half), most)


def map_columns(df: DataFrame, func: Callable[..., list], schema: T.StructType | str, most: int = PIECE_BYTES) -> DataFrame:
    """func gets each input column as a Python list and returns the output columns as lists; row counts may differ."""
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    out = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most):
                made = func(*[c.to_pylist() for c in piece.columns])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(made, out, strict=True)], schema=out)

    return df.mapInArrow(run, kind)


def free_name(name: str, *tables: DataFrame) -> str:
    """name, with underscores behind it until no table has such a column."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name
