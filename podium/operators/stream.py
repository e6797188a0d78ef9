"""Group-wise vectorised maps that stream: whole groups reach the function in Arrow tables.

Spark shuffles on the group keys and sorts inside the partitions (spilling if it must); Python
then sees many small groups at a time instead of one call a group. Only the group at the end of
a batch is held back, so memory is bounded by one group. Callers choose keys that bound a group,
such as (meeting, hour of recording).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """For each row, whether it begins a group; the first row does. Nulls equal nulls."""
    first = np.zeros(table.num_rows, dtype=bool)
    first[:1] = True
    if table.num_rows > 1:
        for k in keys:
            column = table.column(k).combine_chunks()
            if isinstance(column, pa.ChunkedArray):
                column = pa.concat_arrays(column.chunks)
            a, b = column.slice(1), column.slice(0, len(column) - 1)
            unequal = pc.fill_null(pc.not_equal(a, b), True).to_numpy(zero_copy_only=False)
            both = pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
            first[1:] |= unequal & ~both
    return first


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by the keys."""
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        new = pa.Table.from_batches([batch])
        joint = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), new]) if held else new
        at = np.flatnonzero(changes(joint, keys)) - bool(held)
        at = at[at >= (0 if held else 1)]
        if not len(at):
            held.append(new)
            continue
        cut = int(at[-1])
        done = [*held, new.slice(0, cut)]
        yield pa.concat_tables(done).combine_chunks()
        held = [new.slice(cut)]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def map_groups(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """fn(table, begins) for tables of whole groups, rows in order; begins marks first rows of groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            out = fn(table, changes(table, keys))
            yield from out.to_batches(max_chunksize=65536)

    return df.repartition(*[df[k] for k in keys]).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def numbers(table: pa.Table, name: str, null: int = -1) -> np.ndarray:
    """A column of whole numbers as int64; nulls as the value given."""
    column = pc.fill_null(table.column(name).cast(pa.int64()), null)
    return column.combine_chunks().to_numpy(zero_copy_only=False) if not isinstance(column, pa.ChunkedArray) else column.to_numpy()
