"""Ordered fold per key for rules in which each row changes the state the next row meets."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.ranking import rank_in_groups
from waymark.runtime import stage

CHUNK_ROWS = 200_000
#: records of whole keys handed back at once
EMIT_ROWS = 4096
#: rows of a task, about
TASK_ROWS = 10_000


def ordered_fold(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    step: Callable[[pd.DataFrame | list[tuple], list[dict]], tuple[list[dict], list[dict]]],
    output: T.StructType,
    state: T.StructType,
    chunk_rows: int = CHUNK_ROWS,
    initial: DataFrame | None = None,
    frames: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Run ``step(rows, state) -> (outputs, state)`` over each key's rows in order.

    Rows and states are sorted by key and pass through a task as one stream, so a key costs no call of its own.
    A key longer than ``chunk_rows`` is worked off in chunks, one round each, with its state handed
    on through a stage table: a task never holds more than one chunk and one state of a key, and the records of few others.
    ``initial`` (key + state columns) gives keys a state to start from. Returns all outputs and the
    final states of the keys seen, both with the key column added; a state without rows stays as it is.
    Without ``frames`` the rows come as tuples of the columns besides the key: a frame per key costs milliseconds.
    """
    key_field = df.schema[key]
    fields = output.fieldNames()
    state_fields = state.fieldNames()
    emitted = T.StructType(
        [key_field, T.StructField("_out", output), T.StructField("_state", state)]
    )
    small = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    longest, total = (n or 0 for n in small.agg(F.max("_n"), F.sum("_n")).first())
    if longest <= chunk_rows:
        ranked = df.withColumn("_chunk", F.lit(0))
        rounds = 1
    else:
        ranked = stage(
            rank_in_groups(df, [key], order, "_rank").withColumn(
                "_chunk", F.floor((F.col("_rank") - 1) / chunk_rows).cast("int")
            ).drop("_rank"),
            "chunks",
        )
        rounds = -(-longest // chunk_rows)
    own = [c for c in df.columns if c != key]
    # a row costs time however few bytes it has, so tasks are dealt by rows and not by size
    tasks = max(1, math.ceil(total / TASK_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key_type, out_type, state_type, records in _folded(batches, own, step, frames):
            made = [pa.array([r[0] for r in records], key_type)]
            made.append(pa.array([r[1] if r[1] is None else {f: r[1].get(f) for f in fields} for r in records], out_type))
            made.append(pa.array([r[2] if r[2] is None else {f: r[2].get(f) for f in state_fields} for r in records], state_type))
            yield pa.record_batch(made, names=[key_field.name, "_out", "_state"])

    states = initial
    if states is None:
        states = df.sparkSession.createDataFrame([], T.StructType([key_field, *state.fields]))
    outputs = None
    for number in range(rounds):
        rows = ranked.where(F.col("_chunk") == number).select(
            key, F.lit(None).cast(output).alias("_out"), F.lit(None).cast(state).alias("_state"), *own
        )
        # the states of a key come ahead of its rows
        held = states.select(
            key, F.lit(None).cast(output).alias("_out"), F.struct(*[F.col(f) for f in state_fields]).cast(state).alias("_state"),
            *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in own],
        )
        result = stage(
            held.unionByName(rows).repartition(tasks, key)
            .sortWithinPartitions(key, F.col("_state").isNull(), *[F.asc_nulls_last(c) for c in order])
            .mapInArrow(run, emitted),
            "fold",
        )
        out = result.where("_out is not null").select(key, "_out.*")
        outputs = out if outputs is None else outputs.unionByName(out)
        states = result.where("_state is not null").select(key, "_state.*")
    return outputs, states


def _folded(batches: Iterator[pa.RecordBatch], own: list[str], step: Callable, frames: bool) -> Iterator[tuple]:
    """(key, output and state types, records) of sorted rows: one key's chunk and state are held at a time."""
    types: tuple = ()
    key, seen, rows, held, records = None, False, [], [], []

    def close() -> None:
        outs, after = step(pd.DataFrame(rows, columns=own) if frames else rows, held) if rows else ([], held)
        records.extend((key, o, None) for o in outs)
        records.extend((key, None, s) for s in after)

    for batch in batches:
        types = tuple(batch.schema.field(c).type for c in (0, 1, 2))
        values = [_plain(batch.column(c)) for c in own]
        for k, s, row in zip(
            batch.column(0).to_pylist(), _states(batch.column(2)), zip(*values, strict=True), strict=True
        ):
            if not seen or k != key:
                if seen:
                    close()
                key, seen, rows, held = k, True, [], []
                if len(records) >= EMIT_ROWS:
                    yield *types, records
                    records = []
            if s is None:
                rows.append(row)
            else:
                held.append(s)
    if seen:
        close()
        yield *types, records


def _plain(column: pa.Array) -> list:
    """Python values of a column; a missing number is NaN, as in a pandas column."""
    if pa.types.is_floating(column.type):
        column = pc.fill_null(column, math.nan)
    return column.to_pylist()


def _states(column: pa.Array) -> list[dict | None]:
    """A dict per row that holds a state, else None."""
    if column.null_count == len(column):
        return [None] * len(column)
    names = [column.type.field(i).name for i in range(column.type.num_fields)]
    values = zip(*[_plain(x) for x in column.flatten()], strict=True)
    return [dict(zip(names, v, strict=True)) if valid else None for valid, v in zip(column.is_valid().to_pylist(), values, strict=True)]
