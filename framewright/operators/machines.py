"""State machines over sorted rows: one pass, one row at a time, with a state that does not grow with the rows.

Rows of a group (its keys) meet in one task in order, as a stream: a group is never an array in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Takes the rows of one group in order, and gives rows.
Machine = Callable[[Iterator[tuple]], Iterator[tuple]]
OUT_ROWS = 8192


def run_machine(rows: DataFrame, keys: list[str], order: list[str], machine: Machine, out: list[str]) -> DataFrame:
    """Runs a machine over each group of rows. It gets each row's columns beyond the keys, in the frame's order; out: the types of what it gives, as `name type`."""
    values = [c for c in rows.columns if c not in keys]
    schema = ", ".join([f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys] + out)
    names = keys + [o.split(" ", 1)[0] for o in out]
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        made: list[tuple] = []

        def stream() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.column(k).type for k in keys]
                yield from zip(*[batch.column(c).to_pylist() for c in keys + values], strict=True)

        source = stream()
        waiting: list[tuple] = []  # the first row of the next group

        def group(first: tuple) -> Iterator[tuple]:
            yield first[n:]
            for row in source:
                if row[:n] != first[:n]:
                    waiting.append(row)
                    return
                yield row[n:]

        def told() -> pa.RecordBatch:
            columns = list(zip(*made, strict=True))
            made.clear()
            return pa.record_batch([pa.array(c, types[i]) if i < n else pa.array(c) for i, c in enumerate(columns)], names)

        for row in source:
            waiting.append(row)
            while waiting:
                first = waiting.pop()
                rest = group(first)
                for result in machine(rest):
                    made.append((*first[:n], *result))
                    if len(made) >= OUT_ROWS:
                        yield told()
                for _ in rest:  # what a machine leaves unread
                    pass
        if made:
            yield told()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def fragments(least) -> Machine:
    """Boundaries (t) of adjoining scenes in; scenes out, after the first scene shorter than `least` was merged into its shorter neighbour (a tie: the one before) until none is left.

    The scenes before the current one are all long enough, and only the last of them can still grow: it is all that the machine remembers of them.
    """

    def machine(rows: Iterator[tuple]) -> Iterator[tuple]:
        top = None  # (start, end) of the last scene that is long enough
        start = next(rows)[0]
        end = next(rows, (None,))[0]
        while end is not None:
            after = next(rows, (None,))[0]
            if end - start >= least:
                if top is not None:
                    yield top
                top, start, end = (start, end), end, after
            elif after is None:
                if top is None:
                    yield start, end
                else:
                    top = (top[0], end)
                end = None
            elif top is not None and top[1] - top[0] <= after - end:
                top, start, end = (top[0], end), end, after
            else:
                end = after
        if top is not None:
            yield top

    return machine


def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(i, next, entry, ...) of a block in order of i: the rows (i, ...) that a walk from the entry meets."""
    at = None
    for i, after, entry, *more in rows:
        if i == (entry if at is None else at):
            yield i, *more
            at = after


def leaves(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(-i, i, next) of a block in falling order of i: each i with the first place beyond the block on the walk from it; at most a block is remembered."""
    out: dict[int, int] = {}
    for _, i, after in rows:
        out[i] = out.get(after, after)
        yield i, out[i]
