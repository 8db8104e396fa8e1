"""CSV records that may hold line breaks inside quotes, cut in many tasks however the file is split.

A split's first line may lie inside a quoted cell that an earlier split opened. A first pass tells, for each split, the
state it ends in for either state it may start in; those few rows are composed along each file. A second pass then cuts
every split from its true first state; what runs over the end of a split is put together from its pieces.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.sources.arrival import SCAN_PLACE

_PLACE = ["_file", "_split", "_seq"]
_LINE = "_line string, _file string, _split bigint, _seq bigint"
_HEAD, _MIDDLE, _TAIL = "head", "middle", "tail"


class CsvError(ValueError):
    """A file is not CSV: a quoted cell never ends."""


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the line's end. A quote opens a cell only at its start; two stand for one."""
    if '"' not in line:
        return inside
    place = 0
    while True:
        if inside:
            place = line.find('"', place) + 1
            if not place:
                return True
            if line[place : place + 1] == '"':
                place += 1
                continue
            inside = False
        elif line[place : place + 1] == '"':
            inside, place = True, place + 1
            continue
        place = line.find(",", place) + 1
        if not place:
            return False


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).selectExpr("value AS _line", *SCAN_PLACE)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        for line, file, split in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            state = found.setdefault((file, split), [False, True, False])  # from outside, from inside, ever left open
            opened = ends_inside(line, False)
            state[2] |= opened
            state[0] = ends_inside(line, True) if state[0] else opened
            state[1] = ends_inside(line, True) if state[1] else opened
    rows = [(*key, *state) for key, state in found.items()]
    columns = zip(*rows) if rows else [()] * 5
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["_file", "_split", "_outside", "_inside", "_opened"]
    )


def open_splits(spark: SparkSession, path: str | list[str]) -> tuple[bool, list[tuple[str, int, bool, bool]]]:
    """Whether any record has a line break, and the splits that start or end inside a quoted cell, with both states.

    Only lines with a quote leave the JVM. What reaches the driver has at most one row per split, as the scan's own
    listing has.
    """
    quoted = _lines(spark, path).filter("instr(_line, '\"') > 0")
    effects = quoted.mapInArrow(
        _effects, "_file string, _split bigint, _outside boolean, _inside boolean, _opened boolean"
    ).collect()  # one row per split with a quote
    if not any(r._opened for r in effects):
        return False, []
    # A split in which a line starts but no quote is found ends as it started.
    changes = {(r._file, r._split): (r._outside, r._inside) for r in effects}
    splits = _lines(spark, path).groupBy("_file", "_split").agg(F.count("*")).collect()
    found, state, last = [], False, None
    for file, split in sorted((r._file, r._split) for r in splits):
        if file != last and state:
            break
        start, last = state, file
        state = changes.get((file, split), (False, True))[state]
        if start or state:
            found.append((file, split, start, state))
    if state:
        raise CsvError(f"{last}: a quoted cell does not end")
    return True, found


def _cut(batches, starts: set, header: list[str], fragments: bool):
    """Records of the splits as they come, or the pieces that run over a split's end."""

    def rows():
        key, kind, held, at, fresh = None, None, [], 0, False
        for batch in batches:
            for line, file, split, seq in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if (file, split) != key:
                    if held:
                        yield _MIDDLE if kind == _TAIL else _HEAD, "\n".join(held), *key, at
                    key, held = (file, split), []
                    kind, at, fresh = (_TAIL if key in starts else None), seq, split == 0
                if held or kind == _TAIL:
                    held.append(line)
                    if ends_inside(line, True):
                        continue
                    whole, own = "\n".join(held), kind
                    held, kind = [], None
                    if own == _TAIL:
                        yield _TAIL, whole, *key, at
                        continue
                elif not line.strip():
                    continue
                else:
                    at = seq
                    if ends_inside(line, False):
                        held = [line]
                        continue
                    whole = line
                if fresh:
                    fresh = False
                    names = next(csv.reader([whole.removeprefix("﻿").removesuffix("\r")]))
                    if names != header:
                        raise CsvError(f"{file}: the header is {names}, not {header}")
                    continue
                yield None, whole, *key, at
        if held:
            yield _MIDDLE if kind == _TAIL else _HEAD, "\n".join(held), *key, at

    names = ["_kind", "_line", *_PLACE]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
    block = []
    for row in rows():
        if (row[0] is not None) == fragments:
            block.append(row)
            if len(block) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names)
                block = []
    columns = zip(*block) if block else [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def records(spark: SparkSession, path: str | list[str], header: list[str], states: list[tuple[str, int, bool, bool]]) -> DataFrame:
    """``_line`` (a whole record, which may hold line breaks) and its place, without headers and blank records.

    ``states`` are the splits that start or end inside a quoted cell. No task sees more of a file than its split; only
    records that run over a split's end meet again, by a window over at most two pieces of each split of a file.
    """
    starts = {(file, split) for file, split, start, _ in states if start}
    kind = f"_kind string, {_LINE}"
    whole = _lines(spark, path).mapInArrow(lambda b: _cut(b, starts, header, False), kind).drop("_kind")
    if not states:
        return whole
    # The rows of a split have to stay in their order, so this list, one row per split at most, is broadcast.
    border = F.broadcast(spark.createDataFrame([s[:2] for s in states], "_file string, _split bigint"))
    pieces = _lines(spark, path).join(border, ["_file", "_split"], "left_semi").select("_line", *_PLACE)
    pieces = pieces.mapInArrow(lambda b: _cut(b, starts, header, True), kind)
    numbered = pieces.selectExpr(
        "*", f"count_if(_kind = '{_HEAD}') OVER (PARTITION BY _file ORDER BY _split, _seq ROWS UNBOUNDED PRECEDING) AS _record"
    )
    first = "_parts[0]"
    joined = numbered.groupBy("_file", "_record").agg(
        F.expr("array_sort(collect_list(struct(_split, _seq, _line))) AS _parts")  # one record's pieces
    )
    spanning = joined.selectExpr(
        "array_join(transform(_parts, p -> p._line), '\n') AS _line", "_file", f"{first}._split AS _split", f"{first}._seq AS _seq"
    )
    return whole.unionByName(spanning)
