"""Arrival ordinals of rows read from files: the same for any number of tasks and any split size, without a shuffle."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from gaugeflow import contract as C
from gaugeflow.functions import name, quote

#: Columns a scan adds so that rows can be ordered; only a scan itself can tell them. Along a split ``_seq`` increases.
SCAN_PLACE = [
    "input_file_name() AS _file",
    "input_file_block_start() AS _split",
    "monotonically_increasing_id() AS _seq",
]


def ordinal(source: str = "0", file: str = "''", split: str = "0L", row: str = "0L") -> str:
    """SQL for an ordinal, a struct that orders by source, file, place of the split and row, however many there are."""
    parts = f"cast({source} AS int), cast({file} AS string), cast({split} AS bigint), cast({row} AS bigint)"
    return f"cast(struct({parts}) AS {C.ORDINAL.simpleString()})"


def by_file(rows: DataFrame, files: list[str], into: str = C.ARRIVAL) -> DataFrame:
    """Replace the columns of SCAN_PLACE by the ordinal: files in the order of their names, then place in the file.

    ``files`` is the scan's own listing; what all names start with is cut off. A split may share its task with others,
    but its own rows are numbered in their order.
    """
    shared = len(os.path.commonprefix(files).rpartition("/")[0])
    own = [c for c in rows.columns if c not in ("_file", "_split", "_seq")]
    return rows.selectExpr(
        *map(name, own), f"{ordinal(file=f'substring(_file, {shared + 1})', split='_split', row='_seq')} AS {name(into)}"
    )


def in_source_order(rows: DataFrame, position: int) -> DataFrame:
    """Put the ordinals of one source after those of the sources before it."""
    kept = [c for c in rows.columns if c != C.ARRIVAL]
    moved = ordinal(str(position), *[f"{C.ARRIVAL}.{part}" for part in ("arquivo", "trecho", "linha")])
    return rows.selectExpr(*map(name, kept), f"{moved} AS {C.ARRIVAL}")


#: Comes after every file name.
LATE = chr(0x10FFFF)


def with_arrival(df: DataFrame, column: str = C.ARRIVAL) -> DataFrame:
    """Make sure every row has an arrival ordinal; existing ones, whole numbers or ordinals, keep their order.

    Rows without one arrive after all others, in the order they are read.
    """
    here = "monotonically_increasing_id()"
    if column not in df.columns:
        return df.selectExpr("*", f"{ordinal(row=here)} AS {name(column)}")
    kept = [c for c in df.columns if c != column]
    given = name(column) if df.schema[column].dataType.simpleString().startswith("struct") else ordinal(row=name(column))
    late = ordinal(file=quote(LATE), row=here)
    return df.selectExpr(*map(name, kept), f"if({name(column)} IS NULL, {late}, {given}) AS {name(column)}")
