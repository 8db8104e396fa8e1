"""Text sources in the raw contract: plain CSV, the public AI4I file, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeflow import contract as C
from gaugeflow.functions import name, quote
from gaugeflow.functions.text import flags_to_text, null_tokens, padded_id
from gaugeflow.functions.times import format_timestamp, plus_minutes
from gaugeflow.sources import csv_records
from gaugeflow.sources.arrival import SCAN_PLACE, by_file, in_source_order, with_arrival

_RAGGED = "_ragged_record"


class SourceError(ValueError):
    """A source name or a source column is not what the contract expects."""


def read_text_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool | None = None
) -> DataFrame:
    """The named columns of CSV files with header, every cell as text, and the rows' arrival ordinal.

    Missing-value tokens become null; nothing else is interpreted. Cells missing at the end of a record are
    null, a record with more cells than the header is an error. Files count in the order of their names. Every file is
    read by many tasks. A record may hold line breaks inside quotes: a first pass over the lines with quotes tells
    whether there are any, and where a split starts inside a cell. Without any, and with ``multi_line=False``, which
    saves that pass where it is known that there are none, each line is a record.
    """
    options = {"header": True, "escape": '"', "enforceSchema": False}
    header = spark.read.options(**options).csv(path).schema
    absent = [c for c in columns if c not in header.names]
    if absent:
        raise SourceError(f"{path}: missing columns {absent}")
    # The reader hands over the text of a record whose cells do not match the header in number; it counts
    # them only where it is not told to skip columns.
    schema = T.StructType([*header, T.StructField(_RAGGED, T.StringType())])
    broken, states = (False, []) if multi_line is False else csv_records.open_splits(spark, path)
    if broken:
        lines = csv_records.records(spark, path, header.names, states)
        parsing = "map('escape', '\"', 'columnNameOfCorruptRecord', '{}')".format(_RAGGED)
        fields = ", ".join(f"{name(f.name)} STRING" for f in schema)
        parsed = f"from_csv(rtrim('\r', _line), {quote(fields)}, {parsing}) AS _cells"
        files = spark.read.text(path).inputFiles()
        cells = lines.selectExpr(parsed, "_file", "_split", "_seq").selectExpr("_cells.*", "_file", "_split", "_seq")
        place = ["_file", "_split", "_seq"]
    else:
        cells = spark.read.options(columnNameOfCorruptRecord=_RAGGED, columnPruning=False, **options).schema(schema).csv(path)
        files, place = cells.inputFiles(), SCAN_PLACE
    commas = f"length(regexp_replace({_RAGGED}, '\"([^\"]|\"\")*\"|[^,]', ''))"
    surplus = f"CASE WHEN {commas} >= {len(header)} THEN raise_error('a record has more cells than the header')"
    scanned = cells.selectExpr(
        *[f"{null_tokens(name(c))} AS {name(c)}" for c in columns],
        f"coalesce({surplus} END, true) AS _whole",
        *place,
    )
    return by_file(scanned.filter("_whole").drop("_whole"), files)


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """A source that already has the raw columns."""
    return read_text_csv(spark, path, C.RAW_COLUMNS, multi_line)


def read_ai4i(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """The public AI4I file in the raw contract."""
    columns = ["UDI", *C.AI4I_COLUMNS.values(), *C.FAILURE_MODES]
    return ai4i_to_raw(read_text_csv(spark, path, columns, multi_line))


def ai4i_to_raw(wide: DataFrame) -> DataFrame:
    """Wide AI4I rows -> raw rows.

    Row numbers rotate over the virtual machines; each full turn is one step in time. A missing or
    non-numeric row number is an error.
    """
    udi = "coalesce(cast(cast(UDI AS double) AS bigint), raise_error('UDI is missing'))"
    numbered = wide.selectExpr("*", f"cast({udi} - 1 AS bigint) AS _turn")
    minutes = f"cast((_turn div {C.AI4I_MACHINES}) * {C.AI4I_STEP_MINUTES} AS int)"
    made = {
        "fonte": quote("ai4i"),
        "maquina_id": padded_id("AI4I-", f"(_turn % {C.AI4I_MACHINES} + 1)", 2),
        "timestamp": format_timestamp(plus_minutes(C.AI4I_START, minutes)),
        "modo_falha": flags_to_text(C.FAILURE_MODES),
        **{ours: name(theirs) for ours, theirs in C.AI4I_COLUMNS.items()},
    }
    arrival = [C.ARRIVAL] if C.ARRIVAL in wide.columns else []
    return numbered.selectExpr(*[f"{made[c]} AS {name(c)}" for c in C.RAW_COLUMNS], *arrival)


def union_sources(sources: dict[str, DataFrame], selected: list[str] | None = None) -> DataFrame:
    """Bag union of the selected sources, in the order given, with an arrival ordinal.

    The ordinal follows the order of sources, then the order of rows inside each.
    """
    chosen = list(sources) if selected is None else list(selected)
    wrong = [s for s in chosen if s not in C.VALID_SOURCES]
    if wrong or not chosen:
        raise SourceError(f"invalid sources {wrong or chosen}; use {C.VALID_SOURCES}")
    ordered = [
        in_source_order(with_arrival(sources[s]).select(*C.RAW_COLUMNS, C.ARRIVAL), i)
        for i, s in enumerate(s for s in sources if s in chosen)
    ]
    return reduce(DataFrame.unionByName, ordered)
