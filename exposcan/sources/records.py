"""Tabular records as ``file, row_no, fields``; see ``functions.tabular`` for fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exposcan.functions.tabular import csv_cells, csv_columns, csv_fields, csv_rows
from exposcan.functions.text import python_float
from exposcan.session import with_once


def csv_record_texts(files: DataFrame, file: str, text: str) -> DataFrame:
    """``file, row_no, record, columns, width``: records of csv texts, not yet cut into cells."""
    read = with_once(files.select(F.col(file).alias("file"), F.col(text).alias("text")), rows=csv_rows(F.col("text")))
    header = F.get("rows", F.lit(0))
    return (
        read.select("file", "rows", csv_columns(header).alias("columns"), F.size(csv_cells(header)).alias("width"))
        .select("file", "columns", "width", F.posexplode("rows").alias("pos", "record"))
        .where(F.col("pos") > 0)
        .select("file", F.col("pos").cast("bigint").alias("row_no"), "record", "columns", "width")
    )


def cut_records(rows: DataFrame) -> DataFrame:
    """``file, row_no, fields`` of record texts under their columns."""
    fields = csv_fields(F.col("columns"), F.col("width"), F.col("record"))
    return rows.select("file", "row_no", fields.alias("fields"))


def read_records(files: DataFrame, file: str, text: str) -> DataFrame:
    """Records of csv texts, each under its own header, without a shuffle."""
    return cut_records(csv_record_texts(files, file, text))


def sheet_records(table: DataFrame, file: Column, row_no: Column, columns: list[str]) -> DataFrame:
    """Records of a typed table: missing cells are empty text, numbers stay numbers.

    As in the published reader, the type of a column is that of its file: a gap makes all whole numbers of the column floats
    there (``5`` becomes ``5.0``), booleans stay what they are. Gaps are found by one aggregate; files without any are joined
    with nothing. Columns that cannot be null, by the schema, have none.
    """
    types = [table.schema[name].dataType for name in columns]
    filled = [not table.schema[name].nullable for name in columns]
    cells = F.struct(*[F.col(f"`{name}`").alias(f"c{k}") for k, name in enumerate(columns)])
    rows = table.select(file.alias("file"), row_no.cast("bigint").alias("row_no"), cells.alias("cells"))
    whole = [k for k, kind in enumerate(types) if isinstance(kind, T.IntegralType) and not filled[k]]
    gaps = {}
    if whole:
        found = rows.groupBy("file").agg(F.array(*[F.bool_or(F.col(f"cells.c{k}").isNull()) for k in whole]).alias("gaps"))
        rows = rows.join(found.where(F.exists("gaps", lambda g: g)), "file", "left")
        gaps = {k: F.coalesce(F.get("gaps", F.lit(place)), F.lit(False)) for place, k in enumerate(whole)}
    fields = [_cell(name, types[k], F.col(f"cells.c{k}"), gaps.get(k)) for k, name in enumerate(columns)]
    return rows.select("file", "row_no", F.array(*fields).alias("fields"))


def _cell(name: str, kind: T.DataType, column: Column, gap: Column | None) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        missing, value, number = column.isNull() | F.isnan(column), python_float(column), True
    elif isinstance(kind, T.IntegralType):
        missing, value, number = column.isNull(), column.cast("string") if gap is None else F.when(gap, python_float(column)).otherwise(column.cast("string")), True
    elif isinstance(kind, T.BooleanType):
        missing, value, number = column.isNull(), column.cast("string"), True
    else:
        missing, value, number = column.isNull(), column.cast("string"), False
    return F.struct(
        F.lit(name).alias("name"),
        F.when(missing, F.lit("")).otherwise(value).alias("value"),
        (F.lit(number) & ~missing).alias("raw"),
    )
