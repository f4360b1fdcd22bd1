"""Extracts as text files: every line is read, and lines that are no row of the table are told apart.

A line is a row when its quotes are closed and doubled inside, and it has as
many fields as the table has columns.  Rows keep the file they came from;
other lines keep their text and why they are no row.  Fields stay text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE, LINE, FAULT = "_source_file", "_line", "_fault"
#: what is wrong with a line: quotes, too few or too many fields, bytes that are no UTF-8
QUOTES, SHORT, LONG, ENCODING = "quotes", "short", "long", "encoding"
#: what the parser puts for an empty field, so that it differs from a quoted empty one
_NULL = "\x00"
_QUOTED = '"(?:[^"]++|"")*+"'


def read_extract(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ",", header: bool = True
) -> DataFrame:
    """The columns as text, ``_source_file``, ``_line`` and ``_fault`` of every line that is not blank.

    A row has no fault; of a faulty line the columns are null.  An empty field is null, a quoted empty one the empty
    text.  With ``header`` lines that repeat the column names are left out, wherever files begin.  Files are split
    between tasks by lines, so a quoted field ends with its line.
    """
    if len(sep) != 1:
        raise ValueError("a separator is one character")
    one = re.escape(sep)
    field = rf'(?:{_QUOTED}|[^"{one}]*+)'
    lines = spark.read.text(path).select(F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE)).filter(F.col(LINE) != "")
    if header:
        names = [sep.join(columns), sep.join(f'"{c}"' for c in columns)]
        lines = lines.filter(~F.ltrim(LINE, F.lit("\ufeff")).isin(*names))
    sound = F.col(LINE).rlike(rf"^{field}(?:{one}{field})*+$")
    bare = F.regexp_replace(LINE, _QUOTED, "")
    fields = (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) + 1
    fault = (
        F.when(~F.is_valid_utf8(LINE), ENCODING)
        .when(~sound, QUOTES)
        .when(fields < len(columns), SHORT)
        .when(fields > len(columns), LONG)
    )
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv(LINE, F.lit(schema), {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "nullValue": _NULL})
    marked = lines.withColumn(FAULT, fault).withColumn("_row", F.when(F.col(FAULT).isNull(), parsed))
    return marked.select(*[F.col("_row").getField(c).alias(c) for c in columns], FILE, LINE, FAULT)


def rows(extract: DataFrame) -> DataFrame:
    """The lines that are rows, with the file each came from."""
    return extract.filter(F.col(FAULT).isNull()).drop(LINE, FAULT)


def rejected(extract: DataFrame) -> DataFrame:
    """The lines that are not, and why."""
    return extract.filter(F.col(FAULT).isNotNull()).select(FILE, LINE, FAULT)
