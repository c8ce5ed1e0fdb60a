"""File sources (S5, S8, S9, S11) — all read with Spark's own readers."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# a value that never occurs in the data: keeps 'NA' and '' as text (q17)
_NO_NULL_TOKEN = "\u0000__no_null__"


def read_string_csv(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", quote: str = '"',
                    escape: str = "\\", header: bool = True) -> DataFrame:
    """All-string delimited files (header skipped, quote/escape honoured)."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    df = (spark.read.schema(schema).option("header", header).option("sep", sep).option("quote", quote)
          .option("escape", escape).option("nullValue", _NO_NULL_TOKEN).option("emptyValue", "")
          .option("mode", "PERMISSIVE").csv(path))
    return _blank_as_text(df)


def _blank_as_text(df: DataFrame) -> DataFrame:
    """Empty cells are '' (as a sheet reader without NA detection sees them);
    turning blanks into NULL is the explicit cleaning step P8."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])


def read_sheet_csv(spark: SparkSession, path: str) -> DataFrame:
    """A landed sheet: header row, every value text, 'NA' and blanks kept as text."""
    return _blank_as_text(spark.read.option("header", True).option("inferSchema", False)
                          .option("nullValue", _NO_NULL_TOKEN).option("emptyValue", "").csv(path))


def route_by_filename(spark: SparkSession, folder: str, routes: Mapping[str, str], suffix_pattern: str
                      ) -> DataFrame:
    """Every file of a landing folder tagged with its target table (first
    route whose pattern matches the file name) and with a literal parsed from
    the name's suffix, upper-cased.  Unrouted files keep a NULL target."""
    df = read_sheet_csv(spark, folder).withColumn("__file", F.col("_metadata.file_path"))
    target = None
    for pattern, table in routes.items():
        cond = F.col("__file").rlike(pattern)
        target = F.when(cond, F.lit(table)) if target is None else target.when(cond, F.lit(table))
    return df.withColumns({"target_table": target,
                           "name_literal": F.upper(F.regexp_extract("__file", suffix_pattern, 1))})


def read_matrix_sheet(spark: SparkSession, path: str, key: str = "period") -> DataFrame:
    """A sheet whose first line is a label and second line the header; the
    first column is the key.  A file is read whole, so the first two lines are
    known by their place and later lines that look like them stay data; fields
    keep quotes and commas, a quoted field ends with its line."""
    sheet = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.split("value", "\r?\n").alias("lines"))
    first = sheet.orderBy("file").select(F.slice("lines", 1, 2)).first()[0]
    label, header = (next(csv.reader([line])) for line in first)
    names = [key, *[h.strip() for h in header[1:]]]
    schema = ", ".join(f"`{n}` string" for n in names)
    data = sheet.select(F.posexplode("lines").alias("place", "line")).where((F.col("place") >= 2) & (F.length("line") > 0))
    cells = data.select(F.from_csv("line", schema, {"nullValue": _NO_NULL_TOKEN, "emptyValue": ""}).alias("c"))
    return cells.select("c.*").withColumn("label", F.lit(label[0].strip()))


def csv_cells(line: Column) -> Column:
    """The cells of a delimited line as an array: quoted cells lose their quotes, doubled quotes become one, blanks stay."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    inner = lambda c: F.replace(F.substring(c, 2, F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), inner(c)).otherwise(c))


def read_matrix_folder(spark: SparkSession, path: str, key: str = "period") -> DataFrame:
    """S9 for a folder of sheets of any widths: ``file, label, <key>, column_name, value``, a row per cell.

    Each file's first line is its label, its second its header; both are found where the file is read, by their place,
    and differing headers meet as rows, so no file decides for another and nothing passes through the driver.  Empty
    lines, cells beyond the header and columns without a name are left out; missing cells at a line's end are NULL; a
    file without a header gives no rows.  A sheet is read whole by a task, as sheets are; the folder may hold any number."""
    sheets = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.split("value", "\r?\n").alias("lines")).where(F.size("lines") >= 2)
    lines = sheets.select("file", F.trim(csv_cells(F.col("lines")[0])[0]).alias("label"), csv_cells(F.col("lines")[1]).alias("header"),
                          F.explode(F.slice("lines", 3, F.greatest(F.size("lines") - 2, F.lit(1)))).alias("line"))
    cells = lines.where(F.length(F.trim("line")) > 0).select("file", "label", "header", csv_cells(F.col("line")).alias("cells"))
    pairs = F.arrays_zip(F.expr("slice(header, 2, size(header))").alias("name"),
                         F.expr("transform(sequence(1, greatest(size(header) - 1, 1)), i -> get(cells, i))").alias("value"))
    out = cells.select("file", "label", F.col("cells")[0].alias(key), F.explode(pairs).alias("p"))
    return out.select("file", "label", key, F.trim("p.name").alias("column_name"), F.col("p.value").alias("value")).where(F.length("column_name") > 0)


def source_corpus(spark: SparkSession, root: str, glob: str = "*.{py,sql}") -> DataFrame:
    """Whole source files under ``root`` (recursive) as (path, text) rows."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
