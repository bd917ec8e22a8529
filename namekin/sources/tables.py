"""Readers and writers: catalog tables, CSV with header, headerless delimited text, parquet.

Text files follow the usual rules: a value with a separator, quote or line break is quoted, a quote in it
doubled, backslashes are plain characters. A null is written as nothing and a blank as two quotes, so the two
stay apart. Files of other writers are read by the same functions: quoted line breaks and all, in parallel
(``sources.delimited``), and without quoting where there is none (``quote=None``).

A row with too many or too few fields, an open quote or a value of the wrong kind is a bad row. Readers fail on
the first one, or give it in a column of its own, by choice; none is repaired or lost silently.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from namekin.operators.cleaning import in_trailing_window
from namekin.sources.delimited import records

BAD_ROW = "bad_row"
#: What the parser gives for an unquoted blank field; no text holds this.
_NOTHING = "\x00nothing\x00"
_WRITE = {
    "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""', "charToEscapeQuoteEscaping": "\x00",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def read_records(
    source: DataFrame,
    columns: Mapping[str, str],
    markets: Sequence[str] | None = None,
    as_of: str | None = None,
    months: int = 12,
) -> DataFrame:
    """Records ``(record_id, raw_name, market[, as_of])`` of a table, filtered before projection.

    ``columns`` maps these names to the columns of ``source``, e.g. ``spark.table("accounts")``.
    """
    rows = source.select(*[F.col(theirs).alias(ours) for ours, theirs in columns.items()])
    if as_of is not None:
        return in_trailing_window(rows, as_of, months, markets=markets)
    return rows.filter(F.col("market").isin(list(markets))) if markets is not None else rows


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    limit: int | None = None,
    quote: str | None = '"',
    null_text: str | None = None,
    bad_rows: str = "fail",
) -> DataFrame:
    """CSV with a header line in each file; ``limit`` takes the first rows only, for a preview.

    The other options are those of ``read_delimited``.
    """
    rows = _read(spark, path, schema, ",", True, quote, null_text, bad_rows)
    return rows.limit(limit) if limit is not None else rows


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    separator: str = "\t",
    quote: str | None = '"',
    null_text: str | None = None,
    bad_rows: str = "fail",
) -> DataFrame:
    """Headerless delimited text; all files of a folder.

    ``quote=None`` takes quotes as plain characters. A field with nothing in it is null, or, if ``null_text``
    is given, blank, and a field with just that text is null. ``bad_rows="fail"`` raises an error when a bad
    row is read; with ``"column"`` the result has a further column ``bad_row`` with the file and text of a bad row as
    it stands, null for others; see ``good_rows``, ``rejected`` and ``reject_counts``.
    """
    return _read(spark, path, schema, separator, False, quote, null_text, bad_rows)


def _read(spark, path, schema, separator, header, quote, null_text, bad_rows) -> DataFrame:
    if bad_rows not in ("fail", "column"):
        raise ValueError(f"unknown choice for bad rows {bad_rows!r}")
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    texts = StructType().add("_corrupt", StringType())
    for f in wanted.fields:
        texts = texts.add(f.name, f.dataType if null_text is None else StringType())
    options = {
        "sep": separator, "quote": quote or "", "escape": quote or "", "multiLine": "true", "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt", "emptyValue": "", "charToEscapeQuoteEscaping": "\x00", "nullValue": _NOTHING,
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    # with one column a blank line is a row: its null
    found = records(spark, path, quote, header, blank_lines=len(wanted) == 1).select(
        "file", "record", F.from_csv("record", texts.simpleString(), options).alias("row")
    )
    broken = F.col("row._corrupt").isNotNull()
    if quote:
        quotes = F.length("record") - F.length(F.replace("record", F.lit(quote), F.lit("")))
        broken = broken | (quotes % 2 == 1)
    columns = []
    for f in wanted.fields:
        value = F.col(f"row.`{f.name}`")
        if null_text is not None:
            value = F.when(value == null_text, None).otherwise(F.coalesce(value, F.lit("")))
            if not isinstance(f.dataType, StringType):
                text, value = F.nullif(value, F.lit("")), F.nullif(value, F.lit("")).try_cast(f.dataType)
                broken = broken | (text.isNotNull() & value.isNull())
        columns.append(value.alias(f.name))
    if bad_rows == "column":
        return found.select(*columns, F.when(broken, F.struct("file", "record")).alias(BAD_ROW))
    failure = F.raise_error(F.concat(F.lit("bad row in "), F.col("file"), F.lit(": "), F.substring("record", 1, 200)))
    return found.filter(F.when(broken, failure.cast("boolean")).otherwise(True)).select(*columns)


def good_rows(df: DataFrame) -> DataFrame:
    """The rows that were read as they should be, without the column of the bad ones."""
    return df.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW)


def rejected(df: DataFrame) -> DataFrame:
    """``(file, record)`` of the bad rows, to be kept as a table."""
    return df.filter(F.col(BAD_ROW).isNotNull()).select(f"{BAD_ROW}.file", f"{BAD_ROW}.record")


def reject_counts(df: DataFrame) -> DataFrame:
    """``(file, n)``: bad rows per file."""
    return rejected(df).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line, replacing what is there. A null in a table of one column is an error: its line
    would be blank, and the writer leaves blank lines out."""
    if len(df.columns) == 1:
        null = F.raise_error(F.lit("a null in a table of one column cannot be written as CSV")).cast("boolean")
        df = df.filter(F.when(F.col(f"`{df.columns[0]}`").isNull(), null).otherwise(True))
    df.write.mode("overwrite").options(**_WRITE, header=True).csv(path)


def write_delimited(
    df: DataFrame, path: str, separator: str = "\t", single_file: bool = False
) -> None:
    """Headerless delimited text, replacing what is there.

    With ``single_file`` the folder holds one file. All tasks write their parts as ever; the parts are then
    joined in their order by the file system.
    """
    parts = f"{path.rstrip('/')}-parts-{uuid.uuid4().hex}" if single_file else path
    if len(df.columns) == 1:  # a null is a blank line, which the delimited writer leaves out
        value = F.replace(F.col(f"`{df.columns[0]}`").cast("string"), F.lit('"'), F.lit('""'))
        line = F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit(""))
        df.select(line.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(parts)
    else:
        df.write.mode("overwrite").options(**_WRITE, sep=separator).csv(parts)
    if single_file:
        _join_parts(df.sparkSession, parts, path)


def _join_parts(spark: SparkSession, parts: str, path: str) -> None:
    """Make the files of folder ``parts`` one file in folder ``path``, which is replaced.

    File systems that can put files together without reading them do so; for others the parts are copied one
    after the other, in buffers of a fixed size.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    source, target = new(parts), new(path)
    fs = source.getFileSystem(conf)
    files = sorted(s.getPath().toString() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    whole = new(f"{parts}/whole.csv")
    if not files:
        fs.create(whole).close()
    elif len(files) == 1:
        fs.rename(new(files[0]), whole)
    else:
        others = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(files) - 1)
        for k, name in enumerate(files[1:]):
            others[k] = new(name)
        try:
            fs.concat(new(files[0]), others)
            fs.rename(new(files[0]), whole)
        except UnsupportedOperationException:
            out = fs.create(whole)
            for name in files:
                opened = fs.open(new(name))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(opened, out, 1 << 20, False)
                opened.close()
            out.close()
    fs.delete(target, True)
    fs.mkdirs(target)
    fs.rename(whole, new(f"{path.rstrip('/')}/part-00000.csv"))
    fs.create(new(f"{path.rstrip('/')}/_SUCCESS")).close()
    fs.delete(source, True)


def save_table(
    df: DataFrame,
    table: str,
    columns: Sequence[str] | None = None,
    database: str | None = None,
    path: str | None = None,
) -> None:
    """Create or replace a catalog table from the listed columns; the database is created if new.

    ``path`` makes it an external table in that folder.
    """
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        table = f"{database}.{table}"
    writer = (df.select(*columns) if columns else df).write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def save_corrections(spelling: DataFrame, path: str) -> None:
    """Keep a correction table for later runs."""
    spelling.write.mode("overwrite").parquet(path)


def load_corrections(spark: SparkSession, path: str) -> DataFrame:
    """A correction table kept by ``save_corrections``."""
    return spark.read.schema("old_word string, new_word string, score double").parquet(path)
