"""Records of delimited text files, cut in parallel even where quoted fields hold line breaks.

Files are read as lines, in splits as usual. A line break belongs to a field if an odd number of quotes
stands before it in the file, so the parity of quotes decides. One pass counts quotes per split; a window
over splits, one row each, gives the parity at which each begins. The second pass then joins the lines of
a record within a split; what a record has in several splits is sent on as fragments, and only these are
grouped. Files without such lines, found in the first pass, are taken line by line without any of this.

Only the count of quotes matters: doubled quotes keep the parity. Lines end with a line feed; a carriage
return before it is dropped at the end of a record and kept within a field. A byte order mark is dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Splits up to which their parities are broadcast; beyond it the lines are shuffled and sorted instead.
BROADCAST_SPLITS = 100_000
#: Files with a record in several splits up to which only the lines of these files are joined for the fragments.
FILES_LISTED = 1000
RECORD, HEAD, TAIL = 0, 1, 2
NAMES = ["kind", "file", "start", "first", "record"]
_PIECES = "kind int, file string, start long, first boolean, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"),
    )


def records(
    spark: SparkSession, path: str, quote: str | None = '"', header: bool = False, blank_lines: bool = False
) -> DataFrame:
    """``(record, file)``: every record of the file, or of all files of a folder; blank lines only if asked for.

    ``header`` leaves out the first record of each file. ``quote=None`` is for files without quoting. A
    quote that is never closed makes one record of the rest of its file.
    """
    lines = _lines(spark, path)
    splits = _parities(lines, quote) if quote else None
    if splits is None and not header:
        rows = lines.select(F.regexp_replace("line", "^﻿", "").alias("record"), "file")
        return _cleaned(rows, blank_lines)
    pieces = _pieces(lines, splits, quote)
    whole = pieces.filter(F.col("kind") == RECORD)
    if splits is not None:
        broken = splits.filter("(parity + odd) % 2 = 1").select("file").distinct()
        found = broken.limit(FILES_LISTED + 1).count()
        if found:
            # A join, not a filter by name: that would leave out files before they are split, and so change the splits.
            some = lines.join(F.broadcast(broken), "file", "left_semi") if found <= FILES_LISTED else lines
            whole = whole.unionByName(_stitched(_pieces(some, splits, quote).filter(F.col("kind") != RECORD)))
    return _cleaned((whole.filter("NOT first") if header else whole).select("record", "file"), blank_lines)


def _cleaned(rows: DataFrame, blank_lines: bool) -> DataFrame:
    rows = rows.withColumn("record", F.regexp_replace("record", "\r$", ""))
    return rows if blank_lines else rows.filter("record <> ''")


def _parities(lines: DataFrame, quote: str) -> DataFrame | None:
    """``(file, start, parity, odd)``: parity of the quotes before each split, and lines with an odd number in
    it; None if there are no such lines at all."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    splits = written(lines.groupBy("file", "start").agg(F.sum(quotes % 2).alias("odd")), "splits")
    if splits.filter("odd > 0").isEmpty():
        return None
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return written(splits.withColumn("parity", F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)).cast("int")), "parities")


def _pieces(lines: DataFrame, splits: DataFrame | None, quote: str | None) -> DataFrame:
    """Lines joined to records within each split; ``kind`` tells whole records from the end of one that began
    in an earlier split (HEAD) and the beginning of one that goes on in the next (TAIL)."""
    if splits is None:
        parities = lines.withColumn("parity", F.lit(0))
    else:
        unknown = F.raise_error(F.lit("the files were split differently in the second pass; read them again"))
        known = splits.select("file", "start", "parity")
        if splits.count() <= BROADCAST_SPLITS:
            parities = lines.join(F.broadcast(known), ["file", "start"], "left")
        else:
            parities = lines.join(known, ["file", "start"], "left").repartition("file", "start").sortWithinPartitions("file", "start", "id")
        parities = parities.withColumn("parity", F.coalesce("parity", unknown.cast("int")))

    def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, out, waiting, kind, first = None, [], [], RECORD, False

        def close(last: bool = False):
            """Give out what waits as one piece; at the end of a split it goes on in the next one."""
            nonlocal waiting, kind, first
            if waiting:
                out.append((kind if not last or kind == HEAD else TAIL, *split, first, "\n".join(waiting)))
                first = False
            waiting, kind = [], RECORD

        def given():
            nonlocal out
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.string())
            out = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=NAMES)

        opened = False
        for batch in batches:
            if not batch.num_rows:
                continue
            odd = pc.bit_wise_and(pc.count_substring(batch.column("line"), quote), 1) if quote else pa.array([0] * batch.num_rows)
            ends = {(batch.column("file")[k].as_py(), batch.column("start")[k].as_py()) for k in (0, -1)}
            if ends == {split} and not opened and not pc.max(odd).as_py():  # every line is a record
                kinds = pa.array([RECORD] * batch.num_rows, pa.int32())
                none = pa.array([False] * batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [kinds, batch.column("file"), batch.column("start"), none, batch.column("line")], names=NAMES
                )
                continue
            odd = odd.to_pylist()
            for file, start, line, parity, is_odd in zip(
                *(batch.column(c).to_pylist() for c in ("file", "start", "line", "parity")), odd
            ):
                if (file, start) != split:
                    close(last=opened)
                    split, opened, first = (file, start), bool(parity), start == 0
                    kind = HEAD if opened else RECORD
                    if first:
                        line = line.removeprefix("﻿")
                waiting.append(line)
                if is_odd:
                    opened = not opened
                if not opened:
                    close()
            yield given()
        close(last=opened)
        yield given()

    return parities.select("file", "start", "line", "parity").mapInArrow(join_lines, _PIECES)


def _stitched(fragments: DataFrame) -> DataFrame:
    """Records that several splits have a part of."""
    order = Window.partitionBy("file").orderBy("start", "kind")
    begun = F.last(F.when(F.col("kind") == TAIL, F.struct("start", "first")), ignorenulls=True).over(order)
    rows = fragments.withColumn("begun", begun)
    parts = F.sort_array(F.collect_list(F.struct("start", "record")))
    joined = rows.groupBy("file", "begun").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    return joined.select(F.lit(RECORD).alias("kind"), "file", "begun.start", "begun.first", "record")
