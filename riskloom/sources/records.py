"""Quoted CSV read by all cores: tasks take byte ranges, parities of quotes tell where records start."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.longform import POSITION, named, quoted
from riskloom.session import scratch_path
from riskloom.sources.schema import DECIMAL_PATTERN, INTEGER_PATTERN

#: Kinds of cells, each above the ones before it.
KINDS = ("BIGINT", "NUMERIC", "TEXT")
COMPLETE, HEAD, TAIL = 0, 1, 2


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file, block, value: every line, with the byte range of its file that it is read with, in order within a range."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def survey_splits(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """split, file, block, starts_inside, ends_inside, header: one row per byte range, kept in the session's shared folder.

    A range starts inside a quoted cell when the ranges before it in its file hold
    an odd number of quotes. One scan counts them, one row per range is shuffled.
    ``header`` is the first line of the file in its first range, else NULL.
    """
    lines = _lines(spark, paths).withColumn("id", F.monotonically_increasing_id())
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(
        F.sum(quotes).alias("quotes"), F.when(F.col("block") == 0, F.min_by("value", "id")).alias("header")
    )
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    placed = counted.select(
        F.monotonically_increasing_id().alias("split"),
        "file",
        "block",
        (inside == 1).alias("starts_inside"),
        ((inside + F.col("quotes")) % 2 == 1).alias("ends_inside"),
        F.regexp_replace("header", "^﻿|\r$", "").alias("header"),
    )
    path = scratch_path(spark, "csv-splits")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def header_names(line: str, file: str) -> list[str]:
    """Column names of a header line; ``file`` is named where they are not usable."""
    if line.count('"') % 2:
        raise ValueError(f"{file}: a column name goes over several lines")
    names = next(csv.reader([line]), [])
    if not names or any(not name.strip() for name in names):
        raise ValueError(f"{file}: a column has no name")
    if len(names) != len(set(names)):
        raise ValueError(f"{file}: two columns share a name")
    return names


def _require_closed(splits: DataFrame) -> None:
    """No file may end inside a quoted cell."""
    last = splits.groupBy("file").agg(F.max_by("ends_inside", "block").alias("open")).where("open")
    open_files = [row["file"] for row in last.orderBy("file").limit(3).collect()]
    if open_files:
        raise ValueError(f"a quote is never closed: {open_files}")


def _cut(batches: Iterable[pa.RecordBatch], wanted: frozenset[int]) -> Iterator[pa.RecordBatch]:
    """Records of the lines (split, start, value): complete ones, and what a range has of those over its edges.

    ``start`` says that a range starts outside a cell (0), inside one (1), or with the header (2).
    A record starts at a line before which the number of quotes is even. Lines of
    records that are one line pass through as they are; only the last, open record
    is kept from batch to batch.
    """
    split, inside, first, pending = None, 0, False, []

    def piece(place: int, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.array([split] * n, pa.int64()), pa.array([place] * n, pa.int32()), texts]
        return pa.RecordBatch.from_arrays(columns, names=["split", "place", "record"])

    def left_over() -> Iterator[pa.RecordBatch]:
        if pending:
            place = HEAD if first else TAIL if inside else COMPLETE
            if place in wanted:
                yield piece(place, pa.array(["\n".join(pending)], pa.string()))

    for batch in batches:
        splits = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(splits)]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            if splits[low] != split:
                yield from left_over()
                start = batch.column(1)[low].as_py()
                split, inside, pending = int(splits[low]), int(start == 1), []
                # a range that starts inside a cell starts with the rest of another range's record
                first = bool(inside)
                low += start == 2
                if low == high:
                    continue
            lines = batch.column(2).slice(low, high - low)
            quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
            after = (inside + np.cumsum(quotes)) % 2
            starts = np.flatnonzero(np.concatenate(([inside], after[:-1])) == 0)
            inside = int(after[-1])
            if not len(starts):
                pending += lines.to_pylist()
                continue
            if starts[0] or pending:
                pending += lines.slice(0, int(starts[0])).to_pylist()
                if pending:
                    place = HEAD if first else COMPLETE
                    if place in wanted:
                        yield piece(place, pa.array(["\n".join(pending)], pa.string()))
            first, pending = False, []
            # the last record may go on in the next batch, unless all of its quotes are closed
            closed = starts if not inside else starts[:-1]
            end = len(lines) if not inside else int(starts[-1])
            if len(closed) and COMPLETE in wanted:
                begin = int(closed[0])
                texts = lines.slice(begin, end - begin)
                if len(closed) < len(texts):
                    offsets = np.append(closed - begin, end - begin).astype(np.int32)
                    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), texts), "\n")
                yield piece(COMPLETE, texts)
            if inside:
                pending = lines.slice(int(starts[-1])).to_pylist()
    yield from left_over()


def _pieces(spark: SparkSession, paths: str | Sequence[str], splits: DataFrame, *places: int) -> DataFrame:
    """split, place, record of the pieces of the wanted kinds.

    The broadcast table has one row per byte range, as many as Spark's own list of
    the ranges on the driver. A range that is not in it, because the number of
    cores changed between the two scans and the files were cut elsewhere, stops the job.
    """
    known = F.broadcast(
        splits.select("file", "block", "split", F.when(F.col("block") == 0, 2).otherwise(F.col("starts_inside").cast("int")).alias("start"))
    )
    changed = F.raise_error(F.concat(F.lit("files are cut differently than when they were surveyed, read again: "), F.col("file")))
    lines = _lines(spark, paths).join(known, ["file", "block"], "left")
    lines = lines.select(F.coalesce("split", changed.cast("long")).alias("split"), "start", "value")
    wanted = frozenset(places)
    return lines.mapInArrow(lambda batches: _cut(batches, wanted), "split long, place int, record string")


def csv_records(spark: SparkSession, paths: str | Sequence[str], splits: DataFrame | None = None) -> DataFrame:
    """file, header, record: every record of quoted CSV files as text, without headers and empty lines.

    Three scans at most and no shuffle of whole records: the survey, the records
    that lie in one range, and, where ranges start inside cells, the pieces of
    records that lie in several, at most two a range, which are put together by
    file. Line breaks in cells stay as they are. Quotes stand around whole cells
    and are doubled inside; a file with an odd number of them is an error.
    """
    splits = survey_splits(spark, paths) if splits is None else splits
    _require_closed(splits)
    places = F.broadcast(splits.select("split", "file", "block"))
    records = _pieces(spark, paths, splits, COMPLETE).join(places, "split").select("file", "record")
    if splits.where("starts_inside").limit(1).count():
        parts = _pieces(spark, paths, splits, HEAD, TAIL).join(places, "split")
        until = W.partitionBy("file").orderBy("block", "place").rowsBetween(W.unboundedPreceding, 0)
        parts = parts.withColumn("number", F.sum((F.col("place") == TAIL).cast("int")).over(until))
        pieces = F.sort_array(F.collect_list(F.struct("block", "record")))
        joined = parts.groupBy("file", "number").agg(F.array_join(F.transform(pieces, lambda x: x["record"]), "\n").alias("record"))
        records = records.unionByName(joined.select("file", "record"))
    headers = F.broadcast(splits.where("block = 0").select("file", "header"))
    records = records.join(headers, "file").select("file", "header", F.regexp_replace("record", "\r$", "").alias("record"))
    return records.where(F.length("record") > 0)


def file_headers(splits: DataFrame) -> dict[str, tuple[str, ...]]:
    """Column names by header line, in the order of the first file that has the line; one row a distinct line comes to the driver."""
    lines = splits.where("block = 0").groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
    return {line["header"]: tuple(header_names(line["header"], line["file"])) for line in lines}


def _parsed(record: str, schema: T.StructType, malformed: str | None, strict: bool) -> Column:
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE", "nullValue": "", "quote": '"', "escape": '"', "multiLine": "true"}
    if malformed is not None:
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
        options["columnNameOfCorruptRecord"] = malformed
    ddl = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in schema.fields)
    return F.from_csv(record, ddl, options)


def read_split_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    types: Mapping[str, T.DataType] | None = None,
    malformed: str | None = None,
    strict: bool = False,
    file: str | None = None,
) -> DataFrame:
    """Header CSV files with line breaks in cells, read by as many tasks as there are byte ranges.

    Files of one table may differ in their columns and in the order of them: every
    file is read by its own header and columns are united by name, in the order
    in which the files, by path, bring them; a column that a file lacks is NULL there.
    All columns are text but those that ``types`` gives a type. Empty cells are
    NULL. A row with too few or too many cells keeps those that have a column;
    ``malformed`` names a further column with the whole record of such a row,
    ``strict`` stops at the first one. ``file`` names a further column with the
    file of a row. A file without any line has no rows; names in another case or
    with other blanks are other columns. Cells follow the dialect of
    :func:`riskloom.sources.sinks.export_table_csv`: a quote inside a cell that
    is not quoted itself is not told from the start of a cell.
    """
    splits = survey_splits(spark, path)
    headers = file_headers(splits)
    if not headers:
        raise ValueError(f"{path}: no header line")
    names = list(dict.fromkeys(name for columns in headers.values() for name in columns))
    taken = [name for name in (malformed, file) if name in names]
    if taken:
        raise ValueError(f"{path}: there is a column {taken[0]!r}")
    kinds = {name: (types or {}).get(name, T.StringType()) for name in names}
    out = [*names, *([malformed] if malformed else [])]
    row = F.lit(None)
    for line, columns in headers.items():
        schema = T.StructType([T.StructField(name, kinds[name]) for name in columns])
        cells = _parsed("record", schema, malformed, strict)
        there = {*columns, malformed}
        united = F.struct(
            *[(cells.getField(name) if name in there else F.lit(None)).cast(kinds.get(name, T.StringType())).alias(name) for name in out]
        )
        row = F.when(F.col("header") == line, united).otherwise(row) if len(headers) > 1 else united
    rows = csv_records(spark, path, splits).select("file", row.alias("row"))
    kept = [F.col("row").getField(name).alias(name) for name in out]
    return rows.select(*kept, *([F.col("file").alias(file)] if file else []))


def file_types(texts: DataFrame, file: str, columns: Sequence[str] | None = None) -> DataFrame:
    """file, column_name, non_empty, inferred_type of every text column in every file that has a value in it.

    The kinds form a lattice: a column without values is below BIGINT, that below
    NUMERIC, and TEXT is above all; :func:`merged_types` joins files by it. One
    scan; what is shuffled is one row per task, file and column.
    """
    names = [name for name in texts.columns if name != file] if columns is None else list(columns)
    cell = F.nullif(F.trim(F.col("value")), F.lit(""))
    whole = cell.rlike(INTEGER_PATTERN) & cell.try_cast("bigint").isNotNull()
    cells = texts.select(F.col(quoted(file)).alias("file"), F.posexplode(F.array(*[F.col(quoted(n)) for n in names])).alias(POSITION, "value"))
    seen = cells.where(cell.isNotNull()).groupBy("file", POSITION).agg(
        F.count(F.lit(1)).alias("non_empty"), F.bool_and(whole).alias("whole"), F.bool_and(cell.rlike(DECIMAL_PATTERN)).alias("number")
    )
    kind = F.when(F.col("whole"), "BIGINT").when(F.col("number"), "NUMERIC").otherwise("TEXT")
    return named(seen.select(POSITION, "file", "non_empty", kind.alias("inferred_type")), names, "column_name").select(
        "file", "column_name", "non_empty", "inferred_type"
    )


def merged_types(found: DataFrame) -> DataFrame:
    """column_name, non_empty, inferred_type: the least kind above those of all files."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("inferred_type"))
    merged = found.groupBy("column_name").agg(F.sum("non_empty").alias("non_empty"), F.max(rank).alias("rank"))
    return merged.select("column_name", "non_empty", F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank").cast("int")).alias("inferred_type"))


def type_clashes(found: DataFrame) -> DataFrame:
    """column_name, file, file_type, merged_type where one file's numbers become text because of another file."""
    merged = merged_types(found).select("column_name", F.col("inferred_type").alias("merged_type"))
    both = found.join(merged, "column_name").where((F.col("merged_type") == "TEXT") & (F.col("inferred_type") != "TEXT"))
    return both.select("column_name", "file", F.col("inferred_type").alias("file_type"), "merged_type")
