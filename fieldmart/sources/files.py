"""Landing folders of text files with drifting headers: every file is read once, and gives its rows or one error.

Spark lists and opens the files, on whatever store they are; a task parses the bytes of a few files at a time as a whole. One pass gives the
rows, and for each file its columns with their inferred types, or why it can't be loaded.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as csv
from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.session import shared_folder, tasks_import_here

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"
_LANDED = "file_path string, last_modified timestamp, error string, n_rows long, columns array<struct<column: string, dtype: string>>, line long, cells map<string, string>"


@dataclass
class Landing:
    """What a folder's files gave. files: file_path, label (its folder), last_modified, error, n_rows, columns. rows: file_path, line, cells by column."""

    files: DataFrame
    rows: DataFrame

    def loaded(self) -> DataFrame:
        return self.files.filter("error is null")

    def failures(self) -> DataFrame:
        """file_path, label and error of the files that don't load."""
        return self.files.filter("error is not null").select("file_path", "label", "error")

    def column_types(self) -> DataFrame:
        """file (its label), column, dtype of each loaded file, as schema checks take them."""
        return self.loaded().select(F.col("label").alias("file"), F.explode("columns").alias("c")).select("file", "c.column", "c.dtype")

    def names(self) -> list[str]:
        """All columns of all files, by name: as many as the forms have, whatever the number of files."""
        return [r.column for r in self.column_types().select("column").distinct().orderBy("column").collect()]

    def table(self, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows with the given columns (all by default) as text, blanks as '', null where a file lacks the column; and file_path."""
        cell = lambda c: F.try_element_at("cells", F.lit(c)).alias(c)
        return self.rows.select("file_path", *[cell(c) for c in (self.names() if columns is None else columns)])


class Kind:
    """What the type of a column of text is taken from, batch by batch."""

    def __init__(self) -> None:
        self.blank, self.some, self.whole, self.number, self.truth = False, False, True, True, True

    def see(self, values: pa.ChunkedArray | pa.Array) -> None:
        text = pc.utf8_trim_whitespace(values)
        some = text.filter(pc.not_equal(text, ""))
        self.blank |= len(some) < len(text)
        if len(some):
            self.some = True
            self.whole = self.whole and pc.all(pc.match_substring_regex(some, _WHOLE)).as_py()
            self.number = self.number and pc.all(pc.match_substring_regex(some, _NUMBER)).as_py()
            self.truth = self.truth and pc.all(pc.is_in(some, pa.array(["True", "False", "TRUE", "FALSE", "true", "false"]))).as_py()

    def name(self) -> str:
        if not self.some:
            return "float64"
        if self.whole:
            return "float64" if self.blank else "int64"
        if self.number:
            return "float64"
        return "bool" if self.truth and not self.blank else "object"


def inferred(values: pa.ChunkedArray | pa.Array) -> str:
    """The type of a column of text: int64, float64 (numbers with fractions or blanks, and blanks alone), bool or object."""
    kind = Kind()
    kind.see(values)
    return kind.name()


def _parts(content: bytes | pa.Buffer) -> tuple[list[str], Iterator[pa.RecordBatch]]:
    """Names, and all columns as text, blanks as '', block by block. Either raises on what ``parsed`` says."""
    parse = csv.ParseOptions(newlines_in_values=True)
    # no threads: they read ahead of what is taken
    one = csv.ReadOptions(use_threads=False, block_size=BLOCK)
    names = csv.open_csv(pa.BufferReader(content), read_options=one, parse_options=parse).schema.names
    if len(set(names)) != len(names):
        raise ValueError("repeated column names")
    options = csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False)
    return names, iter(csv.open_csv(pa.BufferReader(content), read_options=one, parse_options=parse, convert_options=options))


def parsed(content: bytes) -> pa.Table:
    """All columns as text, blanks as ''. Raises on rows of another length than the header, bad text, an empty file and repeated names."""
    names, parts = _parts(content)
    return pa.Table.from_batches(list(parts), pa.schema([(c, pa.string()) for c in names]))


#: Bytes that are parsed at a time; a row must fit.
BLOCK = 1 << 20




def _batches(path: str, modified: pa.Scalar, content: bytes | pa.Buffer, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A file's head, then its rows. It is gone through twice, block by block: whether it loads is known at its end, and its rows are never held together."""
    n_rows, kinds, error = 0, None, None
    try:
        names, parts = _parts(content)
        seen = [Kind() for _ in names]
        for part in parts:
            n_rows += part.num_rows
            for kind, column in zip(seen, part.columns, strict=True):
                kind.see(column)
        kinds = [{"column": c, "dtype": kind.name()} for c, kind in zip(names, seen, strict=True)]
    except (pa.ArrowException, ValueError) as problem:
        n_rows, error = 0, f"{type(problem).__name__}: {problem}"
    head = {"file_path": path, "last_modified": modified.as_py(), "error": error, "n_rows": n_rows, "columns": kinds, "line": None, "cells": None}
    yield pa.RecordBatch.from_pylist([head], schema)
    at = 0
    for block in () if error else _parts(content)[1]:
        for part in (block.slice(i, 10_000) for i in range(0, block.num_rows, 10_000)):
            n, width = part.num_rows, part.num_columns
            by_row = pa.array((np.arange(n)[:, None] + n * np.arange(width)).ravel())
            keys = pa.array(part.schema.names, pa.string()).take(pa.array(np.tile(np.arange(width), n)))
            cells = pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), keys, pa.concat_arrays(part.columns).take(by_row))
            none = [pa.nulls(n, schema.field(i).type) for i in range(1, 5)]
            yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), *none, pa.array(np.arange(at + 1, at + n + 1)), cells], schema=schema)
            at += n


#: The columns of files that ``landing_of`` takes, as Spark's reader of whole files gives them.
CONTENT = "path string, modificationTime timestamp, length long, content binary"


def land(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.[cC][sS][vV]", opened: Accumulator | None = None) -> Landing:
    """Reads every file below the folder or paths once, and stores what it gave in the shared folder.

    A file loads or fails as a whole: it fails if a row is longer or shorter than the header, if its text isn't UTF-8, if a name stands
    twice in the header, or if it is empty or can't be opened; a header alone loads with no rows. A file must fit into a task's memory. opened: counts the files that tasks open.
    """
    found = contents(spark, paths, pattern)
    return landing_of(found, opened, listed(found))


def contents(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.[cC][sS][vV]") -> DataFrame:
    """The files as rows (CONTENT); a plan that drops the content doesn't read it."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("ignoreCorruptFiles", "true")
    return reader.load(paths if isinstance(paths, str) else list(paths))


def listed(found: DataFrame) -> DataFrame:
    """file_path of the files of ``contents``, as Spark lists them; among them the empty ones, which it passes over when it reads."""
    names = found.sparkSession.createDataFrame([(name,) for name in found.inputFiles()], "name string")  # names only
    return names.select(F.regexp_replace(F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/").alias("file_path"))


def landing_of(found: DataFrame, opened: Accumulator | None = None, listed: DataFrame | None = None) -> Landing:
    """``land`` for files (path, modificationTime, content) that are read elsewhere, say by a stream. listed: files of which those not read are empty."""
    spark = found.sparkSession
    tasks_import_here(spark)
    found = found.select("path", "modificationTime", "content")
    stamp = pa.timestamp("us", "UTC")
    schema = pa.schema([("file_path", pa.string()), ("last_modified", stamp), ("error", pa.string()), ("n_rows", pa.int64()), ("columns", pa.list_(pa.struct([("column", pa.string()), ("dtype", pa.string())]))), ("line", pa.int64()), ("cells", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, modified, content in zip(*batch.columns, strict=True):
                if opened is not None:
                    opened.add(1)
                yield from _batches(path.as_py(), modified, content.as_buffer() or b"", schema)

    folder = shared_folder(spark, "landing")
    landed = found.mapInArrow(run, _LANDED).withColumn("kind", F.when(F.col("line").isNull(), "file").otherwise("row"))
    landed.write.partitionBy("kind").parquet(folder)
    stored = spark.read.schema(f"{_LANDED}, kind string").parquet(folder)
    label = F.element_at(F.split("file_path", "/"), -2)
    files = stored.filter("kind = 'file'").select("file_path", "last_modified", "error", "n_rows", "columns")
    if listed is not None:
        empty = listed.join(files.select(F.regexp_replace("file_path", "^file:/+", "file:/").alias("file_path")), "file_path", "left_anti")
        files = files.unionByName(empty.select("file_path", F.lit("an empty file, or one that can't be opened").alias("error"), F.lit(0).cast("long").alias("n_rows")), allowMissingColumns=True)
    files = files.select("file_path", label.alias("label"), "last_modified", "error", "n_rows", "columns")
    return Landing(files, stored.filter("kind = 'row'").select("file_path", "line", "cells"))


def template_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """arm, week_8, week_11 (by place) and language of all sheets of a folder; a file's name is its language."""
    landing = land(spark, folder)
    heads = landing.loaded().select("file_path", F.transform("columns", lambda c: c["column"]).alias("names"))
    of = lambda i: F.try_element_at("cells", F.get("names", F.lit(i)))
    language = F.regexp_replace(F.element_at(F.split("file_path", "/"), -1), r"\.[^.]*$", "")
    return landing.rows.join(heads, "file_path").select(of(0).alias("arm"), of(1).alias("week_8"), of(2).alias("week_11"), language.alias("language"))
