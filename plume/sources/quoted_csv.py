"""Quoted CSV in file splits: line breaks inside quoted fields, without making a file one split.

A line break ends a record only outside quotes, and whether a split begins inside quotes depends on all that comes
before it.  So files are read twice.  The first pass counts the quotes of every split (a quote inside a field is
doubled, so it does not change the parity); the splits' parities, one row each, add up in order of their places and
tell how each split begins.  The second pass cuts every split into records at its true record ends.  Records that lie
in one split, nearly all, never move; only the pieces of records that cross a border are shuffled and joined.

Fields that hold a quote must be quoted, as CSV writers do.  Line ends are ``\\n`` or ``\\r\\n``.
A compressed file is one split (unless bzip2): write many of bounded size.
A compressed file is one split (unless bzip2): write many of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plume.session import work_dir

#: The splits' table (a path, a place and two bits each) is broadcast, so that lines stay where they are read; more
#: splits than this, 128 TB of 128 MB each, are refused: let them be larger.
MOST_SPLITS = 1_000_000
WHOLE, GOES_ON, BEGINS = range(3)
PIECE = "file string, block long, n long, kind int, record string"
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def splits(lines: DataFrame) -> DataFrame:
    """``(file, block, inside, ends_inside)``: whether each split begins and ends within quotes."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    per = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block")  # one row a split
    upto = F.sum("odd").over(before)
    return per.select("file", "block", ((upto - F.col("odd")) % 2 == 1).alias("inside"), (upto % 2 == 1).alias("ends_inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order, to records and pieces of records."""
    where, n, quoted, held, cont = None, 0, False, [], False
    names = [c.split()[0] for c in PIECE.split(", ")]

    def table(texts: pa.Array | list, first: int, kind: int) -> pa.RecordBatch:
        m = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([where[0]] * m, pa.string()), pa.array([where[1]] * m, pa.int64()),
             pa.array(np.arange(first, first + m), pa.int64()), pa.array([kind] * m, pa.int32()),
             texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())], names)

    def rest():  # what is open at the end of a split
        return table(["\n".join(held)], -1 if cont else n, GOES_ON if cont else BEGINS)
    for b in batches:
        value = b.column("value")
        if not len(value):
            continue
        at = b.column("block").to_numpy()
        files = b.column("file").dictionary_encode()
        inside = b.column("inside").to_numpy(zero_copy_only=False)
        change = (at[1:] != at[:-1]) | (np.diff(files.indices.to_numpy()) != 0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(at)]
        odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) % 2
        for s, e in zip(edges, edges[1:]):
            here = (files[s].as_py(), int(at[s]))
            if here != where:
                if held:
                    yield rest()
                where, n, held = here, 0, []
                quoted = cont = bool(inside[s])
            after = (int(quoted) + np.cumsum(odd[s:e])) % 2 == 1  # does a line end within quotes?
            begins = ~np.concatenate([[quoted], after[:-1]])       # does a record begin at it?
            if begins.all() and not after.any():
                yield table(value.slice(s, e - s), n, WHOLE)
                n += e - s
                continue
            done: list[str] = []
            for line, ends in zip(value.slice(s, e - s).to_pylist(), (~after).tolist()):
                held.append(line)
                if ends:
                    if cont:
                        yield table(["\n".join(held)], -1, GOES_ON)
                        cont = False
                    else:
                        done.append("\n".join(held))
                    held = []
            if done:
                yield table(done, n, WHOLE)
                n += len(done)
            quoted = bool(after[-1])
    if held:
        yield rest()


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, block, n, record)``: every record's text and place; places ascend in reading order within a file.

    Blank lines between records are records too.  An empty file gives none; a file that ends within quotes ends
    its last record.
    """
    paths = [paths] if isinstance(paths, str) else paths
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    work_dir(spark)
    found = splits(_lines(spark, paths)).checkpoint(eager=True)
    many = found.count()
    if many > MOST_SPLITS:
        raise ValueError(f"{many} splits: raise spark.sql.files.maxPartitionBytes")
    lines = _lines(spark, paths).join(F.broadcast(found), ["file", "block"], "left")
    known = F.when(F.col("inside").isNull(), F.raise_error(F.lit("splits changed between the passes"))).otherwise(
        F.col("inside"))
    cut = lambda df: df.select("value", "file", "block", known.alias("inside")).mapInArrow(_cut, PIECE)
    whole = cut(lines).where(F.col("kind") == WHOLE)
    if not found.where("ends_inside").limit(1).count():
        return whole.drop("kind")
    # Pieces of records that cross a border: at most two a split.
    pieces = cut(lines.where("inside OR ends_inside")).where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")
    begun = pieces.withColumn("id", F.sum(F.when(F.col("kind") == BEGINS, 1).otherwise(0)).over(order))
    joined = begun.groupBy("file", "id").agg(
        F.min(F.struct("block", "n")).alias("at"),
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))  # the splits one record crosses
    return whole.drop("kind").unionByName(joined.select(
        "file", "at.block", "at.n", F.array_join(F.col("parts.record"), "\n").alias("record")))


def read_quoted_csv(spark: SparkSession, paths: str | list[str], schema: StructType | None = None,
                    position: bool = False) -> DataFrame:
    """CSV files with line breaks in quoted fields, read in splits.

    Without ``schema`` the first record of every file is its header, all columns are text and the first file's header
    names them; with it there is no header.  ``position`` adds ``read_at``, a struct (file, block, n) that orders rows
    as they were read.  Blank lines are skipped; short records end in nulls; values that do not fit their type are
    null.
    """
    paths = [paths] if isinstance(paths, str) else paths
    rows = records(spark, paths)
    kept = F.regexp_replace("record", r"\r\z", "").alias("record")
    at = F.struct("file", "block", "n").alias("read_at")
    if schema is None:
        names = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(
            _first_file(spark, paths)).columns
        ddl = ", ".join(f"c{i} string" for i in range(len(names)))
        rows = rows.where("NOT (block = 0 AND n = 0)")
    else:
        names, ddl = schema.names, ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema))
    if not names:
        return rows.select(*[at] * position)
    parsed = F.from_csv("record", ddl, {"escape": '"', "multiLine": "true"}).alias("r")
    rows = rows.select(at, kept).where(F.trim(F.col("record")) != "").select("read_at", parsed)
    fields: list[Column] = [F.col(f"r.c{i}").alias(c) for i, c in enumerate(names)]
    return rows.select(*fields, *["read_at"] * position)


def _first_file(spark: SparkSession, paths: list[str]) -> str:
    """The file whose header names the columns: the first that has any bytes."""
    found = spark.read.format("binaryFile").load(paths).select("path", "length")  # sizes alone: no file is read
    return found.where("length > 0").agg(F.min("path")).first()[0] or paths[0]
