"""O-01 over one large export: a quoted CSV read by many tasks.

A line break inside a quoted cell is no end of a record, and where a split begins a
task cannot tell whether it stands inside such a cell. What decides it is the parity
of the quotes before it, so the file is read in two passes:

1. every split counts its own quotes (one row per split), and a running sum per file
   gives the parity at its start;
2. every split then cuts its lines into records. A record that lies in one split is
   whole; of a record that crosses splits each split gives its piece, and the pieces,
   the only rows that are shuffled, are put together by the split it began in.

The second pass needs to know only of splits that such a record touches. Their list
goes to the tasks; it is never longer than the list of splits that the driver holds to
plan the scan. Without such records there is no third read and no shuffle.

Cells must be quoted as spreadsheets do: a cell with a comma, a quote or a line break
is quoted as a whole and its quotes doubled. A record that breaks this (a single quote
inside an unquoted cell) stops the read with a message, since the parity after it would
mean nothing; such a file is for :func:`billflow.sources.files.read_text_table`.
Lines end in LF or CRLF; a file's first line begins its header. Empty lines between
records are skipped, and a quote that is never closed ends with the file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billflow.sources.files import CSV_OPTIONS, na_to_null

SPLITS = "file string, start bigint, odd int, ever boolean"
PIECES = "file string, owner bigint, part bigint, place bigint, text binary"
MIN_PARTITIONS = "spark.sql.files.minPartitionNum"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start of its split, line), in file order within a split.

    Both passes must meet the same splits. Their size follows the number of cores, which
    a growing cluster changes between the passes, so it is fixed in the session first.
    """
    if spark.conf.get(MIN_PARTITIONS, None) is None:
        spark.conf.set(MIN_PARTITIONS, str(spark.sparkContext.defaultParallelism))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"))


def _runs(batches):
    """((file, start), lines) of each stretch of rows of one split."""
    for b in batches:
        if not b.num_rows:
            continue
        file, start = b.column(0).dictionary_encode().indices.to_numpy(), b.column(1).to_numpy()
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
            yield (b.column(0)[int(lo)].as_py(), int(start[lo])), b.column(2).slice(int(lo), int(hi - lo))


def _parity(lines: pa.Array, odd: int) -> np.ndarray:
    """Whether the quotes up to the end of each line are odd in number."""
    n = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    return (odd + np.cumsum(n, dtype=np.int64)) & 1


def _count(batches):
    """Pass 1: per split the parity of its quotes, and whether any of its lines ends on an odd count."""
    key, odd, ever = None, 0, False
    done = lambda: pa.RecordBatch.from_pydict(
        {"file": [key[0]], "start": [key[1]], "odd": pa.array([odd], pa.int32()), "ever": [ever]})
    for k, lines in _runs(batches):
        if k != key:
            if key:
                yield done()
            key, odd, ever = k, 0, False
        after = _parity(lines, odd)
        odd, ever = int(after[-1]), ever or bool(after.any())
    if key:
        yield done()


def crossings(spark: SparkSession, path: str) -> dict[tuple[str, int], tuple[int, int | None]]:
    """The splits that a record enters or leaves: (file, start) -> (parity at its start,
    start of the split in which the record that enters it began)."""
    splits = _lines(spark, path).mapInArrow(_count, SPLITS)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = splits.withColumn("p", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    # a split that lies wholly inside a record begins none
    begins = F.when((F.col("p") == 0) | F.col("ever"), F.col("start"))
    known = known.withColumn("begins", begins).withColumn("owner", F.last("begins", ignorenulls=True).over(earlier))
    touched = known.filter((F.col("p") == 1) | ((F.col("p") + F.col("odd")) % 2 == 1))
    return {(r.file, r.start): (int(r.p), r.owner) for r in touched.select("file", "start", "p", "owner").collect()}


def _cutter(crossing: dict, pieces: bool):
    """Pass 2: the whole records of each split, or (``pieces``) its parts of records that cross splits.

    ``place`` is the split's start and the line's number in it: it grows along a file.
    """
    schema = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("part", pa.int64()),
                        ("place", pa.int64()), ("text", pa.binary())])

    def batch(key, rows):
        owner, place, text = zip(*rows)
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array(owner, pa.int64()),
                                           pa.array([key[1]] * n, pa.int64()), pa.array(place, pa.int64()),
                                           pa.array(text, pa.binary())], schema=schema)

    def run(batches):
        key = None
        odd = n = 0
        held: list = []  # lines of a record that is not closed yet
        owner = place = None  # of that record; an owner if it began in an earlier split

        def rest():  # what a split leaves open
            return batch(key, [(key[1] if owner is None else owner, place, b"\n".join(held))])

        for k, lines in _runs(batches):
            if k != key:
                if held and pieces:
                    yield rest()
                key, n, held, place = k, 0, [], None
                odd, owner = crossing.get(k, (0, None))
                owner = owner if odd else None
            after = _parity(lines, odd)
            before = np.concatenate([[odd], after[:-1]])
            single = (before == 0) & (after == 0)
            if not pieces and single.any():
                at = np.flatnonzero(single)
                text = lines.filter(pa.array(single))
                none = pa.nulls(len(at), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0]], pa.string()).take(pa.array(np.zeros(len(at), np.int64))), none,
                     pa.array(np.full(len(at), k[1])), pa.array(k[1] + n + at), text], schema=schema)
            closed = []
            for i in np.flatnonzero(~single).tolist():
                if not before[i]:
                    held, owner, place = [], None, k[1] + n + i
                held.append(lines[i].as_py())
                if not after[i]:
                    if pieces == (owner is not None):
                        closed.append((owner, place, b"\n".join(held)))
                    held, owner, place = [], None, None
            if closed:
                yield batch(k, closed)
            odd, n = int(after[-1]), n + len(lines)
        if held and pieces:
            yield rest()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, text): every record of the files, headers included, as it stands there."""
    lines, crossing = _lines(spark, path), crossings(spark, path)
    text = F.col("text").cast("string").alias("text")
    whole = lines.mapInArrow(_cutter(crossing, False), PIECES).select("file", "place", text)
    if not crossing:
        return whole
    keys = spark.createDataFrame(list(crossing), "file string, start bigint")
    parts = (lines.join(F.broadcast(keys), ["file", "start"], "left_semi")
             .mapInArrow(_cutter(crossing, True), PIECES).select("file", "owner", "part", "place", text))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "\n")
    return whole.unionByName(parts.groupBy("file", "owner").agg(F.max("place").alias("place"), joined.alias("text"))
                             .select("file", "place", "text"))


def _checked(text: Column) -> Column:
    """The record, or an error where a quote stands inside an unquoted cell."""
    bare = F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), r'(^|,)"[^"]*"(?=,|\z)', "$1")
    return F.when(bare.contains('"') & (F.length(F.regexp_replace(text, '[^"]', "")) % 2 == 0), F.raise_error(F.concat(
        F.lit("a quote inside an unquoted cell; read this file with read_text_table: "), F.substring(text, 1, 200)))).otherwise(text)


def read_split_table(spark: SparkSession, path: str, columns: list[str] | None = None, place: bool = False) -> DataFrame:
    """As :func:`billflow.sources.files.read_text_table`, with one large file read by many tasks.

    ``place`` adds ``_file`` and ``_place``, by which the rows stand as in their file.
    """
    columns = columns or spark.read.options(header=True, **CSV_OPTIONS).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    text = F.when(F.col("text").endswith("\r"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    rows = records(spark, path).withColumn("text", text).filter("place > 0 and text <> ''")
    # from_csv takes no StructType; the columns are named by number in between
    ddl = ", ".join(f"c{i} string" for i in range(len(columns)))
    cells = rows.select("file", "place", F.from_csv(_checked(F.col("text")), ddl, {k: str(v) for k, v in CSV_OPTIONS.items()}).alias("r"))
    df = cells.select(*[F.col(f"r.c{i}").alias(f.name) for i, f in enumerate(schema)],
                      *([F.col("file").alias("_file"), F.col("place").alias("_place")] if place else []))
    return na_to_null(df, [f.name for f in schema])
