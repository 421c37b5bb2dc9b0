"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billflow.session import checkpoint_dir

_U64 = np.uint64
SPACE = "\\x20\\x09-\\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_code(df: DataFrame) -> DataFrame:
    """``df``, after Python workers were told where this package is, if they have no
    other copy (an installed one, or one sent with ``--py-files``), and Arrow batches
    were bounded to ``spark.billflow.arrowBatchBytes`` (8 MB): the buffers of larger
    ones stay with the executor for good."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", conf.get("spark.billflow.arrowBatchBytes", "8m"))
    env = df.sparkSession.sparkContext.environment
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, here])
    return df


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: an eager checkpoint in the folder ``spark.checkpoint.dir`` names."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_batches(df: DataFrame, fn: Callable[[list], Iterable[dict]], schema: str, lists: bool = True) -> DataFrame:
    """Run ``fn`` on each Arrow batch: columns as Python lists (or Arrow arrays) in, dicts of columns out.

    Spark bounds a batch by rows and by ``spark.sql.execution.arrow.maxBytesPerBatch``.
    ``fn`` holds no state that a lost executor would take with it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                for out in fn([c.to_pylist() for c in b.columns] if lists else b.columns):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type, from_pandas=False) for f in arrow], schema=arrow)

    return with_code(df).mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit of a uint64 array over the whole word."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def sha(text: str) -> str:
    """Lowercase hex SHA-256 of a text's UTF-8 form."""
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def join_spans(spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    """``kind:start:end`` by start, then kind as listed in ``kinds``; comma-joined."""
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted((s, k, e) for k, s, e in spans))


def unit_hash(*cols: str, seed: int) -> "F.Column":
    """A number in [0, 1) from the md5 of seed and columns: the same in every engine and rerun."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))
