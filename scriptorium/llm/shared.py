"""Tables in the folder that driver and executors share, and sizing helpers.

``spark.checkpoint.dir`` names the shared folder.  Where it is unset on one machine (tests)
a folder of our own is made and set, so that every operator can rely on it; on a cluster it must be set.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; a new one only where the session names none and all tasks run in the driver."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="scriptorium-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_dir(spark)}/scriptorium-{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there.

    A lost executor then costs a re-read, never a recomputation of what stands before.  The
    table is removed by ``dropped``, at the latest when the driver's Python ends.  All tables of an application lie in one
    folder of its name (``run_dir``); a driver that is killed leaves it, and it can be removed once that application is gone.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _written:
        atexit.register(_remove_all)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._scriptorium_path = path
    return out


def in_tasks_of(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df``, of some ``rows`` rows, in no more tasks (and files, once written) than hold ``each`` rows.

    A table of small rows that comes from a shuffle has a file for each shuffle partition otherwise, however few rows are in them; on a local
    file system without Hadoop's native library each file costs an executor some six child processes.
    """
    return df.coalesce(max(1, -(-rows // each)))


def dropped(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made and that no later plan reads."""
    for df in tables:
        path = getattr(df, "_scriptorium_path", None)
        if path is not None:
            _remove(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _remove_all() -> None:
    for spark, path in _written:
        try:
            _remove(spark, path.rsplit("/", 1)[0])
        except Exception:  # the session has ended: its owner clears the shared folder
            return


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A number for identifier and text, never null: rows that share it are repeated rows."""
    return F.xxhash64(F.col(id_col).isNull(), id_col, F.col(text_col).isNull(), text_col)


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of UTF-8 in a text column, over all rows."""
    return int(df.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0)


def groups_for(total_bytes: int, each: int = 16 << 20) -> int:
    """How many groups of about ``each`` bytes hold ``total_bytes``."""
    return max(1, -(-total_bytes // each))
