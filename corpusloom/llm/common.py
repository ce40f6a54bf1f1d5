"""Helpers shared by the training-data operators: shared tables, sizing and safe naming.

Every intermediate table goes below the folder that the session names in ``spark.checkpoint.dir``,
so that a lost executor costs a re-read and not a recomputation of the whole lineage.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dir: dict[str, str] = {}
_open_jobs: dict[str, list] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def _cleaning(spark: SparkSession):
    """Shuffle files of the jobs inside go once they are done; concurrent users share one switch, and the
    last one to leave sets it back."""
    app = spark.sparkContext.applicationId
    with _lock:
        users = _open_jobs.setdefault(app, [0, spark.conf.get(_CLEAN)])
        users[0] += 1
        spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        with _lock:
            users[0] -= 1
            if not users[0]:
                spark.conf.set(_CLEAN, _open_jobs.pop(app)[1])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only in a local session that names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    return _own_dir[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return the table: cuts lineage for good."""
    return written_parts([df], label)


def written_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of all ``parts`` as one table, written one after another: the shuffle files of one part go
    before those of the next one come."""
    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or fresh_path(spark, label)
        with _cleaning(spark):
            df.write.mode("append").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._loom_path = path
    return table


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def forget(table: DataFrame) -> None:
    """Delete a table made by :func:`written` once nothing reads it any more."""
    path = getattr(table, "_loom_path", None)
    if path is not None:
        delete(table.sparkSession, path)


def packed_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no name of theirs can meet one of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_order(col: str = "doc_id") -> Column:
    """Sort key under which a null id comes first."""
    return F.coalesce(F.col(col), F.lit(-(2**63)))


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """Total UTF-8 bytes, to size blocks and shuffles by the data and not by a constant."""
    got = docs.agg(F.sum(F.octet_length(F.col(col)))).first()[0]
    return int(got or 0)


def parts_for(total_bytes: int, per_part: int, least: int = 1) -> int:
    return max(least, -(-total_bytes // per_part))


def spans_of(texts: list, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Slices of a batch that hold about ``most`` characters each, so that what is made from a slice
    stays small however many rows a batch has."""
    out, start, held = [], 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= most:
            out.append((start, k + 1))
            start, held = k + 1, 0
    return out if start == len(texts) else [*out, (start, len(texts))]
