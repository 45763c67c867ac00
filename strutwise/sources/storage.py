"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_own_folder: str | None = None
#: Tables that this process wrote and didn't delete, in order.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where a local session names none, a temporary folder of this process."""
    global _own_folder
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own_folder is None:
        folder = tempfile.mkdtemp(prefix="strutwise-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folder = f"file://{folder}"
    return _own_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/strutwise/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _written.remove(path)


def discard(table: DataFrame) -> None:
    """Deletes a table of :func:`stored` that nothing reads any more."""
    files = table.inputFiles()
    for path in [p for p in _written if any(p.rsplit("/", 1)[1] in f for f in files)]:
        _delete(table.sparkSession, path)


def alone(df: DataFrame, name: str, since: int) -> DataFrame:
    """``df`` as a table of :func:`stored`, in place of all tables written after ``since`` (a value of :func:`written`)."""
    kept = stored(df, name)
    for path in _written[since:-1]:
        _delete(df.sparkSession, path)
    return kept


def written() -> int:
    return len(_written)


def discard_all(spark: SparkSession, since: int = 0) -> None:
    """Deletes the tables of :func:`stored` written after ``since``, once the caller has taken from results what it needs."""
    for path in _written[since:]:
        _delete(spark, path)


def put(spark: SparkSession, name: str, body: bytes | Iterable[bytes]) -> str:
    """A file in the shared folder, under a name of its own, from its bytes or from pieces of them in turn; its path."""
    path = f"{shared_folder(spark)}/strutwise/files-{uuid.uuid4().hex}/{name}"
    jvm = spark._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark._jsc.hadoopConfiguration()).create(to, True)
    try:
        for piece in (body,) if isinstance(body, bytes) else body:
            out.write(bytearray(piece))
    finally:
        out.close()
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder in the shared folder that nothing else writes to."""
    return f"{shared_folder(spark)}/strutwise/{name}-{uuid.uuid4().hex}"
