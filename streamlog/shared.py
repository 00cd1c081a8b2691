"""Tables in the shared folder: results that later jobs read again, kept where every executor can see them."""

from __future__ import annotations

import functools
import gc
import os
import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset, a local session gets one of its own; on a cluster that is an error, since executors can't see a
    folder of the driver's machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-')}")
    return context.getCheckpointDir().rstrip("/")


@functools.lru_cache(maxsize=4)
def _path_class(jvm):
    return jvm.org.apache.hadoop.fs.Path  # a lookup of five round trips


def _hadoop(spark: SparkSession, path: str):
    target = _path_class(spark._jvm)(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is on the disk of this machine."""
    return _hadoop(spark, path)[0].getUri().getScheme() == "file"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in any store that Spark reads."""
    files, target = _hadoop(spark, path)
    return bool(files.exists(target))


def delete(spark: SparkSession, path: str) -> None:
    files, target = _hadoop(spark, path)
    files.delete(target, True)


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """The folders right below ``path`` whose names begin with ``prefix``."""
    files, target = _hadoop(spark, path)
    return [str(f.getPath().toString()) for f in files.listStatus(target) if f.isDirectory() and f.getPath().getName().startswith(prefix)]


def files(spark: SparkSession, path: str) -> list[str]:
    """The names of the files right below ``path``."""
    store, target = _hadoop(spark, path)
    return [f.getPath().getName() for f in store.listStatus(target) if f.isFile()]


def file_state(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """When a file was last written, in milliseconds, and its size; None where there is none."""
    store, target = _hadoop(spark, path)
    if not store.exists(target):
        return None
    try:
        found = store.getFileStatus(target)
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception):  # gone since
            return None
        raise
    return found.getModificationTime(), found.getLen()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, as text."""
    store, target = _hadoop(spark, path)
    stream = store.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a whole file at ``path`` unless there is one; whether this call did. Others see all of it or nothing."""
    files, target = _hadoop(spark, path)
    if is_local(spark, path):
        return _link_new(target.toUri().getPath(), text)
    files.mkdirs(target.getParent())
    temp = _path_class(spark._jvm)(target.getParent(), f".new-{uuid.uuid4().hex}")
    out = files.create(temp)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        return _rename_to_new(spark, temp, target)
    finally:
        files.delete(temp, False)


def _link_new(path: str, text: str) -> bool:
    """On a local disk a rename replaces; a link doesn't."""
    parent = os.path.dirname(path)
    os.makedirs(parent, exist_ok=True)
    temp = f"{parent}/.new-{uuid.uuid4().hex}"
    try:
        with open(temp, "wb") as out:
            out.write(text.encode())
        os.link(temp, path)
    except FileExistsError:
        return False
    finally:
        if os.path.exists(temp):
            os.remove(temp)
    return True


def _rename_to_new(spark: SparkSession, temp, target) -> bool:
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(kind, 1)
    none[0] = kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(temp, target, none)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def materialise(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes what ``materialise`` wrote for a frame that nothing reads any more. Other frames are left alone."""
    spark, folders = table.sparkSession, {f.rpartition("/")[0] for f in table.inputFiles()}
    shared = shared_dir(spark).split("://")[-1].replace("file:", "").rstrip("/")
    for folder in folders:
        if shared.lstrip("/") in folder:
            files, target = _hadoop(spark, folder)
            files.delete(target, True)


#: Rows of a frame that may stand in the plan itself.
SETTLED_ROWS = 10_000


def settle(frame: DataFrame, name: str) -> DataFrame:
    """A small frame, computed once: what follows sees this one result and doesn't run its plan again. A larger one goes to the shared folder."""
    spark = frame.sparkSession
    few = frame.limit(SETTLED_ROWS + 1).toArrow()
    if few.num_rows > SETTLED_ROWS:
        return materialise(frame, name)
    return spark.createDataFrame(few, schema=frame.schema)


def forget(spark: SparkSession) -> None:
    """Lets go of the shuffle files of frames that nothing holds any more. Spark drops them when the driver's garbage is collected, which may be long after."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
