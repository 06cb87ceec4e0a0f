"""Small files in any Hadoop file system, replaced in one step."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Local files may be edited by hand: they are kept without checksum files.
    return where, store.getRawFileSystem() if store.getUri().getScheme() == "file" else store


def exists(spark: SparkSession, path: str) -> bool:
    where, store = _at(spark, path)
    return store.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    where, store = _at(spark, path)
    return store.exists(where) and store.getFileStatus(where).isDirectory()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; null where there is none."""
    where, store = _at(spark, path)
    if not store.exists(where):
        return None
    stream = store.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    where, store = _at(spark, path)
    out = store.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside, then rename over: readers see the old text or the new one."""
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    _write(spark, beside, text)
    rename(spark, beside, path, overwrite=True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; false if another writer was first."""
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    _write(spark, beside, text)
    try:
        rename(spark, beside, path, overwrite=False)
    except Exception as e:
        delete(spark, beside)
        if "FileAlreadyExists" in str(e) or exists(spark, path):
            return False
        raise
    return True


def rename(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, store = _at(spark, source)
    b, _ = _at(spark, target)
    a, b = store.makeQualified(a), store.makeQualified(b)
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE if overwrite else option.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), conf).rename(a, b, options)


def make_folder(spark: SparkSession, path: str) -> None:
    where, store = _at(spark, path)
    store.mkdirs(where)


def delete(spark: SparkSession, path: str) -> None:
    where, store = _at(spark, path)
    store.delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none for no folder."""
    where, store = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; 0 for none."""
    where, store = _at(spark, path)
    return store.getContentSummary(where).getLength() if store.exists(where) else 0


def get_json(path: str, default: object = None) -> object:
    """Content of a JSON file, by the active session; ``default`` where there is none."""
    text = read_text(SparkSession.active(), path)
    return default if text is None else json.loads(text)


def put_json(path: str, value: object) -> None:
    """Replace a JSON file in one step."""
    replace_text(SparkSession.active(), path, json.dumps(value, indent=1))
