"""Paths, small metadata files and the shared work folder.

Only metadata (schemas, manifests, markers) goes through these helpers; rows
are always read and written by Spark jobs.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *[p.strip("/") for p in parts[1:]]])


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return "*" not in path and fs.exists(jpath) and fs.getFileStatus(jpath).isFile()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder, in place of what an earlier try left there; a missing one becomes an empty folder."""
    fs, jpath = _fs(spark, path)
    _, target = _fs(spark, to)
    if not fs.exists(jpath):
        fs.mkdirs(target)
        return
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(jpath, target):
        raise FileExistsError(to)


def read_json(spark: SparkSession, path: str):
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file under a hidden name first, then rename it."""
    fs, jpath = _fs(spark, path)
    if fs.exists(jpath):
        raise FileExistsError(path)
    fs.mkdirs(jpath.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(
        jpath.getParent(), f"_{uuid.uuid4().hex}.tmp"
    )
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(hidden, jpath):
        fs.delete(hidden, False)
        raise FileExistsError(path)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the session.

    ``spark.checkpoint.dir`` names the shared folder. Where it is unset a
    temporary folder is used, but only if Spark runs in this process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="medallion-")
    return join(shared, f"{name}-{uuid.uuid4().hex[:12]}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, such as a schema or a rules file."""
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
