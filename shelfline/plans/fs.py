"""Filesystem calls through the session's Hadoop FileSystem (works on HDFS,
object stores and local paths alike). Metadata operations only; data always
moves through Spark jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    """Delete ``path``; False if there was nothing. A refused delete raises."""
    fs, p = _fs(spark, path)
    if not fs.delete(p, True):
        if fs.exists(p):
            raise OSError(f"could not delete {path}")
        return False
    return True


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; none if it does not exist."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file (control data) whole."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file (compressed or not); None if it has none."""
    fs, p = _fs(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stream = fs.open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        data = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8")).readLine()
    finally:
        stream.close()


def touch(spark: SparkSession, path: str) -> None:
    """Give every file directly under ``path`` the present as its time."""
    fs, p = _fs(spark, path)
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    for st in fs.listStatus(p):
        if st.isFile():
            fs.setTimes(st.getPath(), now, -1)


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file (control data), under its name only once it is complete. One
    that is there already is an error."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    part = p.suffix(".part")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(part, p):
        raise OSError(f"could not write {path}")


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Raw values of the ``column=value`` folders directly under ``path``
    (a listing of the partition folders of a written table, no job)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    return [st.getPath().getName()[len(prefix):] for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Move ``src`` to ``dst`` (a metadata operation on HDFS-like stores). The
    filesystem reports a failed move by False; that raises."""
    fs, p = _fs(spark, src)
    q = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    if not fs.rename(p, q):
        raise OSError(f"could not move {src} to {dst}")
    return True
