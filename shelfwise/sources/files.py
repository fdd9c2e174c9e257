"""Small files and folders, through the file system their path names."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MOVES_AT_ONCE = 16


def _opened(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder; one that is not there is no error."""
    files, place = _opened(spark, path)
    files.delete(place, True)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Written under another name first, so that a note that is there is whole."""
    files, place = _opened(spark, path)
    unfinished = _opened(spark, f"{path}.unfinished")[1]
    stream = files.create(unfinished, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files.delete(place, False)
    if not files.rename(unfinished, place):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> str:
    """The text of a note, empty if there is none."""
    files, place = _opened(spark, path)
    try:
        stream = files.open(place)
    except Py4JJavaError as error:
        if "FileNotFoundException" in error.java_exception.getClass().getName():
            return ""
        raise
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def matching(spark: SparkSession, root: str, *patterns: str) -> list[str]:
    """Relative paths below ``root`` whose parts match the patterns; none if it is not there.

    One listing for each level, since a table has thousands of directories.
    """
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    files, place = _opened(spark, root)
    if not files.exists(place):
        return []
    level = context._gateway.new_array(hadoop.Path, 1)
    level[0] = place
    for pattern in patterns:
        level = hadoop.FileUtil.stat2Paths(files.listStatus(level, hadoop.GlobFilter(pattern)))
    return ["/".join(path.toString().split("/")[-len(patterns) :]) for path in level]


def replace_folders(spark: SparkSession, source: str, target: str, names: list[str]) -> None:
    """Move folders from below ``source`` to below ``target``, each in place of what is there.

    Both are on one file system. The moves are calls to it that do not depend on each other.
    """
    files, _ = _opened(spark, target)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def move(name: str) -> None:
        new = path(f"{target}/{name}")
        if not files.delete(new, True):
            files.mkdirs(new.getParent())
        if not files.rename(path(f"{source}/{name}"), new):
            raise OSError(f"cannot move {source}/{name} to {new}")

    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        for _ in pool.map(move, names):
            pass


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to where nothing is, in one step; false if something is there."""
    files, place = _opened(spark, target)
    if files.exists(place):
        return False
    files.mkdirs(place.getParent())
    return files.rename(_opened(spark, source)[1], place)


def first_lines(spark: SparkSession, paths: list[str]) -> list[str]:
    """The first line of each text file, compressed or not; empty for an empty file."""
    context = spark.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(path: str) -> str:
        place = jvm.org.apache.hadoop.fs.Path(path)
        stream = place.getFileSystem(conf).open(place)
        try:
            codec = codecs.getCodec(place)
            raw = stream if codec is None else codec.createInputStream(stream)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8"))
            return reader.readLine() or ""
        finally:
            stream.close()

    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        return list(pool.map(first, paths))
