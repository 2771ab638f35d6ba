"""Files and folders on any store that Spark can reach, by the session's Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """What is in a folder; nothing if there is none."""
    store, place = _at(spark, folder)
    if not store.exists(place):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    store, place = _at(spark, source)
    if not store.rename(place, _at(spark, target)[1]):
        raise OSError(f"{source} cannot be moved to {target}")


def size(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Data files right in a folder, and their bytes; what Spark takes for hidden does not count."""
    store, place = _at(spark, folder)
    found = [s for s in store.listStatus(place) if s.isFile() and s.getPath().getName()[0] not in "._"]
    return len(found), sum(status.getLen() for status in found)


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _at(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file; one that is there already is an error."""
    store, place = _at(spark, path)
    stream = store.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
