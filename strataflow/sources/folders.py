"""Folders of a store, seen through the Hadoop filesystem: names only, no file is listed or opened."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

#: What a NULL partition value is stored as.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _store(spark, path).exists(_path(spark, path))


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a path, none where it isn't there."""
    store, where = _store(spark, path), _path(spark, path)
    if not store.exists(where):
        return []
    return sorted(path.getName() for path in spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(store.listStatus(where)))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies right below a folder of folders; none where the path isn't there."""
    return [name for name in _names(spark, path) if name[0] != "."]


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files right below a path."""
    return [name for name in _names(spark, path) if name[0] not in "_."]


def partition_values(spark: SparkSession, path: str, name: str) -> dict[str | None, str]:
    """Values of the ``name=value`` folders right below a path, as text, with the folder of each."""
    found = {}
    for folder in child_folders(spark, path):
        key, sign, value = folder.partition("=")
        if sign and key == name:
            found[None if value == NULL_FOLDER else unquote(value)] = f"{path.rstrip('/')}/{folder}"
    return found


#: Folders looked into at a time.
LISTINGS = 16


def newest_folders(
    spark: SparkSession, path: str, key: str, version: str, wanted: Callable[[str], bool] | None = None, up_to: str | None = None
) -> list[str]:
    """Of each ``key=`` folder the ``version=`` folder that sorts last, level by level.

    Neither the files of the newest versions nor those of older ones are listed. Keys that aren't
    ``wanted`` are not looked into, nor is the NULL key.
    """
    keys = [f for value, f in partition_values(spark, path, key).items() if value is not None and (wanted is None or wanted(value))]

    def newest(folder: str) -> str | None:
        versions = partition_values(spark, folder, version)
        seen = [v for v in versions if v is not None and (up_to is None or v <= up_to)]
        return versions[max(seen)] if seen else None

    with ThreadPoolExecutor(LISTINGS) as pool:
        return [folder for folder in pool.map(newest, keys) if folder is not None]


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders or files, those that are gone already too."""
    for path in paths:
        _store(spark, path).delete(_path(spark, path), True)


def folder_of(spark: SparkSession, file_uri: str) -> str:
    """Folder of a file named by ``_metadata.file_path``, which is a URI with its own escapes."""
    uri = spark._jvm.java.net.URI(file_uri)
    return spark._jvm.org.apache.hadoop.fs.Path(uri).getParent().toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written by the driver, in place of one that is there."""
    out = _store(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None where there is none."""
    if not exists(spark, path):
        return None
    source = _store(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
