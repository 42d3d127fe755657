"""Folders and files of a store that Spark reads: listings, usage, text files, and publishing of what was written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, length of the files below a folder; no content is read. Sort by path for a fixed order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def usage(files: DataFrame) -> DataFrame:
    """One row: files and bytes of a listing; zeros where it is empty."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"))


def fields(rows: DataFrame) -> DataFrame:
    """name, pos, type of each column, from the schema alone."""
    spark = rows.sparkSession
    listed = [(f.name, pos, f.dataType.simpleString()) for pos, f in enumerate(rows.schema)]
    return spark.createDataFrame(listed, "name string, pos bigint, type string")


def required(rows: DataFrame, names: list[str]) -> DataFrame:
    """The named columns; an error names those that are missing."""
    missing = [n for n in names if n not in rows.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return rows.select(*names)


class Store:
    """Whole small files and renames in the file system of a path, whichever Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._at(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._at(old), self._at(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._at(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        f = self._fs.open(self._at(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(f)).decode()
        finally:
            f.close()


def publish(spark: SparkSession, target: str, write: Callable[[str], None], check: Callable[[str], None], overwrite: bool = False) -> None:
    """Writes into a folder beside the target, checks it and renames it, so that the target is old or new but never half written.

    A target that exists is refused without ``overwrite``; where ``write`` or ``check`` raises it stays as it was.
    """
    store, held = Store(spark, target), f"{target}._staging_{uuid.uuid4().hex}"
    if store.exists(target) and not overwrite:
        raise FileExistsError(target)
    try:
        write(held)
        check(held)
        old = f"{held}_old"
        if store.exists(target):
            store.rename(target, old)
        try:
            store.rename(held, target)
        except BaseException:
            if store.exists(old):
                store.rename(old, target)
            raise
        store.delete(old)
    finally:
        store.delete(held)


def write_episodes(frames: DataFrame, path: str, group: str = "ep", order: str = "frame") -> None:
    """A folder for each episode with its frames in order. An episode is one file, so a task writes it whole; sorting spills."""
    frames.repartition(group).sortWithinPartitions(group, order).write.partitionBy(group).parquet(path)


def matrices(rows: DataFrame, shapes: dict[str, tuple[int, int]]) -> DataFrame:
    """Flat matrix columns as nested lists of single-precision rows; a matrix of another size is an error when it is read."""
    return rows.withColumns({name: _nested(name, height, width) for name, (height, width) in shapes.items()})


def _nested(name: str, height: int, width: int) -> Column:
    refused = F.raise_error(F.concat(F.lit(f"{name} is no {height} x {width} matrix: "), F.size(name).cast("string"), F.lit(" values")))
    flat = F.when(F.size(name) == height * width, F.col(name)).otherwise(refused)
    return F.array(*[F.slice(flat, i * width + 1, width) for i in range(height)]).cast("array<array<float>>")


def write_lines(rows: DataFrame, path: str) -> None:
    """A compact JSON object a line; nulls are written."""
    rows.write.option("ignoreNullFields", False).json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """With a header in each file; quotes are doubled."""
    rows.write.option("header", True).option("escape", '"').csv(path)
