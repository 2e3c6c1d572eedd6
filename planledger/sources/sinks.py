"""Writing: replace a table or folder so that readers always find a whole one; keep bucketed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from planledger.contracts import KEY, TABLES


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration())


class Folder:
    """A folder that is replaced as a whole: what was there stays until its successor is complete.

    The successor is written beside it, then the two change places by renaming. If a run
    ends between the two renames, the next one puts the old folder back first.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self.next, self.previous = f"{self.path}.next-{uuid.uuid4().hex}", f"{self.path}.previous"
        self._fs, self._path = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def recover(self) -> None:
        """Put the old folder back where a run ended before its successor was in place."""
        if self.exists(self.previous):
            if self.exists(self.path):
                self.delete(self.previous)
            else:
                self.rename(self.previous, self.path)

    def publish(self) -> None:
        """Put ``next`` in the folder's place."""
        there = self.exists(self.path)
        if there:
            self.rename(self.path, self.previous)
        try:
            self.rename(self.next, self.path)
        except Exception:
            if there:
                self.rename(self.previous, self.path)
            raise
        if there:
            self.delete(self.previous)


def write_snapshot(
    df: DataFrame,
    path: str,
    table: str | None = None,
    fmt: str = "orc",
    files: int | None = None,
) -> None:
    """Replace ``path`` and, if named, the external table that points to it.

    If writing fails, the folder and the table stay as they were. By default the rows are
    written in parallel as they are partitioned. ``files`` reshuffles them evenly into that
    many files; 1 puts everything through one task and is only for small extracts.
    Where renaming a folder is not one step (object stores), readers may miss it meanwhile.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    folder.recover()
    try:
        (df if files is None else df.repartition(files)).write.format(fmt).save(folder.next)
        folder.publish()
    finally:
        folder.delete(folder.next)
    if table:
        _point(spark, table, folder.path, fmt, df)


def _point(spark: SparkSession, table: str, path: str, fmt: str, df: DataFrame) -> None:
    """Let the external ``table`` name the files in ``path``."""
    if spark.catalog.tableExists(table):
        if spark.table(table).schema.simpleString() == df.schema.simpleString() and _location(spark, table) == _qualified(spark, path):
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source=fmt, schema=df.schema)


def _qualified(spark: SparkSession, path: str) -> str:
    fs = _file_system(spark, path)
    return fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(path)).toUri().getPath()


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return _qualified(spark, rows[0]["data_type"]) if rows else ""


def write_bucketed(df: DataFrame, name: str, table: str, buckets: int, path: str | None = None) -> None:
    """Store a source table, as its contract normalises it, bucketed by the key its lists are grouped by.

    ``sources.tables.read_bucketed`` reads it back without a shuffle for that key. Rows are
    first dealt by the key, so that there is one file for each bucket.
    """
    key = bucket_key(name)
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def bucket_key(name: str) -> str:
    """The subscriber where a table has one, else its first key."""
    keys = [column for column, kind in TABLES[name].items() if kind == KEY]
    return next((k for k in keys if k in ("subscriber_key", "subcriptor")), keys[0])
