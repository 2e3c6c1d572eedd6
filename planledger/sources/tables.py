"""Reading: parquet tables, dated partitions, the plan-list file, JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from planledger.contracts import TABLES, CastLosses, normalise

SNAPSHOT_COLUMNS = ("year", "month", "day")

_SHARED = (
    "assigned_product", "assigned_product_parameter", "product", "assigned_billing_offer",
    "product_catalog", "product_billing_parameters", "billing_detail", "cycle_discounts",
    "plan_list",
)
_PEOPLE = ("customer", "subscribers", "customer_sub_type", "parc_kfactor")

# The tables each report reads.
JOB_TABLES = {
    "daily": (*_SHARED, *_PEOPLE, "parc_sist"),
    "monthly": (*_SHARED, "parc_coliving"),
    "daily-v2": (*_SHARED, *_PEOPLE),
}


def read_table(
    spark: SparkSession, root: str, name: str, losses: CastLosses | None = None
) -> DataFrame:
    """A table of ``root`` with its contract's columns, normalised.

    Only the selected columns are read from the files, and filters on non-key
    columns are pushed to the parquet reader.
    """
    return normalise(spark.read.parquet(f"{root.rstrip('/')}/{name}"), name, losses)


def dated_folders(
    spark: SparkSession,
    root: str,
    wanted: tuple[int, ...] | None = None,
    columns: tuple[str, ...] = SNAPSHOT_COLUMNS,
) -> list[str]:
    """The partition folders of one date, the latest unless ``wanted`` names it.

    One directory listing per level, so a long history is neither listed nor
    opened. Values compare as numbers; a date stored under a padded and an
    unpadded name gives both folders.
    """
    folders = [root.rstrip("/")]
    for level, column in enumerate(columns):
        found: dict[int, list[str]] = {}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(path):
                name, _, value = status.getPath().getName().partition("=")
                if name == column and value.isdigit():
                    found.setdefault(int(value), []).append(status.getPath().toString())
        key = wanted[level] if wanted else max(found, default=None)
        if key not in found:
            raise FileNotFoundError(f"no partition {column}={key} under {root}")
        folders = found[key]
    return folders


def read_dated(
    spark: SparkSession, root: str, name: str, period: str | None = None, day: int = 1
) -> DataFrame:
    """A table partitioned by year, month and day at one date: the latest, or day ``day`` of ``period``."""
    wanted = (int(period[:4]), int(period[4:6]), day) if period else None
    folders = dated_folders(spark, f"{root.rstrip('/')}/{name}", wanted)
    return normalise(spark.read.parquet(*folders), name)


def latest_partition(df: DataFrame, columns: tuple[str, ...] = SNAPSHOT_COLUMNS) -> DataFrame:
    """The rows of the latest dated partition.

    The tuple is compared as numbers, so month 10 follows month 9 however the
    folders are padded. On a partitioned table the subquery reads no data
    columns and its result prunes the scan to one folder. For files with a long
    history ``read_dated`` is cheaper: it never lists the other dates.
    """
    numbers = F.struct(*[F.col(name).cast("int").alias(name) for name in columns])
    latest = df.select(F.max(numbers))
    return df.where(numbers == latest.scalar())


def period_partition(
    df: DataFrame, period: str, day: int = 1, columns: tuple[str, ...] = SNAPSHOT_COLUMNS
) -> DataFrame:
    """The partition of day ``day`` of a ``yyyyMM`` period."""
    wanted = (int(period[:4]), int(period[4:6]), day)
    for name, value in zip(columns, wanted):
        df = df.where(F.col(name).cast("int") == value)
    return df


def _csv_reader(spark: SparkSession, schema: str, mode: str) -> DataFrameReader:
    # Without pruning every row is cut into all its fields, and those with too few or too many are noticed.
    return spark.read.schema(schema).options(header=True, delimiter=",", mode=mode, columnPruning=False)


def _check_header(spark: SparkSession, path: str, names: list[str]) -> None:
    """A known name at another one's place means that the columns are swapped."""
    header = [name.strip().lower() for name in spark.read.options(header=True, delimiter=",").csv(path).columns]
    wrong = [name for place, name in enumerate(header) if name in names and names.index(name) != place]
    if wrong or len(header) != len(names):
        raise ValueError(f"{path} has the columns {', '.join(header)} where {', '.join(names)} are read")


def read_csv_list(
    spark: SparkSession,
    path: str,
    schema: str = "cod_plan string, descripcion string",
    rename: dict[str, str] | None = None,
    bad_rows: str = "fail",
) -> DataFrame:
    """A comma-separated list with a header line; columns bind by position.

    The header may use other names, but not these in another order, nor more or fewer. Rows
    with too few or too many fields end the read with an error that shows the first of them;
    with ``bad_rows="keep"`` they are read as far as they go. ``rejected_rows`` lists them.
    """
    names = [part.split()[0].lower() for part in schema.split(",")]
    _check_header(spark, path, names)
    rows = _csv_reader(spark, schema, "FAILFAST" if bad_rows == "fail" else "PERMISSIVE").csv(path)
    return rows.withColumnsRenamed(rename or {"cod_plan": "product_key"})


def rejected_rows(
    spark: SparkSession, path: str, schema: str = "cod_plan string, descripcion string"
) -> DataFrame:
    """(row): the lines of a list that have too few or too many fields, as they stand in the file."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "row"}
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_csv("value", f"{schema}, row string", options)["row"].alias("row")).filter("row is not null")


def read_plan_list(spark: SparkSession, path: str, bad_rows: str = "fail") -> DataFrame:
    """The pay-per-use plan list with trimmed keys."""
    return normalise(read_csv_list(spark, path, bad_rows=bad_rows), "plan_list")


def _jdbc_reader(spark: SparkSession, url: str, table: str, props: dict[str, str] | None) -> DataFrameReader:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(props or {}))


def jdbc_bounds(
    spark: SparkSession, url: str, table: str, column: str, props: dict[str, str] | None = None
) -> tuple[object, object] | None:
    """The least and the greatest value of a column, asked of the database; null if it has none."""
    names = _jdbc_reader(spark, url, table, props).load().columns
    name = next((n for n in names if n.lower() == column.lower()), column)
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(name)
    asked = f"(SELECT MIN({quoted}) AS lo, MAX({quoted}) AS hi FROM {table}) bounds"
    low, high = _jdbc_reader(spark, url, asked, props).load().first()
    return None if low is None else (low, high)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: dict[str, str] | None = None,
    bounds: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """A database table. ``bounds`` = (column, lower, upper, partitions) reads it in parallel.

    Without bounds Spark reads it over one connection in one task, so give them
    for anything large. The column is a number, date or timestamp; with null for lower and
    upper the database is asked for them. They only place the splits: no row is left
    out, and rows without a value come with the first split.
    """
    reader = _jdbc_reader(spark, url, table, props)
    if not bounds:
        return reader.load()
    column, lower, upper, partitions = bounds
    if lower is None or upper is None:
        found = jdbc_bounds(spark, url, table, column, props)
        if found is None:
            return reader.load()
        lower, upper = found
    return reader.options(
        partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=partitions
    ).load()


def read_bucketed(spark: SparkSession, tables: dict[str, str]) -> dict[str, DataFrame]:
    """Source tables that ``sinks.write_bucketed`` stored: {contract's name: catalog's name}.

    They are in their contract's types already, and their keys must not be touched: only so
    does Spark know that a bucket holds all rows of its keys.
    """
    return {name: spark.table(table).select(*TABLES[name]) for name, table in tables.items()}


def read_domain(
    spark: SparkSession,
    root: str,
    names: tuple[str, ...],
    period: str | None = None,
    plan_list_path: str | None = None,
    losses: CastLosses | None = None,
) -> dict[str, DataFrame]:
    """The named source tables found under one root folder.

    The parcs are dated by partition: the daily one is read at its latest date,
    the monthly one at day 1 of ``period``. The plan list is a CSV file. ``losses`` counts
    what casts lose in the others.
    """

    def table(name: str) -> DataFrame:
        if name == "plan_list":
            return read_plan_list(spark, plan_list_path or f"{root.rstrip('/')}/plan_list.csv")
        if name == "parc_kfactor":
            return read_dated(spark, root, name)
        if name == "parc_coliving":
            return read_dated(spark, root, name, period)
        return read_table(spark, root, name, losses)

    return {name: table(name) for name in names}
