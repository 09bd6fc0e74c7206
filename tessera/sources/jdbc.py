"""JDBC edge connector: partitioned reads, replace and append writes.

A plain ``read.jdbc(url, table)`` is one task over the whole table. At scale
reads are split on a numeric/date column into ``num_partitions`` ranges, each
a separate query the database can serve with an index range scan. Bounds may be
given, or are fetched with one pushed-down ``min/max`` query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str | None = None, num_partitions: int | None = None,
              lower_bound=None, upper_bound=None, fetchsize: int = 10_000,
              quote: str = '"', predicates: list[str] | None = None,
              one_task: bool = False) -> DataFrame:
    """Read ``table`` in parallel.

    A read that nothing splits is an error unless ``one_task=True`` asks for it.

    ``partition_column`` (numeric, date or timestamp) splits into
    ``num_partitions`` range queries; ``quote`` wraps the column name in the
    bounds query (``"`` for ANSI databases, a backtick for MySQL). For text keys
    or uneven ranges pass ``predicates``: one WHERE clause per partition (they
    must not overlap, or rows are read twice).
    """
    props = dict(properties)
    props.setdefault("fetchsize", str(fetchsize))
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if not partition_column or not num_partitions or num_partitions <= 1:
        if not one_task:
            raise ValueError(f"{table}: give partition_column and num_partitions, or predicates, "
                             "or one_task=True for a small table")
        return spark.read.jdbc(url, table, properties=props)
    if lower_bound is None or upper_bound is None:
        # the exact stored name (case may differ from what the caller typed)
        names = {c.lower(): c for c in spark.read.jdbc(url, table, properties=props).columns}
        col = f"{quote}{names.get(partition_column.lower(), partition_column)}{quote}"
        q = f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table}) bounds"
        row = spark.read.jdbc(url, q, properties=props).first()
        lower_bound, upper_bound = row[0], row[1]
        if lower_bound is None:  # empty table
            return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column,
                           lowerBound=lower_bound, upperBound=upper_bound,
                           numPartitions=num_partitions, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "overwrite", truncate: bool = False,
               num_partitions: int | None = None, batchsize: int = 10_000) -> None:
    """``overwrite`` replaces the table (drop + create unless ``truncate``), ``append`` adds rows.

    ``num_partitions`` caps concurrent database connections by coalescing.
    """
    props = dict(properties)
    props.setdefault("batchsize", str(batchsize))
    if truncate:
        props["truncate"] = "true"
    if num_partitions:
        df = df.coalesce(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=props)


def run_in_transaction(spark: SparkSession, url: str, properties: dict[str, str],
                       statements: list[str]) -> None:
    """Run SQL statements over one connection of the driver: all of them take effect, or none."""
    jvm = spark.sparkContext._jvm
    if properties.get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    settings = jvm.java.util.Properties()
    for k, v in properties.items():
        if k != "driver":
            settings.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


BATCH = "load_batch"


def publish(df: DataFrame, url: str, table: str, properties: dict[str, str], batch: int,
            mode: str = "overwrite", quote: str = '"', num_partitions: int | None = None) -> None:
    """Make ``df`` the table's rows (``overwrite``) or the rows of load ``batch`` (``append``),
    however often it is run.

    Tasks write to a staging table ``<table>_stage`` that each attempt replaces; then one
    transaction deletes what the load replaces (all rows, or those of ``batch``) and
    inserts the staged ones with their batch number. A run that dies before that
    transaction leaves the table as it was, and one that is repeated after it
    replaces its own rows, so readers never see a half-written or doubled load.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    rows = df.withColumn(BATCH, F.lit(int(batch)).cast("long"))
    stage = f"{table}_stage"
    write_jdbc(rows, url, stage, properties, mode="overwrite", num_partitions=num_partitions)
    rows.limit(0).coalesce(1).write.jdbc(url, table, mode="append", properties=properties)  # if missing
    columns = ", ".join(f"{quote}{c}{quote}" for c in rows.columns)
    where = "" if mode == "overwrite" else f" WHERE {quote}{BATCH}{quote} = {int(batch)}"
    run_in_transaction(df.sparkSession, url, properties, [
        f"DELETE FROM {table}{where}",
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}"])
