"""Database tables over JDBC (driver jar supplied by the cluster)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changelake.operators.audit import DEFAULT_CONTROL_COLUMN, pending


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A table read in parallel ranges of ``partition_column`` when given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions or 8))
        )
    return r.load()


def read_audit(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
               pending_only: bool = True, control: str = DEFAULT_CONTROL_COLUMN, **partitioning) -> DataFrame:
    """Audit rows; the pending filter is pushed into the database query."""
    df = read_table(spark, url, table, properties, **partitioning)
    return pending(df, control) if pending_only else df


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                mode: str = "append") -> None:
    """Insert rows into a database table."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
