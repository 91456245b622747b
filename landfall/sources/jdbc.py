"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, *, user=None, password=None, driver=None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int | None = 10000) -> DataFrame:
    """Whole table. With ``partition_column`` and bounds, ``num_partitions``
    range queries run in parallel instead of one connection reading all rows."""
    opts = jdbc_options(url, table, user, password, driver, fetchsize=fetch_size)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return spark.read.format("jdbc").options(**opts).load()
