"""Database targets over JDBC (K1-K4).

No connection is opened by this library outside Spark's own writer. A JDBC
replace is not atomic: ``run_load`` therefore checks and stages the whole load
in the lake first and copies only a validated snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.sources.jdbc import jdbc_options


def _writer(df: DataFrame, url, table, user, password, driver, num_partitions, batch_size, **extra):
    # numPartitions caps concurrent connections; Spark coalesces to it.
    opts = jdbc_options(url, table, user, password, driver, numPartitions=num_partitions,
                        batchsize=batch_size, **extra)
    return df.write.format("jdbc").options(**opts)


def append_jdbc(df: DataFrame, url: str, table: str, *, user=None, password=None, driver=None,
                num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """K1: insert the rows."""
    _writer(df, url, table, user, password, driver, num_partitions, batch_size).mode("append").save()


def replace_jdbc(df: DataFrame, url: str, table: str, *, user=None, password=None, driver=None,
                 num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """K2 + K3: empty the table, keep its definition, insert the rows."""
    (_writer(df, url, table, user, password, driver, num_partitions, batch_size, truncate="true")
     .mode("overwrite").save())


def recreate_jdbc(df: DataFrame, url: str, table: str, *, user=None, password=None, driver=None,
                  num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """K4: drop and create the table from the rows' schema, then insert."""
    (_writer(df, url, table, user, password, driver, num_partitions, batch_size, truncate="false")
     .mode("overwrite").save())
