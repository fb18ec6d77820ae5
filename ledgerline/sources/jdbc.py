"""The application database through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, url: str, table: str, user: str, password: str,
    split_on: str | None = None, lower=None, upper=None, splits: int = 1, **options,
) -> DataFrame:
    """A database table. Range filters and column choice are pushed to the database.

    With ``split_on`` the read is divided into ``splits`` ranges of that column,
    otherwise one task reads everything.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, user=user, password=password, **options)
    if split_on is not None:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=lower, upperBound=upper, numPartitions=splits
        )
    return reader.load()
