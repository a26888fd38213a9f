"""Tables of databases."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..endpoints import Jdbc
from ..errors import ConfigError
from ..storage import fresh_path


def at_hand(spark: SparkSession, spec: Jdbc) -> bool:
    """Whether tasks reach the database: executors other than the driver's own process have no embedded one."""
    return not spec.embedded or spark.sparkContext._jsc.sc().isLocal()


@contextmanager
def connected(spark: SparkSession, spec: Jdbc) -> Iterator[tuple]:
    """(connection of the driver, Spark's options for it, dialect), closed at the end."""
    jvm = spark._jvm
    given = {"batchsize": str(spec.batch), "fetchsize": str(spec.fetch)} | ({"driver": spec.driver} if spec.driver else {})
    options = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(spec.url, spec.table, jvm.PythonUtils.toScalaMap(given))
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(spec.url)
    connection = dialect.createConnectionFactory(options).apply(-1)
    try:
        yield connection, options, dialect
    finally:
        connection.close()


def read_jdbc(spark: SparkSession, spec: Jdbc, missing: str = "error") -> DataFrame:
    """``SELECT *`` of a table; columns and predicates are pushed down.

    With a partition column and its bounds the scan is split into ``partitions`` range queries.  With ``missing="empty"``
    a table that cannot be described has no rows and no columns.  On a cluster the driver takes the rows of an embedded database to
    the shared folder, ``fetch`` of them at a time.
    """
    reader = spark.read.format("jdbc").option("url", spec.url).option("dbtable", spec.table).option("fetchsize", spec.fetch)
    if spec.driver:
        reader = reader.option("driver", spec.driver)
    if spec.partition_column:
        if spec.lower is None or spec.upper is None or not spec.partitions:
            raise ConfigError("a partition column needs bounds and a number of partitions")
        reader = (
            reader.option("partitionColumn", spec.partition_column)
            .option("lowerBound", spec.lower)
            .option("upperBound", spec.upper)
            .option("numPartitions", spec.partitions)
        )
    try:
        rows = reader.load()
    except (Py4JJavaError, PySparkException):
        if missing != "empty":
            raise
        return spark.createDataFrame([], StructType([]))
    return rows if at_hand(spark, spec) else _taken(rows, spec)


def _taken(described: DataFrame, spec: Jdbc) -> DataFrame:
    spark, jvm, path = described.sparkSession, described.sparkSession._jvm, fresh_path(described.sparkSession, "jdbc")
    schema = described._jdf.schema()
    described.limit(0).write.parquet(path)  # an empty table has no pages
    with connected(spark, spec) as (connection, _, dialect):
        connection.setAutoCommit(False)  # else some drivers hold all rows of a result
        statement = connection.createStatement()
        statement.setFetchSize(spec.fetch)
        found = statement.executeQuery(f"SELECT * FROM {spec.table}")
        rows = jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.resultSetToRows(found, schema, dialect)
        pages = rows.grouped(spec.fetch)
        while pages.hasNext():
            page = jvm.scala.jdk.javaapi.CollectionConverters.asJava(pages.next())
            DataFrame(spark._jsparkSession.createDataFrame(page, schema), spark).write.mode("append").parquet(path)
        connection.rollback()
    return spark.read.schema(described.schema).parquet(path)
