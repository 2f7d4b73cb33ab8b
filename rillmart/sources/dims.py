"""Dictionary, dimension and rule tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DICTIONARY_SCHEMA = ("dic_code string, dic_name string, parent_code string, "
                     "create_time timestamp, operate_time timestamp")


def read_table(spark: SparkSession, path: str | None = None, jdbc: Mapping[str, str] | None = None,
               query: str | None = None, schema: str | None = None) -> DataFrame:
    """A static table from parquet files or, with ``jdbc`` options, from a database.

    ``query`` pushes a whole statement to the database. Give ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` in ``jdbc`` to read a large
    table in parallel.
    """
    if jdbc is None:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    options = dict(jdbc)
    if query is not None:
        options.pop("dbtable", None)
        options["query"] = query
    return spark.read.format("jdbc").options(**options).load()


def read_dictionary(spark: SparkSession, path: str | None = None,
                    jdbc: Mapping[str, str] | None = None) -> DataFrame:
    return read_table(spark, path, jdbc, schema=None if jdbc else DICTIONARY_SCHEMA)


def read_rules(spark: SparkSession, sink_type: str, path: str | None = None,
               jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """The preloaded rules of one sink type."""
    return read_table(spark, path, jdbc).where(F.col("sink_type") == sink_type)


def text_schema(columns_csv: str) -> T.StructType:
    """Schema of a dimension table named by a rule: every column is text."""
    return T.StructType([T.StructField(c.strip(), T.StringType()) for c in columns_csv.split(",")])


def rows_as_text(df: DataFrame, columns_csv: str, data: str = "data") -> DataFrame:
    """``data`` maps as rows of the table described by a rule's column list."""
    return df.select(*[F.col(data)[f.name].alias(f.name) for f in text_schema(columns_csv)])


def create_table(spark: SparkSession, name: str, columns_csv: str, pk: str | None = None,
                 extend: str | None = None) -> None:
    """Create a rule's target table once: text columns, the key noted, optional suffix."""
    fields = ", ".join(f"`{f.name}` string" for f in text_schema(columns_csv))
    spark.sql(f"create table if not exists `{name}` ({fields}) using parquet "
              f"{extend or ''} tblproperties ('primary_key' = '{pk or 'id'}')")
