"""Create a key/value table and load it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def has_hive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive"


def create_and_load(spark: SparkSession, table: str, rows: DataFrame, location: str) -> DataFrame:
    """``table(key LONG, value STRING)`` filled with ``rows``.

    With Hive support the rows are staged as text and moved in with LOAD DATA;
    else the table is a Parquet table at ``location`` filled by INSERT.
    """
    if has_hive(spark):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (key LONG, value STRING) USING hive")
        rows.selectExpr("concat_ws('\\u0001', cast(key as string), value) AS line").write.text(location)
        spark.sql(f"LOAD DATA INPATH '{location}' INTO TABLE {table}")
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (key LONG, value STRING) "
                  f"USING parquet LOCATION '{location}'")
        view = f"{table}_rows"
        rows.createOrReplaceTempView(view)
        spark.sql(f"INSERT INTO {table} SELECT CAST(key AS LONG), CAST(value AS STRING) FROM {view}")
        spark.catalog.dropTempView(view)
    return spark.table(table)
