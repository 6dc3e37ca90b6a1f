"""The SKU dimension: seeding, catalogue view, JDBC reader, DDL."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DIM_BASE_IDS, DIM_COPIES, SKU_DIM
from ..storage import publish, published, read_text, remove
from .tables import read_table


def sku_catalogue(part: DataFrame) -> DataFrame:
    """``part`` seen as a SKU table: id, sku_name, category, price."""
    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(SKU_DIM["price"].dataType).alias("price"),
    )


def seed_dimension(
    base: DataFrame, base_ids: int = DIM_BASE_IDS, copies: int = DIM_COPIES
) -> DataFrame:
    """Base rows with id 1..base_ids, repeated as ``id + base_ids * n``, n = 0..copies-1.

    The repetition is a fixed-size generator on each base row (no join), so the
    seed is one scan with the id range pushed to the reader.
    """
    rows = base.filter((F.col("id") >= 1) & (F.col("id") <= base_ids)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_n")
    )
    return rows.select(
        (F.col("id") + F.lit(base_ids) * F.col("_n")).cast("bigint").alias("id"),
        "sku_name",
        "category",
        "price",
    )


def sku_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 200-row dimension the order events join to (ids 1..200)."""
    return seed_dimension(sku_catalogue(read_table(spark, sf_dir, "part")))


def read_jdbc_dimension(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Dimension over JDBC.  Not cached: a stream-static join re-reads it per trigger.

    With ``partition_column`` the read is split into ``num_partitions`` range
    queries instead of one connection reading the whole table.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 1))
        )
    return reader.load()


def write_jdbc_dimension(df: DataFrame, url: str, table: str, properties: dict | None = None,
                         truncate_first: bool = True) -> None:
    """Reload a JDBC dimension: truncate (keeping the table's DDL) then insert."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    if truncate_first:
        writer = writer.option("truncate", "true").mode("overwrite")
    else:
        writer = writer.mode("append")
    writer.save()


def create_dimension_table(spark: SparkSession, name: str, database: str | None = None,
                           location: str | None = None) -> str:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` for the SKU dimension (parquet)."""
    full = name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        full = f"{database}.{name}"
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} "
        "(id BIGINT, sku_name STRING, category STRING, price DECIMAL(10,2)) "
        f"USING parquet{loc}"
    )
    return full


def reload_dimension_table(spark: SparkSession, full_name: str, rows: DataFrame) -> None:
    """Truncate then insert: re-runnable like the reference's seed script."""
    spark.sql(f"TRUNCATE TABLE {full_name}")
    rows.select("id", "sku_name", "category", "price").write.insertInto(full_name)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database ordered by name (``SHOW TABLES`` as a DataFrame; no temporary views)."""
    shown = spark.sql(f"SHOW TABLES IN {database}").filter("not isTemporary")
    return shown.select("tableName").orderBy("tableName")


def describe_table(spark: SparkSession, full_name: str) -> DataFrame:
    """Columns of a table in their order: position, column_name, data_type, nullable."""
    columns = spark.catalog.listColumns(full_name)
    rows = [(i, c.name, c.dataType, c.nullable) for i, c in enumerate(columns, 1)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def tables_by_schema(spark: SparkSession, database: str, name: str | None = None) -> DataFrame:
    """Tables of a schema, or those of one name there: table_schema, table_name, table_type, by name."""
    found = spark.catalog.listTables(database)
    rows = [(database, t.name, t.tableType) for t in found if not t.isTemporary and name in (None, t.name)]
    schema = "table_schema string, table_name string, table_type string"
    return spark.createDataFrame(rows, schema).orderBy("table_name")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (a primary key Spark does not enforce)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter(F.col("cnt") > 1)
    )


class DimensionSnapshots:
    """Versions of a dimension in files, the newest of which a running stream looks up.

    Each version is a folder of its own that is never changed; a small pointer, published
    when the folder is complete, names it.  Readers of an older version keep its files
    until ``keep`` newer ones are there.
    """

    def __init__(self, root: str, keep: int = 3):
        self.root, self.keep = root.rstrip("/"), keep

    def publish(self, rows: DataFrame) -> str:
        """Write ``rows`` as the newest version; returns its name."""
        spark = rows.sparkSession
        known = published(spark, f"{self.root}/versions")
        number = int(known[-1].split("-")[0]) + 1 if known else 0
        name = f"{number:012d}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.root}/data/{name}")
        publish(spark, f"{self.root}/versions/{name}", json.dumps({"schema": rows.schema.json(), "data": name}))
        for old in known[: max(0, len(known) + 1 - self.keep)]:
            remove(spark, f"{self.root}/versions/{old}")
            remove(spark, f"{self.root}/data/{old}")
        return name

    def current(self, spark: SparkSession) -> DataFrame:
        """The newest version whose pointer is whole."""
        for name in reversed(published(spark, f"{self.root}/versions")):
            try:
                held = json.loads(read_text(spark, f"{self.root}/versions/{name}") or "")
                schema = StructType.fromJson(json.loads(held["schema"]))
                return spark.read.schema(schema).parquet(f"{self.root}/data/{held['data']}")
            except (ValueError, KeyError, TypeError):
                continue  # cut short: the version before it is served
        raise FileNotFoundError(f"no dimension has been published under {self.root}")
