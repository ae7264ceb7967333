"""Schemas and tables in the Spark catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class LocationConflict(RuntimeError):
    """A schema exists somewhere else than expected."""


def _plain(location: str | None) -> str:
    text = (location or "").strip().rstrip("/")
    # the catalog writes local folders as file:/x or file:///x
    return "/" + text[len("file:"):].lstrip("/") if text.startswith("file:") else text


def same_location(a: str | None, b: str | None) -> bool:
    return _plain(a) == _plain(b)


def schema_location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.databaseExists(name):
        return None
    return spark.catalog.getDatabase(name).locationUri


def ensure_schema(spark: SparkSession, name: str, location: str) -> str:
    """CREATED or UNCHANGED; an empty location or one that differs from the catalog is an error."""
    if not _plain(location):
        raise ValueError("a schema location is required")
    existing = schema_location(spark, name)
    if existing is not None:
        if not same_location(existing, location):
            raise LocationConflict(f"schema {name} is at {existing}, expected {location}")
        return "UNCHANGED"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{location}'")
    if not same_location(schema_location(spark, name), location):
        raise LocationConflict(f"schema {name} was not created at {location}")
    return "CREATED"


def register_table(spark: SparkSession, schema: str, table: str, path: str) -> str:
    """Points a catalog table at a written version: CREATED, or REFRESHED when it is already there."""
    name = f"`{schema}`.`{table}`"
    if spark.catalog.tableExists(f"{schema}.{table}"):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {name}")
        return "REFRESHED"
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return "CREATED"


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def table_count(spark: SparkSession, schema: str, table: str) -> int:
    return spark.table(f"`{schema}`.`{table}`").count()


def define_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
