"""Named views over layer tables and SQL text on them (VIEW3).

The dashboards query layer tables by name with SQL text; here every layer
DataFrame is registered as a session temp view and SQL runs through
``spark.sql`` — Catalyst plans it like any DataFrame query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_catalog(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """VIEW3: register each DataFrame as a temp view ``prefix + name``; return name -> view name."""
    out = {}
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        out[name] = view
    return out


def query_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """VIEW3: run SQL text against registered views (and DataFrames passed as ``{name}`` parameters)."""
    return spark.sql(sql, **frames) if frames else spark.sql(sql)
