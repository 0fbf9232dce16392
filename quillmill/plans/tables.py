"""Small fixtures that a query and its SQL read alike, and the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(s: str | None) -> str:
    """A literal that Spark and DuckDB read alike; line breaks as chr(10)."""
    if s is None:
        return "CAST(NULL AS VARCHAR(4000))"
    parts = s.split("\n")
    return parts and "concat(" + ", chr(10), ".join("'" + p.replace("'", "''") + "'" for p in parts) + ", '')"


def values(columns: str, rows: list[tuple]) -> str:
    """``SELECT`` of the rows, for both engines."""
    names = columns.split()
    one = lambda r: "SELECT " + ", ".join(f"{sql_text(v) if isinstance(v, str) or v is None else v} AS {n}" for v, n in zip(r, names, strict=True))
    return " UNION ALL ".join(map(one, rows))
