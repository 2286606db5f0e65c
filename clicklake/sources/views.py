"""Named views and catalog tables for SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame


def session_view(df: DataFrame, name: str, replace: bool = True) -> None:
    """Name ``df`` in its own session; with ``replace=False`` an existing name is an error."""
    if replace:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)


def shared_view(df: DataFrame, name: str, replace: bool = False) -> str:
    """Name ``df`` for all sessions of the application; returns the qualified name."""
    if replace:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createGlobalTempView(name)
    return f"global_temp.{name}"


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Write ``df`` as a Parquet catalog table; ``path`` puts the files in a chosen folder."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
