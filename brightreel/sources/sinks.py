"""Sinks (K1-K5): partitioned tables, payloads, markers, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_cells(df: DataFrame, path: str, keys: list[str]) -> None:
    """K3: overwrites only the partitions that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """K4: diagnostics are only ever added."""
    df.write.mode("append").json(path)


def write_payload(df: DataFrame, path: str) -> None:
    """K2: one JSON object per row."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def merged_markers(old: DataFrame, new: DataFrame) -> DataFrame:
    """K5: sorted distinct union of marker rows."""
    return old.unionByName(new).distinct().orderBy(*old.columns)


def html_rows(df: DataFrame) -> DataFrame:
    """K1: one table row of a page per row, values escaped; the page is written, not collected."""
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return df.select(F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), safe(c), F.lit("</td>")) for c in df.columns], F.lit("</tr>")).alias("value"))
