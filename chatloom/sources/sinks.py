"""Writers: partitioned tables, one JSON object a row, Markdown cohort tables, theme exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """One JSON object a row, nulls kept, in files by task; with `by`, in a folder for each value."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*by) if by else writer).json(path)


def as_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(column))


def markdown_rows(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """order, line: the rows of a Markdown table, nulls as empty cells; the header has the lowest order."""
    cells = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[|\n]", " ") for c in columns]
    body = df.select(F.col(order).cast("long").alias("order"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    head = [(-2, "| " + " | ".join(columns) + " |"), (-1, "|" + "---|" * len(columns))]
    return df.sparkSession.createDataFrame(head, "order long, line string").unionByName(body)


def write_markdown(df: DataFrame, columns: list[str], order: str, path: str) -> None:
    """A small report table as one text file; df must already be cut to a report's size."""
    markdown_rows(df, columns, order).repartitionByRange(1, "order").sortWithinPartitions("order").select("line").write.mode("overwrite").text(path)


def theme_export(matches: DataFrame) -> DataFrame:
    """theme_id, messages, phrase_counts (map) from a row for each match (theme_id, phrase)."""
    each = matches.groupBy("theme_id", "phrase").agg(F.count("*").alias("n"))
    counted = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("phrase").isNotNull(), F.struct("phrase", "n")))))
    return each.groupBy("theme_id").agg(F.sum("n").alias("messages"), counted.alias("phrase_counts"))
