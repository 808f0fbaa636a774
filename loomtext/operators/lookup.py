"""Finding one article."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

PREVIEW = 5000


def lookup_article(df: DataFrame, page_id: str, id_column: str = "page_id", texts: tuple[str, ...] = ("official_text", "clone_text")) -> DataFrame:
    """One row of the page (the filter reaches the scan): id, and for each text its length (of a null, that of "None") and first PREVIEW characters."""
    out = [F.col(id_column)]
    for t in texts:
        shown = F.coalesce(F.col(t), F.lit("None"))
        out += [F.length(shown).alias(f"{t}_length"), F.substring(shown, 1, PREVIEW).alias(f"{t}_preview"), (F.length(shown) > PREVIEW).alias(f"{t}_truncated")]
    return df.where(F.col(id_column) == page_id).limit(1).select(*out)


def show_article(df: DataFrame, page_id: str, **options) -> dict:
    """The row as a dictionary; an error if there is none."""
    row = lookup_article(df, page_id, **options).first()
    if row is None:
        raise LookupError(f"Article {page_id} not found")
    return row.asDict()


def indexed(writer: DataFrameWriter, *columns: str, group_bytes: int | None = None) -> DataFrameWriter:
    """A Parquet writer that adds Bloom filters for the columns to each row group, sized by what the group holds.

    Equality filters then skip row groups without the value, whatever the order of rows; smaller groups skip more.
    """
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return writer if group_bytes is None else writer.option("parquet.block.size", group_bytes)


def rows_read(df: DataFrame) -> int:
    """Runs df and returns how many rows its scans gave: those of the row groups that no filter could skip."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return sum(m.get().value() for m in metrics if m.isDefined())
