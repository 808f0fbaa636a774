"""What a run did, counted while it runs: rows, and for each text column how many were parsed, null or skipped; and which."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources import schema as S
from .parse import quoted

#: What a skipped text holds, whatever the number of seconds.
SKIPPED = r"\A\[Article skipped: parsing timeout after [0-9]+ seconds\]\z"


def is_skipped(text: Column) -> Column:
    return F.coalesce(text.startswith("[Article skipped: ") & text.rlike(SKIPPED), F.lit(False))


def counts(columns: list[str]) -> list[Column]:
    """rows, and parsed, null, skipped and chars of each column, null texts having none."""
    out = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        text = quoted(c)
        out += [
            F.coalesce(F.sum((text.isNotNull() & ~is_skipped(text)).cast("long")), F.lit(0)).alias(f"{c}.parsed"),
            F.coalesce(F.sum(text.isNull().cast("long")), F.lit(0)).alias(f"{c}.null"),
            F.coalesce(F.sum(is_skipped(text).cast("long")), F.lit(0)).alias(f"{c}.skipped"),
            F.coalesce(F.sum(F.length(text).cast("long")), F.lit(0)).alias(f"{c}.chars"),
        ]
    return out


def observed(df: DataFrame, into: Observation | str, columns: list[str] | None = None) -> DataFrame:
    """df, with its counts collected into `into` by the job that computes it: no second pass, and sums alone go to the driver.

    Columns are the given ones, else those of parsed texts, by their names. `into` is an Observation, for one job, or in a
    stream a name under which each batch's progress has them. A task that is run again for a lost output may be counted again.
    """
    return df.observe(into, *counts(S.clean_columns(df.schema) if columns is None else columns))


def totals(observations: list[dict]) -> dict[str, int]:
    """parsed, null and skipped texts over all columns of what was observed."""
    return {kind: sum(v for o in observations for k, v in o.items() if k.endswith(f".{kind}")) for kind in ("parsed", "null", "skipped")}


def article_log(df: DataFrame, columns: list[str] | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """A row for each article and text column: page_id (`unknown` if null; without such a column `row_<i>`, with a different i
    for each row), title (`untitled`), column, state (parsed, null or skipped), chars (null for null); before them the columns in `more`."""
    page, title = S.detect_id_column(df.schema), S.detect_title_column(df.schema)
    number = F.concat(F.lit("row_"), F.monotonically_increasing_id().cast("string"))
    page_id = F.coalesce(quoted(page).cast("string"), F.lit("unknown")) if page else number
    named = F.coalesce(quoted(title).cast("string"), F.lit("untitled")) if title else F.lit("untitled")
    names = S.clean_columns(df.schema) if columns is None else columns
    if not names:
        raise ValueError("no column of parsed texts")
    state = lambda t: F.when(t.isNull(), "null").when(is_skipped(t), "skipped").otherwise("parsed")
    each = F.array(*[F.struct(F.lit(c).alias("column"), state(quoted(c)).alias("state"), F.length(quoted(c)).cast("long").alias("chars")) for c in names])
    return df.select(*map(quoted, more), page_id.alias("page_id"), named.alias("title"), F.explode(each).alias("e")).select(*map(quoted, more), "page_id", "title", "e.*")


def skipped_articles(df: DataFrame, columns: list[str] | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """page_id, title, column of the articles that were skipped; before them the columns in `more`."""
    return article_log(df, columns, more).where("state = 'skipped'").drop("state", "chars")
