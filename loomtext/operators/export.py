"""Articles as text files: one for each page and side."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import schema as S
from ..sources.textfiles import write_text_files
from .parse import quoted


def _place(df: DataFrame) -> Column:
    """What orders the rows of df: file and place in it, as Spark's splits don't follow the order of files."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return F.monotonically_increasing_id()
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


#: Sides of a page and the columns of their texts.
SIDES = {"official": "official_text_paragraphs", "clone": "clone_text_paragraphs"}


def export_rows(df: DataFrame, sides: dict[str, str] | None = None) -> DataFrame:
    """side, page_id, name, content of the files to write: for each page and side the first row with a text gives text and title.

    `sides` maps names to columns of texts; then page and title are detected as for parsing, so results of any columns can be
    exported (`{"parsed": "text_parsed"}`). Without it the columns are those of the two versions of a page, or it is an error.

    First is by the path of a row's file, then its place in the file, where df comes from files; else by place in df. Rows
    without a page_id give nothing. One shuffle, by page; each task first reduces its rows to the first of each page, so
    what loses there isn't shuffled."""
    if sides is None:
        S.check_export(df.schema)
        sides, page, title = SIDES, "page_id", "page_title"
    else:
        page, title = S.detect_id_column(df.schema), S.detect_title_column(df.schema)
        if page is None or not all(c in df.columns for c in sides.values()):
            raise ValueError(f"no page id, or not all of the columns {sorted(sides.values())}")
    named = quoted(title).cast("string") if title else F.lit(None).cast("string")
    texts = [quoted(c).alias(f"text_{i}") for i, c in enumerate(sides.values())]
    rows = df.where(quoted(page).isNotNull()).select(quoted(page).cast("string").alias("page_id"), named.alias("page_title"), *texts, _place(df).alias("at"))
    first = lambda side: F.expr(f"min_by(struct(page_title, {side} AS text), at) FILTER (WHERE {side} IS NOT NULL)")
    pages = rows.groupBy("page_id").agg(*[first(f"text_{i}").alias(f"row_{i}") for i in range(len(sides))])
    each = F.array(*[F.struct(F.lit(side).alias("side"), F.col(f"row_{i}").alias("row")) for i, side in enumerate(sides)])
    files = pages.select("page_id", F.explode_outer(each).alias("s")).where("s.row is not null").select("page_id", "s.side", "s.row.page_title", "s.row.text")
    head = F.concat(F.lit("Page ID: "), "page_id", F.lit("\nTitle: "), F.coalesce("page_title", F.lit("untitled")), F.lit("\n"), F.repeat(F.lit("="), 60), F.lit("\n\n"))
    return files.select("side", "page_id", F.concat("page_id", F.lit("_"), "side", F.lit(".txt")).alias("name"), F.concat(head, "text").alias("content"))


def export_single(df: DataFrame, folder: str) -> int:
    """Write the texts of each column of parsed texts as `<page>_<column>.txt`; returns how many files were written."""
    sides = {c: c for c in S.clean_columns(df.schema)}
    return write_text_files(export_rows(df, sides).select(F.lit(0).alias("folder"), "name", "content"), [folder]) if sides else 0


def export_text(df: DataFrame, official_dir: str = "data/parsed_export", clone_dir: str | None = None) -> int:
    """Write the files of `export_rows` into folders of any file system that `sources.textfiles` opens; returns how many were written.

    A file that is there already is left as it is, so a rerun writes nothing. Files appear when all tasks have ended well; a
    lost task leaves no part of one. A page_id that would leave the folder is an error.
    """
    rows = export_rows(df).select(F.when(F.col("side") == "official", 0).otherwise(1).alias("folder"), "name", "content")
    return write_text_files(rows, [official_dir, clone_dir or official_dir])
