"""Phase one and two as DataFrame operators: parse markup columns, clean parsed columns. Narrow, without a shuffle."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.udf import extract_udf, skipped
from ..sources import schema as S


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _parse_columns(df: DataFrame, names: list[str], skip_lists: bool, timeout: int, steps: int | None) -> tuple[DataFrame, dict[str, Column]]:
    """df with paragraph arrays for the named columns, and the final text of each; the markup parser runs once for all of them."""
    run = extract_udf(skip_lists, timeout, steps=steps)
    own = uuid.uuid4().hex  # no input column has such a name
    at = {n: f"{own}_{i}" for i, n in enumerate(names)}
    raw = df.select("*", *[run(quoted(n)).alias(f"raw_{a}") for n, a in at.items()])
    text = lambda a: X.collapse_newlines(X.remove_images(X.expand_templates(F.col(f"raw_{a}"))))
    parts = raw.select("*", *[X.paragraphs(text(a)).alias(f"parts_{a}") for a in at.values()])
    late = F.lit(skipped(timeout))
    done = {n: F.when(F.col(f"raw_{a}") == late, late).otherwise(X.join_paragraphs(X.drop_empty_sections(F.col(f"parts_{a}")))) for n, a in at.items()}
    return parts, done


def parse_wikitext(df: DataFrame, columns: dict[str, str], skip_lists: bool = False, timeout: int = 30, steps: int | None = None) -> DataFrame:
    """df with new string columns: columns maps a markup column to the name of its text."""
    parts, done = _parse_columns(df, list(columns), skip_lists, timeout, steps)
    return parts.select(*[quoted(c) for c in df.columns], *[done[n].alias(to) for n, to in columns.items()])


def parse_dual(df: DataFrame, skip_lists: bool = False, timeout: int = 30, keep: tuple[str, ...] = (), steps: int | None = None) -> DataFrame:
    """The seven-column table of two versions of a page: both texts parsed, other columns as they are, extra columns dropped but for those in `keep`, which come last."""
    S.check_dual(df.schema)
    parts, done = _parse_columns(df, ["official_text", "clone_text"], skip_lists, timeout, steps)
    return parts.select(
        "page_id",
        "page_title",
        done["official_text"].alias("official_text_paragraphs"),
        "official_timestamp",
        "clone_page_title",
        done["clone_text"].alias("clone_text_paragraphs"),
        "clone_timestamp",
        *map(quoted, keep),
    )


def parse_single(df: DataFrame, text_column: str | None = None, skip_lists: bool = False, timeout: int = 30, steps: int | None = None) -> DataFrame:
    """All columns in order, the given or detected text column replaced by `<name>_parsed`."""
    name = S.resolve_text_column(df.schema, text_column)
    if f"{name}_parsed" in df.columns:
        raise ValueError(f"the input already has a column {name}_parsed")
    parts, done = _parse_columns(df, [name], skip_lists, timeout, steps)
    return parts.select(*[done[name].alias(f"{name}_parsed") if c == name else quoted(c) for c in df.columns])


def clean(df: DataFrame) -> DataFrame | None:
    """Every column ending in _parsed or _paragraphs cleaned in place; without one a warning and None."""
    names = S.clean_columns(df.schema)
    if not names:
        warnings.warn(f"No text columns found (columns ending with _parsed or _paragraphs). Available columns: {df.columns}", stacklevel=2)
        return None
    return df.select(*[X.clean_text(quoted(c)).alias(c) if c in names else quoted(c) for c in df.columns])
