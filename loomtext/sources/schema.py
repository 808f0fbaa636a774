"""Which columns hold what, decided on the driver by exact, case-sensitive names."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructType

TEXT_NAMES = ("text", "content", "official_text", "clone_text")
ID_NAMES = ("page_id", "pageid")
TITLE_NAMES = ("page_title", "title")
DUAL_NAMES = ("page_id", "page_title", "official_text", "official_timestamp", "clone_page_title", "clone_text", "clone_timestamp")
CLEAN_SUFFIXES = ("_parsed", "_paragraphs")
EXPORT_NAMES = ("page_id", "page_title", "official_text_paragraphs", "clone_text_paragraphs")


def _first(schema: StructType, names: tuple[str, ...]) -> str | None:
    return next((n for n in names if n in schema.names), None)


def detect_text_column(schema: StructType) -> str | None:
    """The first known name present, else the first column whose lower-cased name contains "text"."""
    return _first(schema, TEXT_NAMES) or next((n for n in schema.names if "text" in n.lower()), None)


def detect_id_column(schema: StructType) -> str | None:
    return _first(schema, ID_NAMES)


def detect_title_column(schema: StructType) -> str | None:
    return _first(schema, TITLE_NAMES)


def resolve_text_column(schema: StructType, text_column: str | None = None) -> str:
    """The given or detected text column, checked to be a string."""
    if text_column is not None and text_column not in schema.names:
        raise ValueError(f"Specified text column '{text_column}' not found in schema")
    name = text_column if text_column is not None else detect_text_column(schema)
    if name is None:
        raise ValueError("Could not auto-detect text column. Use --text-column to specify.")
    if not isinstance(schema[name].dataType, StringType):
        raise ValueError("Text column is not a StringArray")
    return name


def check_dual(schema: StructType) -> None:
    for name in DUAL_NAMES:
        if name not in schema.names:
            raise ValueError(f"{name} column not found")
    for name in ("page_id", "page_title", "official_text", "clone_text"):
        if not isinstance(schema[name].dataType, StringType):
            raise ValueError(f"{name} is not a StringArray")


def clean_columns(schema: StructType) -> list[str]:
    """Columns to clean, by suffix; each must be a string."""
    names = [n for n in schema.names if n.endswith(CLEAN_SUFFIXES)]
    for n in names:
        if not isinstance(schema[n].dataType, StringType):
            raise ValueError(f"Column {schema.names.index(n)} is not a StringArray")
    return names


def check_export(schema: StructType) -> None:
    for name in EXPORT_NAMES:
        if name not in schema.names:
            raise ValueError(f"{name} column not found")
        if not isinstance(schema[name].dataType, StringType):
            raise ValueError(f"{name} is not a StringArray")
