"""Text rules after markup parsing, as built-in Spark expressions: Column to Column, no Python at run time.

Patterns follow a regular-expression dialect with Unicode digits and white space, where `.` and `$` know only the line
feed; the spelling below gives Java that meaning ((?d), \\p{Nd}, an explicit white-space class).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
MONTHS = ["января", "февраля", "марта", "апреля", "мая", "июня", "июля", "августа", "сентября", "октября", "ноября", "декабря"]
EMPTY_SECTIONS = ["Население", "Примечания", "Литература", "Ссылки", "Категория", "См. также", "Источники"]
CATEGORY_PREFIX = "Категория:"
WHITE = "[\\t-\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
FILE_LINK = "\\[\\[(?:Файл|File):[^\\]]{0,500}\\]\\]"
IMAGE_LINE = "(?md)^\\p{Nd}+px\\|(?:мини|thumb|миниатюра|left|right|center|слева|справа|центр)\\|.{0,200}$"
FRAGMENTS = [
    f"(?md)^{WHITE}*\\p{{Nd}}+px\\|мини\\|(?:слева|справа|центр)?.{{0,200}}$",
    f"(?md)^{WHITE}*альт=.{{0,100}}\\|мини\\|.{{0,200}}$",
    f"(?md)^{WHITE}*\\p{{Nd}}+px\\|мини$",
]
DATE = "\\{\\{СС3\\|(\\p{Nd}+)\\.%s\\.(\\p{Nd}+)\\}\\}"
YEAR = "\\{\\{год\\|(\\p{Nd}{3,4})\\}\\}"
NUMBER = "\\{\\{num\\|(\\p{Nd}+)\\}\\}"
TEMPLATE = "\\{\\{[^{}]*\\}\\}"
TEMPLATE_TAIL = "\\{\\{[^}]{0,500}\\}\\}"
TEMPLATE_PASSES = 10
#: Month numbers are read as 32-bit unsigned; what is larger counts as 0.
U32 = "4294967295"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _at_most(limit: str) -> str:
    """Pattern of the decimal numbers without leading zeros up to limit."""
    if len(limit) == 1:
        return f"[0-{limit}]"

    def tail(digits: str) -> str:
        if not digits:
            return ""
        rest, low = tail(digits[1:]), int(digits[0]) - 1
        below = f"[0-{low}][0-9]{{{len(digits) - 1}}}|" if low >= 0 else ""
        return f"(?:{below}{digits[0]}{rest})"

    first = int(limit[0])
    below = f"[1-{first - 1}][0-9]{{{len(limit) - 1}}}|" if first > 1 else ""
    return f"0|[1-9][0-9]{{0,{len(limit) - 2}}}|{below}{limit[0]}{tail(limit[1:])}"


def trim(text: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(text, f"\\A{WHITE}+|{WHITE}+\\z", "")


def expand_dates(text: Column) -> Column:
    """{{СС3|day.month.year}}: the month's name, or for other months its number without leading zeros (0 if it is beyond 32 bits or not ASCII)."""
    for i, name in enumerate(MONTHS, 1):
        text = F.regexp_replace(text, DATE % f"0*{i}", f"$1 {name} $2")
    text = F.regexp_replace(text, DATE % f"0*({_at_most(U32)})", "$1.$2.$3")
    return F.regexp_replace(text, DATE % "\\p{Nd}+", "$1.0.$2")


def expand_years(text: Column) -> Column:
    return F.regexp_replace(text, YEAR, "$1")


def expand_numbers(text: Column) -> Column:
    return F.regexp_replace(text, NUMBER, "$1")


def expand_templates(text: Column) -> Column:
    """Dates, years and numbers; the chain runs only for texts with a template left."""
    return let(text, lambda t: F.when(F.contains(t, F.lit("{{")), expand_numbers(expand_years(expand_dates(t)))).otherwise(t))


def drop_file_links(text: Column) -> Column:
    return F.regexp_replace(text, FILE_LINK, "")


def drop_image_lines(text: Column) -> Column:
    """Lines of image parameters go with their line feed; \\r\\n becomes \\n and one last line feed goes."""
    whole = lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, 1, F.size(x) - 1)).otherwise(x)
    return F.array_join(F.filter(let(F.split(text, "\r?\n", -1), whole), lambda x: ~(x.contains("px|") & trim(x).rlike(IMAGE_LINE))), "\n")


def blank_fragments(text: Column) -> Column:
    for pattern in FRAGMENTS:
        text = F.regexp_replace(text, pattern, "")
    return text


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def remove_images(text: Column) -> Column:
    """Image links, lines and fragments that leaked into text. Rules on parameters run only where one may stand."""
    text = let(text, lambda t: F.when(F.contains(t, F.lit("[[")), drop_file_links(t)).otherwise(t))
    return let(drop_image_lines(text), lambda t: F.when(F.contains(t, F.lit("|мини")), blank_fragments(t)).otherwise(t))


def paragraphs(text: Column) -> Column:
    """Array of the trimmed, non-empty parts between empty lines."""
    return F.filter(F.transform(F.split(text, "\n\n", -1), trim), lambda p: p != "")


def is_section(p: Column) -> Column:
    return p.isin(*EMPTY_SECTIONS) | p.startswith(CATEGORY_PREFIX)


def drop_empty_sections(parts: Column) -> Column:
    """A structural heading stays only where the next paragraph is something else; one step ahead, no cascade."""
    return F.filter(parts, lambda p, i: ~is_section(p) | F.coalesce(~is_section(F.get(parts, i + 1)), F.lit(False)))


def join_paragraphs(parts: Column) -> Column:
    return F.array_join(parts, "\n\n")


def remove_templates(text: Column) -> Column:
    """Templates up to TEMPLATE_PASSES deep, then one more kind of remainder, then every brace."""

    def peel(t: Column) -> Column:
        for _ in range(TEMPLATE_PASSES):
            t = F.regexp_replace(t, TEMPLATE, "")
        return F.regexp_replace(t, TEMPLATE_TAIL, "")

    return let(text, lambda t: F.regexp_replace(F.when(F.contains(t, F.lit("{{")), peel(t)).otherwise(t), "[{}]", ""))


def clean_text(text: Column) -> Column:
    """What phase two does to a parsed text; null stays null. Neither trims nor prunes sections again."""
    return collapse_newlines(remove_images(remove_templates(text)))
