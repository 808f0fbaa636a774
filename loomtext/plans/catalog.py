"""The registered queries of the engine, with equivalent SQL.

The tables hold no wiki markup, so queries build it from their columns in SQL that both engines read alike. Where
markup is parsed, the equivalent SQL builds the expected text from the same columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.udf import extract_udf, skipped
from ..operators.export import export_rows, export_text
from ..operators.lookup import lookup_article
from ..operators.parse import clean, parse_dual, parse_single, parse_wikitext
from ..streaming.incremental import pending_files
from . import file_queries, run_queries
from .pipeline import parse_then_clean
from .shared import read, shared_folder

NL, NL2 = "chr(10)", "chr(10) || chr(10)"


def _run(n: int) -> str:
    """A run of n apostrophes."""
    return f"repeat(chr(39), {n})"


#: name: (table, key, markup, expected text) for the markup parser.
EXTRACT = {
    "extract_text": ("part", "p_partkey", "p_name || ' ' || p_type", "p_name || ' ' || p_type"),
    "extract_bold": ("part", "p_partkey", "'a ''''''' || p_name || ''''''' b'", "'a ' || p_name || ' b'"),
    "extract_italic": ("part", "p_partkey", "'a ''''' || p_name || ''''' b'", "'a ' || p_name || ' b'"),
    "extract_bold_italic": ("part", "p_partkey", "'a ''''''''''' || p_name || ''''''''''' b'", "'a ' || p_name || ' b'"),
    "extract_quotes": ("part", "p_partkey", f"'a ' || {_run(4)} || p_name || {_run(4)} || ' b ' || {_run(6)} || p_type || {_run(8)} || ' c'", f"'a ' || {_run(1)} || p_name || {_run(1)} || ' b ' || {_run(1)} || p_type || {_run(3)} || ' c'"),
    "extract_quotes_balanced": ("part", "p_partkey", f"{_run(2)} || p_name || {_run(3)} || ' d' || {NL2} || 'x l' || {_run(3)} || p_type || {_run(2)} || ' e' || {NL2} || {_run(2)} || 'x ' || {_run(3)} || p_brand", f"p_name || {_run(1)} || ' d' || {NL2} || 'x l' || {_run(1)} || p_type || ' e' || {NL2} || 'x ' || {_run(1)} || p_brand"),
    "extract_link": ("part", "p_partkey", "'see [[' || p_brand || 'x|' || p_name || ']] and x[[A| b ]]y [[' || p_type || ']]'", "'see ' || p_name || ' and xby ' || p_type"),
    "extract_file_link": ("part", "p_partkey", "'t[[Файл:' || p_partkey || '.jpg]]u ' || p_name", "'tu ' || p_name"),
    "extract_ext_link": ("part", "p_partkey", "'[http://e.org/' || p_partkey || ' ' || p_name || '] [http://e.org http://e.org]z'", "p_name || ' z'"),
    "extract_heading": ("part", "p_partkey", f"'a' || {NL2} || '== ' || p_name || ' ==' || {NL} || p_type", f"'a' || {NL2} || p_name || {NL2} || p_type"),
    "extract_paragraphs": ("part", "p_partkey", f"p_name || {NL2} || chr(10) || ' ' || {NL} || p_type || {NL} || 'c'", f"p_name || {NL2} || p_type || {NL} || 'c'"),
    "extract_ul": ("part", "p_partkey", f"'List:' || {NL} || '* ' || p_name || {NL} || '* ' || p_type || {NL} || '** c'", "'List:' || p_name || ' ' || p_type || 'c'"),
    "extract_ol": ("part", "p_partkey", f"'# ' || p_name || {NL} || '# ' || p_type", "p_name || ' ' || p_type"),
    "extract_dl": ("part", "p_partkey", f"'; ' || p_name || {NL} || ': ' || p_type", "p_name || ' ' || p_type"),
    "extract_pre": ("part", "p_partkey", f"' ' || p_name || {NL} || ' ' || p_type", f"p_name || {NL} || p_type"),
    "extract_ref": ("part", "p_partkey", "p_name || '<ref name=x>' || p_type || '</ref>, <ref name=x/>z'", "p_name || ', z'"),
    "extract_tag": ("part", "p_partkey", "p_name || '<nowiki>[[' || p_type || ']]</nowiki><poem>p</poem>'", "p_name || '[[' || p_type || ']]p'"),
    "extract_template": ("part", "p_partkey", "p_name || '{{t|x={{' || p_type || '}}}}!'", "p_name || '!'"),
    "extract_table": ("part", "p_partkey", f"p_name || {NL2} || '{{| class=x' || {NL} || '| ' || p_type || {NL} || '|}}' || {NL2} || 'end'", f"p_name || {NL2} || 'end'"),
    "extract_image": ("part", "p_partkey", "'[[File:a.jpg|thumb|' || p_type || ']]' || p_name", "p_name"),
    "extract_category": ("part", "p_partkey", "'[[Category:' || p_type || ']]' || p_name", "p_name"),
    "extract_category_ru": ("part", "p_partkey", f"p_name || {NL2} || '[[Категория:' || p_type || ']]'", f"p_name || {NL2} || 'Категория:' || p_type"),
    "extract_html_tags": ("part", "p_partkey", "'<b>' || p_name || '</b><br/>' || p_type", "p_name || p_type"),
    "extract_comment": ("part", "p_partkey", "p_name || '<!-- ' || p_type || ' -->!'", "p_name || '!'"),
    "extract_hr": ("nation", "n_nationkey", f"n_name || {NL2} || '----' || {NL2} || 'b'", f"n_name || {NL2} || 'b'"),
    "extract_magic": ("nation", "n_nationkey", "'__TOC__' || n_name", "n_name"),
    "extract_redirect": ("nation", "n_nationkey", f"'#REDIRECT [[' || n_name || ']]' || {NL2} || n_name", "n_name"),
    "extract_param": ("nation", "n_nationkey", "n_name || '{{{p|' || n_nationkey || '}}}!'", "n_name || '!'"),
    "extract_entity": ("customer", "c_custkey", "c_name || '&nbsp;' || c_mktsegment || '&#33;&none;'", "c_name || c_mktsegment || '&none;'"),
    "extract_unclosed": ("customer", "c_custkey", "'{{a ' || c_name || ' [[b'", "'{{a ' || c_name || ' [[b'"),
    "extract_null": ("customer", "c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE c_name END", "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE c_name END"),
}

_TEMPLATES = "p_name || ' {{a|' || p_brand || '{{b|{{c}}}}}} ' || p_type || '{{open ' || p_size || ' {x}'"
_DEEP = "p_name || '" + "{{" * 12 + "' || p_brand || '" + "}}" * 11 + "' || p_type || '}}'"
_FILES = "p_name || '[[Файл:' || p_partkey || '.jpg|мини]]' || p_type || '[[File:b' || chr(10) || 'c]]'"
_LINES = f"p_size || 'px|мини|слева|' || p_name || {NL} || p_name || chr(13) || {NL} || '  12px|thumb|' || p_type || {NL} || p_size || 'px|other|x' || {NL}"
_FRAGMENTS = f"'Т' || {NL} || p_size || 'px|мини' || {NL} || 'альт=' || p_name || '|мини|' || p_type || {NL2} || p_name || {NL} || '5px|мини|слева' || repeat('ы', 203)"
_NEWLINES = f"p_name || repeat({NL}, p_size % 5) || p_type"

#: name: (table, key, text) for phase two.
CLEAN = {
    "clean_nested_templates": ("part", "p_partkey", _TEMPLATES),
    "clean_deep_templates": ("part", "p_partkey", _DEEP),
    "clean_file_links": ("part", "p_partkey", _FILES),
    "clean_image_lines": ("part", "p_partkey", _LINES),
    "clean_image_fragments": ("part", "p_partkey", _FRAGMENTS),
    "clean_newlines": ("part", "p_partkey", _NEWLINES),
    "clean_null_passthrough": ("events", "event_id", "CASE WHEN event_id % 2 = 0 THEN props END"),
    "clean_documents": ("documents", "doc_id", "text"),
    "clean_pages_html": ("pages", "page_id", "html"),
}

_DATE = "'x {{СС3|' || (1 + o_orderkey % 28) || '.' || (o_orderkey % 15) || '.' || (1900 + o_orderkey % 99) || '}} y {{СС3|01.0' || (1 + o_orderkey % 9) || '.5}}{{СС3|1.99999999999.5}}'"
_YEAR = "'{{год|' || (o_orderkey % 3000) || '}} {{год|1999}}{{год|19999}}'"
_NUMBER = "'{{num|' || o_orderkey || '}} {{num|4,2}}'"
_SECTIONS = f"'A' || {NL2} || 'Ссылки' || {NL2} || CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN 'Категория:' || p_brand ELSE 'Литература' || {NL2} || '  ' END || {NL2} || 'См. также'"


def _built(spark: SparkSession, sf_dir: str, table: str, key: str, text: str) -> DataFrame:
    return read(spark, sf_dir, table).select(F.col(key).alias("id"), F.expr(text).alias("source_text"))


def _extract(spark: SparkSession, sf_dir: str, *, table: str, key: str, text: str, skip_lists: bool = False) -> DataFrame:
    """Markup trees alone, without the rules that follow."""
    return _built(spark, sf_dir, table, key, text).select("id", extract_udf(skip_lists, 30)(F.col("source_text")).alias("text"))


def _apply(spark: SparkSession, sf_dir: str, *, table: str, key: str, text: str, rule: Callable[[Column], Column]) -> DataFrame:
    return _built(spark, sf_dir, table, key, text).select("id", rule(F.col("source_text")).alias("text"))


def _dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = read(spark, sf_dir, "part"), read(spark, sf_dir, "supplier")
    return part.join(supplier, F.expr("p_partkey = s_suppkey"), "left").select(
        F.expr("CAST(p_partkey AS string)").alias("page_id"),
        F.col("p_name").alias("page_title"),
        F.expr("'{{Card|name=' || p_name || '}}''''''' || p_name || ''''''' — [[' || p_partkey || '|' || p_type || ']].' || chr(10) || chr(10) || '== Примечания ==' || chr(10) || '[[Категория:X]]'").alias("official_text"),
        F.lit(7).cast("long").alias("official_timestamp"),
        F.col("s_name").alias("clone_page_title"),
        F.expr("'<ref>x</ref>' || s_name || ' {{год|1999'").alias("clone_text"),
        F.col("p_size").alias("clone_timestamp"),
        F.lit("extra").alias("extra"),
    )


_DUAL_OFFICIAL = "p_name || ' — ' || p_type || '.'"
_DUAL_FROM = "FROM part LEFT JOIN supplier ON p_partkey = s_suppkey"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse and clean the two versions of every page in one plan."""
    return parse_then_clean(_dual(spark, sf_dir))


def _parse_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_dual(_dual(spark, sf_dir))


def _single_rows(spark: SparkSession, sf_dir: str, names: tuple[str, str, str]) -> DataFrame:
    page, title, text = names
    return read(spark, sf_dir, "part").select(
        F.expr("CAST(p_partkey AS string)").alias(page), F.col("p_name").alias(title), F.expr("'''''''' || p_name || ''''''' [[x|' || p_type || ']]' || chr(10) || '* ' || p_brand").alias(text), F.col("p_size").alias("timestamp")
    )


def _parse_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_single(_single_rows(spark, sf_dir, ("page_id", "page_title", "text")))


def _parse_ruwiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_single(_single_rows(spark, sf_dir, ("pageid", "title", "content")))


def _detected(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    """No text column is named: the first known name, else the first that contains "text", is found and parsed; the others stay."""
    return parse_single(read(spark, sf_dir, "orders").select("o_orderkey", *[F.expr(f"'[[{i}|' || o_orderpriority || ']]'").alias(n) for i, n in enumerate(names)]))


def _no_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both phases over no rows: the columns of the result, without rows."""
    return parse_then_clean(_single_rows(spark, sf_dir, ("page_id", "page_title", "text")).where("false"), "single")


def _export_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files of two exports into one folder, by a path of Hadoop's, hold; the second finds all of them and writes none."""
    folder = shared_folder(spark) + "/export-" + uuid.uuid4().hex
    df = read(spark, sf_dir, "supplier").select(F.expr("CAST(s_suppkey AS string)").alias("page_id"), F.col("s_name").alias("page_title"), F.expr("s_name || chr(10) || 'o'").alias("official_text_paragraphs"), F.expr("CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'c' END").alias("clone_text_paragraphs"))
    texts = ("official_text_paragraphs", "clone_text_paragraphs")
    written = [export_text(df.select("page_id", "page_title", *[F.concat(c, F.lit(again)).alias(c) for c in texts]), folder) for again in ("", " again")]
    files = spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), F.col("value").alias("content"))
    return files.select("name", "content", F.lit(written[1]).cast("long").alias("written_again"))


def _skip_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_single(_single_rows(spark, sf_dir, ("page_id", "page_title", "text")), skip_lists=True)


def _clean_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "nation").select("n_nationkey", F.expr("n_name || '{{x}}'").alias("a_parsed"), F.expr("n_name || '{x'").alias("b_paragraphs"), F.expr("n_name || '{x'").alias("c"))
    return clean(df)


def _paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    text = F.array_join(F.transform("t", lambda t: F.concat(F.lit(" "), t["text"], F.lit("\t"))), "\n\n\n\n")
    parts = X.paragraphs(text)
    return turns.select("conv_id", F.size(parts).cast("long").alias("n"), X.join_paragraphs(parts).alias("text"))


def _documents_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text, unparsed inside a tag, through all rules of both phases; parse_document_texts parses them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.expr("'<nowiki>' || text || '</nowiki>'").alias("body_text"))
    return clean(parse_single(docs, text_column="body_text"))


#: A whole text inside an article of markup.
ARTICLE = (
    "concat('{{Карточка|имя=', source, '}}', chr(10), \"'''\", lang, \"''' — [[Бренд|\", source, ']].<ref>r</ref>', chr(10), chr(10), '== Сюжет ==', chr(10), text, chr(10), '* a', chr(10), '* b', chr(10), chr(10), '[[Категория:X]]')"
)


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text, in markup, through both phases."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.expr(ARTICLE).alias("body_text"))
    return parse_then_clean(docs, "single", "body_text")


def _timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def never(text: str) -> str:
        while text.startswith("E"):
            pass
        if text.startswith("A"):
            raise RuntimeError(text)
        return text

    run = extract_udf(timeout=1, work=never)
    return read(spark, sf_dir, "region").select("r_regionkey", X.clean_text(run(F.col("r_name"))).alias("text"))


def _export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").select(
        F.expr("CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_partkey AS string) END").alias("page_id"),
        F.expr("CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END").alias("page_title"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END").alias("official_text_paragraphs"),
        F.col("p_brand").alias("clone_text_paragraphs"),
    )
    again = df.select("page_id", F.lit("second").alias("page_title"), F.lit("o2").alias("official_text_paragraphs"), F.lit("c2").alias("clone_text_paragraphs"))
    return export_rows(df.union(again)).select("name", "content")


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_article(read(spark, sf_dir, "documents"), 7, "doc_id", ("text", "lang"))


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = read(spark, sf_dir, "region").select(F.col("r_name").alias("name"))
    return pending_files(listed.where("name < 'B'"), listed)


def _parse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_wikitext(_built(spark, sf_dir, "part", "p_partkey", EXTRACT["extract_link"][2]), {"source_text": "parsed"}).select("id", "parsed")


RULES: dict[str, tuple[str, str, str, Callable[[Column], Column]]] = {
    "expand_dates": ("orders", "o_orderkey", _DATE, X.expand_dates),
    "expand_year": ("orders", "o_orderkey", _YEAR, X.expand_years),
    "expand_num": ("orders", "o_orderkey", _NUMBER, X.expand_numbers),
    "empty_sections": ("part", "p_partkey", _SECTIONS, lambda c: X.join_paragraphs(X.drop_empty_sections(X.paragraphs(c)))),
    "file_links": ("part", "p_partkey", _FILES, X.drop_file_links),
    "image_lines": ("part", "p_partkey", _LINES, X.drop_image_lines),
    "image_fragments": ("part", "p_partkey", _FRAGMENTS, X.blank_fragments),
    "collapse_newlines": ("part", "p_partkey", _NEWLINES, X.collapse_newlines),
    "unicode_trim": ("part", "p_partkey", "'\u2003' || chr(9) || p_name || '\u00a0' || chr(10) || '\u2028'", X.trim),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {"parse_then_clean": flagship}
    for name, (table, key, text, _) in EXTRACT.items():
        out[name] = partial(_extract, table=table, key=key, text=text)
    for name, (table, key, text) in CLEAN.items():
        out[name] = partial(_apply, table=table, key=key, text=text, rule=X.clean_text)
    for name, (table, key, text, rule) in RULES.items():
        out[name] = partial(_apply, table=table, key=key, text=text, rule=rule)
    return out | file_queries.queries() | run_queries.queries() | {
        "parse_dual": _parse_dual,
        "parse_single": _parse_single,
        "parse_ruwiki": _parse_ruwiki,
        "parse_detected_known": partial(_detected, names=("TEXT", "content", "text_too")),
        "parse_detected_contains": partial(_detected, names=("body", "Body_Text", "mytext")),
        "parse_no_rows": _no_rows,
        "export_files": _export_files,
        "parse_columns": _parse_columns,
        "skip_lists": _skip_lists,
        "clean_suffixes": _clean_suffixes,
        "paragraph_split": _paragraph_split,
        "parse_documents": _documents_plain,
        "timeout_placeholder": _timeouts,
        "export_rows": _export_rows,
        "lookup_article": _lookup,
        "resume_pending_files": _pending,
    }


def queries_without_sql() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Raw texts hold what the markup grammar reads, which SQL can't express; tests compare with plain Python."""
    return {"parse_document_texts": document_texts}


# The same in SQL


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _gone(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {_q(pattern)}, {_q(to)}, 'g')"


def _re2(pattern: str) -> str:
    return pattern.replace("(?md)", "(?m)")


def _sql_trim(x: str) -> str:
    return _gone(x, f"\\A{X.WHITE}+|{X.WHITE}+\\z")


def _sql_lines(x: str) -> str:
    lines = f"string_split(replace({x}, chr(13) || chr(10), chr(10)), chr(10))"
    lines = f"(CASE WHEN {x} LIKE '%' || chr(10) OR {x} = '' THEN list_slice({lines}, 1, len({lines}) - 1) ELSE {lines} END)"
    return f"(CASE WHEN {x} IS NOT NULL THEN coalesce(array_to_string(list_filter({lines}, lambda l: NOT regexp_matches({_sql_trim('l')}, {_q(_re2(X.IMAGE_LINE))})), chr(10)), '') END)"


def _sql_fragments(x: str) -> str:
    for p in X.FRAGMENTS:
        x = _gone(x, _re2(p))
    return x


def _sql_steps(source: str, table: str, key: str, steps: list[Callable[[str], str]]) -> str:
    """A chain of subqueries, so that no step repeats the text of the one before."""
    out = f"SELECT {key} AS id, {source} AS t FROM {table}"
    for step in steps:
        out = f"SELECT id, {step('t')} AS t FROM ({out})"
    return f"SELECT id, t AS text FROM ({out})"


def _peel(x: str) -> str:
    for _ in range(X.TEMPLATE_PASSES):
        x = _gone(x, X.TEMPLATE)
    return x


_COLLAPSE: list[Callable[[str], str]] = [lambda x: f"regexp_replace({x}, chr(10) || '{{3,}}', chr(10) || chr(10), 'g')"]
_IMAGES: list[Callable[[str], str]] = [lambda x: _gone(x, X.FILE_LINK), _sql_lines, _sql_fragments]
_CLEAN: list[Callable[[str], str]] = [_peel, lambda x: _gone(x, X.TEMPLATE_TAIL), lambda x: f"translate({x}, '{{}}', '')", *_IMAGES, *_COLLAPSE]


def _sql_sections(x: str) -> str:
    parts = f"list_filter(list_transform(string_split({x}, chr(10) || chr(10)), lambda s: {_sql_trim('s')}), lambda s: s <> '')"
    names = ", ".join(_q(n) for n in X.EMPTY_SECTIONS)
    section = lambda s: f"({s} IN ({names}) OR starts_with({s}, {_q(X.CATEGORY_PREFIX)}))"
    kept = f"list_filter(ps, lambda s, i: NOT {section('s')} OR (i < len(ps) AND NOT {section('ps[i + 1]')}))"
    return f"(SELECT coalesce(array_to_string({kept}, chr(10) || chr(10)), '') FROM (SELECT {parts} AS ps))"


def oracle_sql() -> dict[str, str]:
    out = {name: f"SELECT {key} AS id, {want} AS text FROM {table}" for name, (table, key, _, want) in EXTRACT.items()}
    for name, (table, key, text) in CLEAN.items():
        out[name] = _sql_steps(text, table, key, _CLEAN)
    months = " ".join(f"WHEN {i} THEN {_q(m)}" for i, m in enumerate(X.MONTHS, 1))
    day, month, year = "(1 + o_orderkey % 28)", "(o_orderkey % 15)", "(1900 + o_orderkey % 99)"
    other = f"CASE WHEN {month} BETWEEN 1 AND 12 THEN {day} || ' ' || (CASE {month} {months} END) || ' ' || {year} ELSE {day} || '.' || {month} || '.' || {year} END"
    out["expand_dates"] = f"SELECT o_orderkey AS id, 'x ' || ({other}) || ' y 01 ' || (CASE (1 + o_orderkey % 9) {months} END) || ' 5' || '1.0.5' AS text FROM orders"
    out["expand_year"] = "SELECT o_orderkey AS id, (CASE WHEN o_orderkey % 3000 >= 100 THEN (o_orderkey % 3000) || '' ELSE '{{год|' || (o_orderkey % 3000) || '}}' END) || ' 1999{{год|19999}}' AS text FROM orders"
    out["expand_num"] = "SELECT o_orderkey AS id, o_orderkey || ' {{num|4,2}}' AS text FROM orders"
    out["empty_sections"] = f"SELECT p_partkey AS id, {_sql_sections('t')} AS text FROM (SELECT p_partkey, {_SECTIONS} AS t FROM part)"
    out["file_links"] = _sql_steps(_FILES, "part", "p_partkey", _IMAGES[:1])
    out["image_lines"] = _sql_steps(_LINES, "part", "p_partkey", _IMAGES[1:2])
    out["image_fragments"] = _sql_steps(_FRAGMENTS, "part", "p_partkey", _IMAGES[2:])
    out["collapse_newlines"] = _sql_steps(_NEWLINES, "part", "p_partkey", _COLLAPSE)
    out["unicode_trim"] = "SELECT p_partkey AS id, p_name AS text FROM part"
    dual = f"SELECT CAST(p_partkey AS VARCHAR) AS page_id, p_name AS page_title, {_DUAL_OFFICIAL} AS official_text_paragraphs, CAST(7 AS BIGINT) AS official_timestamp, s_name AS clone_page_title, s_name || ' %s' AS clone_text_paragraphs, p_size AS clone_timestamp {_DUAL_FROM}"
    out["parse_dual"] = dual % "{{год|1999"
    out["parse_then_clean"] = dual % "год|1999"
    one = "SELECT CAST(p_partkey AS VARCHAR) AS %s, p_name AS %s, p_name || ' ' || p_type%s AS %s, p_size AS timestamp FROM part"
    out["parse_single"] = one % ("page_id", "page_title", " || p_brand", "text_parsed")
    out["parse_ruwiki"] = one % ("pageid", "title", " || p_brand", "content_parsed")
    out["skip_lists"] = one % ("page_id", "page_title", "", "text_parsed")
    out["parse_columns"] = f"SELECT p_partkey AS id, {EXTRACT['extract_link'][3]} AS parsed FROM part"
    out["clean_suffixes"] = "SELECT n_nationkey, n_name AS a_parsed, n_name || 'x' AS b_paragraphs, n_name || '{x' AS c FROM nation"
    raw = "'[[{0}|' || o_orderpriority || ']]' AS {1}"
    out["parse_detected_known"] = f"SELECT o_orderkey, {raw.format(0, 'TEXT')}, o_orderpriority AS content_parsed, {raw.format(2, 'text_too')} FROM orders"
    out["parse_detected_contains"] = f"SELECT o_orderkey, {raw.format(0, 'body')}, o_orderpriority AS Body_Text_parsed, {raw.format(2, 'mytext')} FROM orders"
    out["parse_no_rows"] = out["parse_single"] + " WHERE false"
    out["paragraph_split"] = "SELECT conv_id, sum(n)::BIGINT AS n, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM (SELECT conv_id, turn, len(ps) AS n, array_to_string(ps, chr(10) || chr(10)) AS text FROM (SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda s: " + _sql_trim("s") + "), lambda s: s <> '') AS ps FROM conversations) WHERE len(ps) > 0) GROUP BY conv_id"
    steps = _sql_steps("text", "documents", "doc_id", [_sql_trim, *_IMAGES, *_COLLAPSE, _sql_sections, *_CLEAN])
    out["parse_documents"] = f"SELECT id AS doc_id, text AS body_text_parsed FROM ({steps})"
    out["timeout_placeholder"] = f"SELECT r_regionkey, CASE WHEN r_name LIKE 'E%' OR r_name LIKE 'A%' THEN {_q(skipped(1))} ELSE r_name END AS text FROM region"
    side = "SELECT page_id || '_{0}.txt' AS name, 'Page ID: ' || page_id || chr(10) || 'Title: ' || coalesce(title, 'untitled') || chr(10) || repeat('=', 60) || chr(10) || chr(10) || text AS content FROM (SELECT CAST(p_partkey AS VARCHAR) AS page_id, {1} AS title, {2} AS text FROM part WHERE p_partkey % 10 <> 0)"
    name = "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END"
    out["export_rows"] = side.format("official", f"CASE WHEN p_partkey % 3 = 0 THEN 'second' ELSE {name} END", "CASE WHEN p_partkey % 3 = 0 THEN 'o2' ELSE p_type END") + " UNION ALL " + side.format("clone", name, "p_brand")
    file = "SELECT s_suppkey || '_{0}.txt' AS name, 'Page ID: ' || s_suppkey || chr(10) || 'Title: ' || s_name || chr(10) || repeat('=', 60) || chr(10) || chr(10) || {1} AS content, CAST(0 AS BIGINT) AS written_again FROM supplier"
    out["export_files"] = file.format("official", "s_name || chr(10) || 'o'") + " UNION ALL " + file.format("clone", "'c'") + " WHERE s_suppkey % 3 <> 0"
    shown = lambda t: f"length(coalesce({t}, 'None')) AS {t}_length, substr(coalesce({t}, 'None'), 1, 5000) AS {t}_preview, length(coalesce({t}, 'None')) > 5000 AS {t}_truncated"
    out["lookup_article"] = f"SELECT doc_id, {shown('text')}, {shown('lang')} FROM documents WHERE doc_id = 7 LIMIT 1"
    out["resume_pending_files"] = "SELECT r_name AS name FROM region WHERE NOT r_name < 'B'"
    return out | file_queries.oracle_sql() | run_queries.oracle_sql()
