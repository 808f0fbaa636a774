"""The markup parser and the text rules: fixed cases, and rules against a plain Python model."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loomtext.functions import expressions as X
from loomtext.functions.wikitext import SPACE, extract

MARKUP = [
    ("plain text", "plain text"),
    ("a '''b''' c", "a b c"),
    ("a ''b'' c", "a b c"),
    ("a '''''b''''' c", "a b c"),
    ("a ''''b'''' c", "a 'b' c"),
    ("[[Target|shown]] [[Bare]]", "shown Bare"),
    ("x[[A| b ]]y", "xby"),
    ("x[[A|  ]]y", "xy"),
    ("t[[Файл:a.jpg]]u", "tu"),
    ("[[Файл:a.jpg|130px|мини|слева|Подпись]]", "130px|мини|слева|Подпись"),
    ("[[Категория:X]]", "Категория:X"),
    ("[[en:Foo]]", "en:Foo"),
    ("[http://e.org label]", "label"),
    ("[http://e.org http://e.org]", ""),
    ("[not a link]", "[not a link]"),
    ("a\n\n== H ==\n\nb", "a\n\nH\n\nb"),
    ("a\n==  ==\nb", "ab"),
    ("a\n\nb", "a\n\nb"),
    ("a\n \t\nb\nc", "a\n\nb\nc"),
    ("Состав:\n* a\n* b", "Состав:a b"),
    ("# a\n# b", "a b"),
    ("; t\n: d", "t d"),
    ("* a\n** b\n*** c\n* d", "abc d"),
    (" pre\n code", "pre\ncode"),
    ("a<ref>r</ref>b<ref name=x/>c", "abc"),
    ("a<nowiki>[[x]] {{y}}</nowiki>b", "a[[x]] {{y}}b"),
    ("<math>x_{1}</math>", "x_{1}"),
    ("<poem>a '''b'''</poem>", "a b"),
    ("a{{t|x={{u}}}}b", "ab"),
    ("a{{{p|d}}}b", "ab"),
    ("a\n{| class=x\n| c\n{| \n|}\n|}\nb", "a\n\nb"),
    ("[[File:a.jpg|thumb|cap [[x]]]]t", "t"),
    ("[[Category:X]]t", "t"),
    ("<b>x</b>y<br/>z", "xyz"),
    ("<html>x</html>", "<html>x</html>"),
    ("a<!-- c -->b", "ab"),
    ("----", ""),
    ("__TOC__a__none__", "a__none__"),
    ("#REDIRECT [[X]]", ""),
    ("#ПЕРЕНАПРАВЛЕНИЕ [[X]]", "ПЕРЕНАПРАВЛЕНИЕ X"),
    ("10&nbsp;км&amp;&none;", "10км&none;"),
    ("{{unclosed [[x]] y", "{{unclosed x y"),
    ("[[a", "[[a"),
    ("a}} ]] |} </ref>b", "a}} ]] |} b"),
    ("", ""),
]


@pytest.mark.parametrize("text,want", MARKUP)
def test_markup(text, want):
    got = extract(text)
    assert re.sub(r"\n+", "\n\n", got) == want if "{|" in text else got == want


def test_skip_lists():
    assert extract("x\n\n* a\n# b\n; c", True) == "x"


@pytest.mark.parametrize("piece", ["{{", "}}", "[[", "]]", "<ref>", "{|\n", "'", "<!--", "&", "{", "* a\n", "[http://", "=", "\n"])
def test_long_repeats_are_quick(piece):
    extract(piece * 20000)
    extract("{{" * 5000 + piece * 5000 + "}}" * 5000)


def test_extract_is_trimmed_and_total():
    rng = random.Random(0)
    parts = ["{{", "}}", "[[", "]]", "|", "''", "'''", "\n", "\n\n", "==", "* ", "a", "b c", "<ref>", "</ref>", "<nowiki>", "</nowiki>", "&amp;", "{|", "|}", "\U000f0000", "\U000f0001", "0", " ", "\xa0", "[http://x y]", "File:", "Файл:"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        got = extract(text)
        assert got == got.strip(SPACE) or any(x in text for x in ("<nowiki>", "\U000f0000", "\U000f0001", "''"))


CLEAN = [
    ("A {{x}} B", "A  B"),
    ("a{{b{{c{{d}}}}}}e}f", "aef"),
    ("{{" * 12 + "z" + "}}" * 12, ""),
    ("{{unclosed text", "unclosed text"),
    ("{{y{y{y{}}", ""),
    (" {{x}} ", "  "),
    ("t\n\n\n\nu", "t\n\nu"),
    ("a\r\nb\n", "a\nb"),
    (None, None),
    ("", ""),
    ("[[Файл:a.jpg|мини]]t", "t"),
    ("130px|мини|слева|Подпись\nТекст", "Текст"),
    ("Текст\n130px|мини", "Текст\n"),
    ("альт=Герб|мини|Герб города\nТ", "\nТ"),
    ("[Article skipped: parsing timeout after 30 seconds]", "[Article skipped: parsing timeout after 30 seconds]"),
]
DATES = [
    ("{{СС3|18.1.1918}}", "18 января 1918"),
    ("{{СС3|18.01.1918}}", "18 января 1918"),
    ("{{СС3|18.13.1918}}", "18.13.1918"),
    ("{{СС3|18.013.1918}}", "18.13.1918"),
    ("{{СС3|1.0.5}}", "1.0.5"),
    ("{{СС3|1.99999999999.5}}", "1.0.5"),
    ("{{СС3|1.4294967295.5}}", "1.4294967295.5"),
    ("{{СС3|1.4294967296.5}}", "1.0.5"),
    ("{{СС3|1.3294967296.5}}", "1.3294967296.5"),
    ("{{СС3|٣.٣.5}}", "٣.0.5"),
    ("{{год|1999}}", "1999"),
    ("{{год|19}}", "{{год|19}}"),
    ("{{год|19999}}", "{{год|19999}}"),
    ("{{num|42}}", "42"),
    ("{{num|4,2}}", "{{num|4,2}}"),
]
SECTIONS = [
    ("A\n\n  \n\nСсылки\n\nКатегория:Z", "A"),
    ("a\n\n\n\n\nb ", "a\n\nb"),
    ("", ""),
    ("Ссылки\n\nсайт", "Ссылки\n\nсайт"),
    ("Ссылки\n\ntxt\n\nЛитература", "Ссылки\n\ntxt"),
    ("Категория:Z\n\nb", "Категория:Z\n\nb"),
    ("Примечания\n\nЛитература\n\nx", "Литература\n\nx"),
    ("Категория:A\nКатегория:B", ""),
    ("Примечания", ""),
]


@pytest.mark.parametrize(
    "cases,rule",
    [
        (CLEAN, X.clean_text),
        (DATES, X.expand_templates),
        (SECTIONS, lambda c: X.join_paragraphs(X.drop_empty_sections(X.paragraphs(X.remove_images(c))))),
    ],
    ids=["clean", "templates", "sections"],
)
def test_rules(spark, cases, rule):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").select("i", rule(F.col("t")).alias("o")).collect()
    assert {r.i: r.o for r in rows} == {i: o for i, (_, o) in enumerate(cases)}


def model_clean(text):
    """Phase two step by step in Python; digits and white space spelled as Unicode classes."""
    white, digit = f"[{re.escape(SPACE)}]", r"\d"
    for _ in range(10):
        text = re.sub(r"\{\{[^{}]*\}\}", "", text)
    text = re.sub(r"\{\{[^}]{0,500}\}\}", "", text)
    text = re.sub(r"[{}]", "", text)
    text = re.sub(r"\[\[(?:Файл|File):[^\]]{0,500}\]\]", "", text)
    lines = [x.removesuffix("\r") if k < text.count("\n") else x for k, x in enumerate(text.split("\n"))]
    if lines[-1] == "":
        lines.pop()
    image = re.compile(rf"{digit}+px\|(?:мини|thumb|миниатюра|left|right|center|слева|справа|центр)\|[^\n]{{0,200}}\Z")
    text = "\n".join(x for x in lines if not image.match(x.strip(SPACE)))
    for p in (rf"{digit}+px\|мини\|(?:слева|справа|центр)?[^\n]{{0,200}}", r"альт=[^\n]{0,100}\|мини\|[^\n]{0,200}", rf"{digit}+px\|мини"):
        text = re.sub(rf"(?m)^{white}*{p}(?=\n|\Z)", "", text)
    return re.sub(r"\n{3,}", "\n\n", text)


def test_clean_against_model(spark):
    rng = random.Random(7)
    parts = ["{{", "}}", "{", "}", "[[Файл:", "]]", "12px|", "٣px|", "мини", "|", "слева", "альт=", "thumb|", "\n", "\r\n", "\r", "\n\n\n", " ", "\xa0", " ", " ", "текст", "x" * 90]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.clean_text(F.col("t")).alias("o")).collect()
    for r in rows:
        assert r.o == model_clean(texts[r.i]), texts[r.i]
        assert "{" not in r.o and "\n\n\n" not in r.o


def test_whole_document_texts(spark, tmp_path):
    import __spark_entry__

    rng = random.Random(9)
    parts = ["[[", "]]", "[", "|", "''", "'''", "<b>", "<", "&amp;", "==", "* ", "# ", "12px|мини|", "\n", "\n\n", "\r\n", " ", "слово", "word", "😀", "字", "Ссылки", "http://e.org "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(300)] + ["", None, "long words here " * 7000, "{{a|b}} c"]
    spark.createDataFrame([(i, t, "en", "web") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    headings = ("Население", "Примечания", "Литература", "Ссылки", "Категория", "См. также", "Источники")
    section = lambda p: p in headings or p.startswith("Категория:")

    def model(text):
        raw = extract("{{Карточка|имя=web}}\n'''en''' — [[Бренд|web]].<ref>r</ref>\n\n== Сюжет ==\n\n" + text + "\n* a\n* b\n\n[[Категория:X]]")
        ps = [p for p in (x.strip(SPACE) for x in model_clean(raw).split("\n\n")) if p]
        ps = [p for i, p in enumerate(ps) if not section(p) or i + 1 < len(ps) and not section(ps[i + 1])]
        return model_clean("\n\n".join(ps))

    got = {r.doc_id: r.body_text_parsed for r in __spark_entry__.queries()["parse_document_texts"](spark, str(tmp_path)).collect()}
    assert got == {i: None if t is None else model(t) for i, t in enumerate(texts)}
    assert len(got[302]) > 100_000
