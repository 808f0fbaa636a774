"""Row groups skipped by Bloom filters, order of exported pages, quotes."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomtext.functions.wikitext import extract
from loomtext.operators.export import export_rows
from loomtext.operators.lookup import indexed, lookup_article, rows_read
from loomtext.plans import pipeline


def test_one_row_group_of_many(spark, tmp_path):
    df = spark.range(20_000, numPartitions=1).select(F.sha2(F.col("id").cast("string"), 256).alias("page_id"), F.repeat(F.lit("text "), 20).alias("official_text"), F.sha2((F.col("id") + 7).cast("string"), 256).alias("clone_text"))
    indexed(df.write, "page_id", group_bytes=1 << 18).parquet(str(tmp_path / "with"))
    df.write.option("parquet.block.size", 1 << 18).parquet(str(tmp_path / "without"))
    wanted = df.where("id = 12345").first()["page_id"] if "id" in df.columns else spark.sql("SELECT sha2('12345', 256)").first()[0]
    (file,) = (tmp_path / "with").glob("*.parquet")
    groups = [pq.ParquetFile(file).metadata.row_group(i).num_rows for i in range(pq.ParquetFile(file).metadata.num_row_groups)]
    assert len(groups) >= 10
    found = lookup_article(spark.read.parquet(str(tmp_path / "with")), wanted)
    assert found.first()["official_text_length"] == 100
    scan = lambda name, page: rows_read(spark.read.parquet(str(tmp_path / name)).where(F.col("page_id") == page))
    assert scan("with", wanted) in groups and scan("with", "nobody") <= max(groups) and scan("without", wanted) == 20_000


def test_parse_file_is_indexed(spark, tmp_path):
    row = {"page_id": ["1"], "page_title": ["t"], "official_text": ["a"], "official_timestamp": [1], "clone_page_title": ["c"], "clone_text": ["b"], "clone_timestamp": [2]}
    pq.write_table(pa.table(row), tmp_path / "x.parquet")
    pipeline.parse_file(spark, str(tmp_path / "x.parquet"), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.parquet")
    column = pq.ParquetFile(file).metadata.row_group(0).column(0)
    assert column.path_in_schema == "page_id" and rows_read(spark.read.parquet(str(tmp_path / "out")).where("page_id = '10'")) == 0


def test_first_by_file_then_row(spark, tmp_path):
    """The larger file is read first by Spark, but comes second by name."""

    def put(name, rows):
        pq.write_table(pa.table({"page_id": [r[0] for r in rows], "page_title": [r[1] for r in rows], "official_text_paragraphs": [r[2] for r in rows], "clone_text_paragraphs": [r[3] for r in rows]}), tmp_path / name)

    put("a.parquet", [("1", "first", "a", None), ("1", "second", "b", "c")])
    put("b.parquet", [("1", "third", "d", "e")] + [(str(i), "t", "x" * 300, None) for i in range(2, 3000)])
    got = {(r["side"], r["page_id"]): r["content"].rsplit("\n", 1)[1] + r["content"].split("\n")[1] for r in export_rows(spark.read.parquet(str(tmp_path)).where("page_id = '1'")).collect()}
    assert got == {("official", "1"): "aTitle: first", ("clone", "1"): "cTitle: second"}
    assert export_rows(spark.createDataFrame([("1", "t", "x", None)], "page_id string, page_title string, official_text_paragraphs string, clone_text_paragraphs string")).count() == 1


@pytest.mark.parametrize(
    "text,want",
    [
        ("''a'' '''b''' '''''c'''''", "a b c"),
        ("''''a''''", "'a'"),
        ("''''''a''''''", "'a'"),
        ("''''''''a'''''", "'''a"),
        ("'a' it's", "'a' it's"),
        ("''a", "a"),
        ("'''a", "a"),
        ("''a'''b", "a'b"),  # one italic and one bold turn: the bold one was an apostrophe and an italic one
        ("'''''a''b", "ab"),  # bold is odd alone
        ("'''''a", "'a"[1:]),
        ("l'''x y'' z", "l'x y z"),
        ("of a'''b cd'''e '''f ''g", "of a'b cde f g"),
        ("ab'''c d''", "ab'c d"),
        ("''x '''y", "x 'y"),
        ("ab '''c d'''e f '''g ''h", "ab c d'e f g h"),  # a word comes before a blank
        ("''a\n'''b", "a\nb"),  # each line by itself
        ("'''a\n\nb'''", "a\n\nb"),
        ("[[x|''b'''c]]", "b'c"),
        ("a '''{{t}}b'' c", "a 'b c"),
        ("* ''a'''b\n* c", "a'b c"),
        (" ''a'''b\n c'''", "a'b\nc"),
    ],
)
def test_quotes(text, want):
    assert extract(text) == want
