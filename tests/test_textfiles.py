"""The sink of text files: staging, commit, abort, publishing that is taken up again."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.operators.export import export_text
from loomtext.sources import textfiles as T

PAGES = "page_id string, page_title string, official_text_paragraphs string, clone_text_paragraphs string"


def rows(spark, names, parts=4):
    return spark.createDataFrame([(0, n, f"text of {n}\r\n") for n in names], "folder int, name string, content string").repartition(parts)


def found(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names if not f.endswith(".crc"))


def test_write_and_rerun(spark, tmp_path):
    folder = tmp_path / "out ü"
    for path in (str(folder), f"file:{folder}", f"file://{folder}"):
        again = T.write_text_files(rows(spark, [f"{i}.txt" for i in range(50)]), [path])
        assert again == (50 if path == str(folder) else 0)
    assert found(folder) == sorted(f"{i}.txt" for i in range(50)) and not (folder / "_staging").exists()
    assert (folder / "7.txt").read_bytes() == b"text of 7.txt\r\n"
    (folder / "7.txt").write_text("own")
    (folder / "8.txt").unlink()
    assert T.write_text_files(rows(spark, [f"{i}.txt" for i in range(51)]), [str(folder)]) == 2
    assert (folder / "7.txt").read_text() == "own" and (folder / "8.txt").exists()
    assert T.write_text_files(rows(spark, []), [str(folder)]) == 0


@pytest.mark.parametrize("end", ["raise", "kill"])
def test_lost_task_leaves_nothing(spark, tmp_path, end):
    def lost(parts):
        for part in parts:
            yield part.iloc[:5]
            if (part["name"] == "9.txt").any():
                if end == "kill":
                    os._exit(9)
                raise RuntimeError("lost")

    some = rows(spark, [f"{i}.txt" for i in range(40)])
    with pytest.raises(Exception):
        T.write_text_files(some.mapInPandas(lost, some.schema), [str(tmp_path)])
    assert [f for f in found(tmp_path) if not f.startswith("_staging")] == [] and T.unpublished(spark, str(tmp_path)) == []
    assert T.write_text_files(some, [str(tmp_path)]) == 40
    assert len([f for f in found(tmp_path) if not f.startswith("_staging")]) == 40


def test_repeated_attempt_counts_once(spark, tmp_path):
    writer = T.TextFilesWriter([str(tmp_path)], "job")
    (tmp_path / "_staging" / "job").mkdir(parents=True)
    batch = pa.RecordBatch.from_pydict({"folder": [0, 0], "name": ["a", "b"], "content": ["x", "y"]})
    writer.write(iter([batch.slice(0, 1)]))  # an attempt whose message never came
    messages = [writer.write(iter([batch])), None, writer.write(iter([]))]
    assert [f for f in found(tmp_path) if not f.startswith("_staging")] == []
    writer.commit(messages)
    assert T.unpublished(spark, str(tmp_path)) == ["job"]
    os.rename(tmp_path / "_staging" / "job" / messages[0].folders[0] / "a", tmp_path / "a")  # publishing broke off here
    assert T.write_text_files(rows(spark, ["b", "c"]), [str(tmp_path)]) == 2
    assert found(tmp_path) == ["a", "b", "c"] and (tmp_path / "b").read_text() == "y"


def test_names_and_folders(spark, tmp_path):
    for bad in ("../x", "a/b", "", "_staging", ".x", "a\\b"):
        with pytest.raises(Exception, match="unsafe file name"):
            T.write_text_files(rows(spark, ["ok", bad], 1), [str(tmp_path / "n")])
    assert [f for f in found(tmp_path / "n") if not f.startswith("_staging")] == []
    two = spark.createDataFrame([(0, "a", "x"), (1, "a", "y"), (1, "b", "z")], "folder int, name string, content string")
    assert T.write_text_files(two, [str(tmp_path / "p"), f"file:{tmp_path}/q"]) == 3
    assert found(tmp_path / "p") == ["a"] and found(tmp_path / "q") == ["a", "b"]
    assert T.write_text_files(two.where("name = 'b'"), [str(tmp_path / "p")] * 2) == 1


def test_export_of_many_pages(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").cast("string").alias("page_id"), F.lit(None).cast("string").alias("page_title"), F.repeat(F.lit("ж"), 50).alias("official_text_paragraphs"), F.when(F.col("id") % 2 == 0, "c").alias("clone_text_paragraphs"))
    assert df.schema.simpleString() and export_text(df, f"file:{tmp_path}") == 4500 == len(found(tmp_path))
