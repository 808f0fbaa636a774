"""Files by their own columns, the ledger and the quarantine."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from loomtext import cli
from loomtext.plans.files import ledger, pending, quarantine, results, run_files
from loomtext.sources.footers import footers, listing

WORDS = [f"w{i}" for i in range(400)]


def put(folder, name, **columns):
    pq.write_table(pa.table(columns), folder / name, row_group_size=50)


def texts(spark, out):
    return {tuple(df.columns): sorted(tuple(r) for r in df.drop("file").collect()) for df in results(spark, out).values()}


@pytest.fixture
def folders(tmp_path):
    source = tmp_path / "in put ü"
    source.mkdir()
    put(source, "a.parquet", page_id=["1", "2"], text=["'''a'''", None])
    put(source, "b é.parquet", pageid=[7], content=["[[x|b]] {{t}}"], extra=[1.5])
    put(source, "c.parquet", page_id=["3"], text=["c"])
    return source, str(tmp_path / "out")


def test_columns_of_each_file(spark, folders):
    source, out = folders
    got = run_files(spark, str(source), out)
    assert (got["files_listed"], got["files_done"], got["files_bad"], got["rows"]) == (3, 3, 0, 4)
    assert texts(spark, out) == {("page_id", "text_parsed", "file"): [("1", "a"), ("2", None), ("3", "c")], ("pageid", "content_parsed", "extra", "file"): [(7, "b", 1.5)]}
    assert ledger(spark, out).count() == 3 and quarantine(spark, out).count() == 0
    assert run_files(spark, str(source), out)["files_done"] == 0


def test_redo(spark, folders):
    """A result that is gone and an input that has changed are done again, everything else stays as it is."""
    source, out = folders
    run_files(spark, str(source), out, max_files=2)
    before = {r["path"].rsplit("/", 1)[1]: r for r in ledger(spark, out).collect()}
    folder = lambda name: before[name]["output"].removeprefix("file:")
    stamp = {n: {f: os.stat(os.path.join(folder(n), f)).st_mtime_ns for f in os.listdir(folder(n))} for n in before}
    for f in os.listdir(folder("a.parquet")):
        os.unlink(os.path.join(folder("a.parquet"), f))
    put(source, "b é.parquet", pageid=[8], text=["new columns"])
    put(source, "d.parquet", page_id=["4"], text=["d"])
    assert sorted(r["name"] for r in pending(spark, str(source), out, "*.parquet").collect()) == ["a.parquet", "b é.parquet", "d.parquet"]
    assert run_files(spark, str(source), out)["files_done"] == 3
    assert {f: os.stat(os.path.join(folder("c.parquet"), f)).st_mtime_ns for f in os.listdir(folder("c.parquet"))} == stamp["c.parquet"]
    assert not os.path.exists(folder("b é.parquet"))
    assert texts(spark, out) == {("page_id", "text_parsed", "file"): [("1", "a"), ("2", None), ("3", "c"), ("4", "d")], ("pageid", "text_parsed", "file"): [(8, "new columns")]}
    assert run_files(spark, str(source), out)["files_done"] == 0


def test_quarantine(spark, folders):
    source, out = folders
    (source / "no footer.parquet").write_bytes(b"PAR1 nothing")
    put(source, "torn.parquet", page_id=WORDS, text=[w * 300 for w in WORDS])
    whole = bytearray((source / "torn.parquet").read_bytes())
    whole[len(whole) // 2 : len(whole) // 2 + 3000] = bytes(3000)
    (source / "torn.parquet").write_bytes(whole)
    put(source, "numbers.parquet", text=[1, 2])
    put(source, "none.parquet", body=["x"])
    put(source, "empty.parquet", page_id=pa.array([], pa.string()), text=pa.array([], pa.string()))
    got = run_files(spark, str(source), out)
    assert (got["files_done"], got["files_bad"], got["rows"]) == (4, 4, 4)
    bad = {r["path"].rsplit("/", 1)[1]: r["error"] for r in quarantine(spark, out).collect()}
    assert set(bad) == {"no footer.parquet", "torn.parquet", "numbers.parquet", "none.parquet"}
    assert "of 400 rows" in bad["torn.parquet"] and "StringArray" in bad["numbers.parquet"] and "auto-detect" in bad["none.parquet"]
    assert texts(spark, out)[("page_id", "text_parsed", "file")] == [("1", "a"), ("2", None), ("3", "c")]
    assert run_files(spark, str(source), out)["files_bad"] == 0 == run_files(spark, str(source), out)["files_done"]
    put(source, "none.parquet", text=["mended"])
    assert run_files(spark, str(source), out, retry_bad=True)["files_bad"] == 3
    assert ("text_parsed", "file") in texts(spark, out) and quarantine(spark, out).count() == 3


def test_dual_and_errors(spark, folders, tmp_path):
    source, out = folders
    row = {"page_id": ["1"], "page_title": ["t"], "official_text": ["''a''"], "official_timestamp": [1], "clone_page_title": ["c"], "clone_text": ["b"], "clone_timestamp": [2], "more": [3]}
    put(source, "20251001_x.parquet", **row)
    put(source, "20251001_y.parquet", page_id=["1"])
    assert run_files(spark, str(source), out, mode="dual")["files_bad"] == 1
    (df,) = results(spark, out).values()
    assert df.columns == ["page_id", "page_title", "official_text_paragraphs", "official_timestamp", "clone_page_title", "clone_text_paragraphs", "clone_timestamp", "file"]
    assert "official" in quarantine(spark, out).first()["error"] or "page_title" in quarantine(spark, out).first()["error"]
    with pytest.raises(FileNotFoundError):
        run_files(spark, str(tmp_path / "none"), out)


def test_footers(spark, folders):
    source, _ = folders
    (source / "x.parquet").write_bytes(b"x")
    (source / "empty.parquet").write_bytes(b"")
    got = {r["name"]: (r["n_rows"], r["columns"], r["error"] is None) for r in footers(listing(spark, str(source)), str(source)).collect()}
    assert got == {"a.parquet": (2, "page_id\tstring\ntext\tstring", True), "c.parquet": (1, "page_id\tstring\ntext\tstring", True), "b é.parquet": (1, "pageid\tint64\ncontent\tstring\nextra\tdouble", True), "x.parquet": (None, None, False)}


def test_cli(spark, folders, tmp_path, capsys):
    source, out = folders
    (source / "bad.parquet").write_bytes(b"x")
    run = ["run", "--mode", "single", "-i", str(source), "-o", out, "--by-file", "--steps", "50"]
    assert cli.main(run, spark) == 0 and '"files_bad": 1' in capsys.readouterr().out
    assert cli.main([*run, "--retry-bad"], spark) == 0 and '"files_bad": 1' in capsys.readouterr().out
    assert cli.main([*run, "--keep-dirty"], spark) == 1
    assert cli.main(["quarantine", "-i", out], spark) == 0 and "bad.parquet" in capsys.readouterr().out
    assert cli.main(["skipped", "-i", out], spark) == 0
    (folder,) = [f for f, df in results(spark, out).items() if "text_parsed" in df.columns]
    assert cli.main(["export-single", "-i", f"{out}/parsed/{folder}", str(tmp_path / "e")], spark) == 0
    assert sorted(os.listdir(tmp_path / "e")) == ["1_text_parsed.txt", "3_text_parsed.txt"]
