"""Files of text under names of their own, on local, mounted and remote file systems: a batch sink that stages, commits, then publishes.

A task writes its files into a folder of its own below `_staging`. The driver's commit writes the list of the folders of
successful tasks; abort deletes them all. What a killed or repeated attempt left is on no list. Publishing moves the listed
files to their places in a distributed job that may run again: a file that has its place already stays, so a run that broke
off between the two is finished by the next one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .tables import hadoop_path

STAGING, COMMITTED = "_staging", "committed.txt"


def resolved(spark: SparkSession, folder: str, make: bool = True) -> str:
    """The folder's full path on the file system that holds it, mounts resolved by Hadoop; made if it is missing."""
    p, fs = hadoop_path(spark, folder)
    p = fs.makeQualified(p)
    if make:
        fs.mkdirs(p)
    return fs.resolvePath(p).toString() if fs.exists(p) else p.toString()


def opened(path: str):
    """(Arrow's file system, path in it) of a full path: file, hdfs (with its native library), s3, gs, abfs."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def safe_name(name: str) -> str:
    if not name or "/" in name or "\\" in name or "\0" in name or ".." in name or name.startswith(("_", ".")):
        raise ValueError(f"unsafe file name: {name!r}")
    return name


def _there(fs, path: str) -> bool:
    from pyarrow.fs import FileType

    return fs.get_file_info(path).type != FileType.NotFound


@dataclass
class Staged(WriterCommitMessage):
    """What a task has staged: for each target folder the name of its own folder there."""

    folders: dict[int, str]


class TextFilesWriter(DataSourceArrowWriter):
    """Rows folder (int, a place in the list of target folders), name, content."""

    def __init__(self, targets: list[str], job: str):
        self.targets, self.job = targets, job

    def write(self, iterator: Iterator) -> Staged:
        own = uuid.uuid4().hex
        at = [opened(t) for t in self.targets]
        used: dict[int, str] = {}
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("folder", "name", "content")]
            for k, name, content in zip(*columns, strict=True):
                k, name = k.as_py(), safe_name(name.as_py())
                fs, root = at[k]
                if _there(fs, f"{root}/{name}"):
                    continue
                staged = f"{root}/{STAGING}/{self.job}/{own}"
                if k not in used:
                    if not _there(fs, f"{root}/{STAGING}/{self.job}"):
                        raise FileNotFoundError("the job has been given up")
                    fs.create_dir(staged)
                    used[k] = own
                with fs.open_output_stream(f"{staged}/{name}") as f:
                    f.write(content.as_py().encode())
        return Staged(used)

    def commit(self, messages: list) -> None:
        for k, target in enumerate(self.targets):
            fs, root = opened(target)
            job = f"{root}/{STAGING}/{self.job}"
            folders = [m.folders[k] for m in messages if m is not None and k in m.folders]
            with fs.open_output_stream(f"{job}/.{COMMITTED}") as f:
                f.write("\n".join(folders).encode())
            fs.move(f"{job}/.{COMMITTED}", f"{job}/{COMMITTED}")

    def abort(self, messages: list) -> None:
        """Tasks that still run find their folder gone and end."""
        for target in self.targets:
            fs, root = opened(target)
            job = f"{root}/{STAGING}/{self.job}"
            if _there(fs, job):
                fs.delete_dir(job)


class TextFiles(DataSource):
    """Options: folders (a JSON list of full paths), job (any name)."""

    @classmethod
    def name(cls) -> str:
        return "loomtext_text_files"

    def writer(self, schema: StructType, overwrite: bool) -> TextFilesWriter:
        return TextFilesWriter(json.loads(self.options["folders"]), self.options["job"])


def _publish(target: str, job: str):
    def move(parts: Iterator) -> Iterator:
        import pandas as pd
        from pyarrow.fs import FileSelector

        fs, root = opened(target)
        for part in parts:
            made = 0
            for own in part["value"]:
                folder = f"{root}/{STAGING}/{job}/{own}"
                for f in fs.get_file_info(FileSelector(folder, allow_not_found=True)):
                    place = f"{root}/{f.base_name}"
                    if _there(fs, place):
                        continue
                    try:
                        fs.move(f.path, place)
                    except FileNotFoundError:  # another attempt was first
                        if not _there(fs, place):
                            raise
                        continue
                    made += 1
            yield pd.DataFrame({"made": [made]})

    return move


def publish(spark: SparkSession, target: str, job: str) -> int:
    """Move a committed job's files below the target folder to their places; returns how many were moved by this call."""
    base = f"{target}/{STAGING}/{job}"
    listed = spark.read.text(f"{base}/{COMMITTED}").where(F.col("value") != "")
    made = listed.repartition(spark.sparkContext.defaultParallelism, "value").mapInPandas(_publish(target, job), "made long").agg(F.coalesce(F.sum("made"), F.lit(0))).first()[0]
    p, fs = hadoop_path(spark, base)
    fs.delete(p, True)
    above = p.getParent()
    if fs.exists(above) and not fs.listStatus(above):
        fs.delete(above, False)
    return made


def unpublished(spark: SparkSession, target: str) -> list[str]:
    """Jobs that were committed below the target folder and never published to the end."""
    p, fs = hadoop_path(spark, f"{target}/{STAGING}/*/{COMMITTED}")
    return sorted(s.getPath().getParent().getName() for s in (fs.globStatus(p) or []))


def write_text_files(rows: DataFrame, folders: list[str]) -> int:
    """Write rows (folder, name, content), with folder a place in `folders`, as files; returns how many new ones there are.

    Names must differ within a folder. A file that is there already stays as it is. Either all files of a call appear, or,
    if the job fails, none; if the driver is lost while they are moved into place, the next call moves the rest.
    Null or unsafe names are an error.
    """
    spark = rows.sparkSession
    targets = [resolved(spark, f) for f in folders]
    spark.dataSource.register(TextFiles)
    made = sum(publish(spark, t, job) for t in dict.fromkeys(targets) for job in unpublished(spark, t))
    job = uuid.uuid4().hex
    distinct = list(dict.fromkeys(targets))
    at = F.get(F.array(*[F.lit(distinct.index(t)) for t in targets]), F.col("folder"))
    out = rows.select(at.cast("int").alias("folder"), "name", "content")
    for t in distinct:
        p, fs = hadoop_path(spark, f"{t}/{STAGING}/{job}")
        fs.mkdirs(p)
    out.write.format(TextFiles.name()).option("folders", json.dumps(distinct)).option("job", job).mode("append").save()
    return made + sum(publish(spark, t, job) for t in distinct)
