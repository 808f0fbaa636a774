"""python -m loomtext.cli parse|parse-single|clean|run|export|export-single|lookup|quarantine|skipped: the operators from a shell."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators.export import export_single
from .operators.lookup import show_article
from .operators.parse import parse_single
from .plans import files, pipeline
from .sources.tables import read_parquet


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomtext")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *, parse: bool = False):
        c = sub.add_parser(name)
        c.add_argument("-i", "--input", required=True)
        if name in ("parse", "parse-single", "clean", "run"):
            c.add_argument("-o", "--output", required=True)
        if parse:
            c.add_argument("--skip-lists", action="store_true")
            c.add_argument("--timeout", type=int, default=30)
            c.add_argument("--steps", type=int, help="steps a text may take, in place of seconds")
        return c

    command("parse", parse=True).add_argument("--skip-empty", action="store_true")
    command("parse-single", parse=True).add_argument("--text-column")
    command("clean").add_argument("--skip-empty", action="store_true")
    c = command("run", parse=True)
    c.add_argument("--mode", choices=("dual", "single"), default="dual")
    c.add_argument("--text-column")
    c.add_argument("--keep-dirty", action="store_true")
    c.add_argument("--glob", help="names of the files to process")
    c.add_argument("--by-file", action="store_true", help="each file by its own columns; results that are gone are made again")
    c.add_argument("--retry-bad", action="store_true", help="with --by-file: files in quarantine too")
    c = command("export")
    c.add_argument("official_dir", nargs="?", default="data/parsed_export")
    c.add_argument("clone_dir", nargs="?")
    command("export-single").add_argument("folder")
    command("lookup").add_argument("page_id")
    command("quarantine")
    command("skipped")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("loomtext").getOrCreate()
    try:
        if a.command == "parse":
            out = {"rows": pipeline.parse_file(spark, a.input, a.output, a.skip_lists, a.timeout, a.skip_empty, a.steps)}
        elif a.command == "parse-single":
            parse_single(read_parquet(spark, a.input), a.text_column, a.skip_lists, a.timeout, a.steps).write.mode("overwrite").parquet(a.output)
            out = {"output": a.output}
        elif a.command == "clean":
            out = {"rows": pipeline.clean_file(spark, a.input, a.output, a.skip_empty)}
        elif a.command == "run" and a.by_file:
            if a.keep_dirty:
                raise ValueError("--by-file parses and cleans in one plan: there is nothing for --keep-dirty to keep")
            out = files.run_files(spark, a.input, a.output, a.mode, a.text_column, a.skip_lists, a.timeout, a.glob, retry_bad=a.retry_bad, steps=a.steps)
        elif a.command == "run":
            out = pipeline.run(spark, a.input, a.output, a.mode, a.timeout, a.keep_dirty, a.text_column, a.skip_lists, a.glob, a.steps)
        elif a.command == "export-single":
            out = {"files": export_single(read_parquet(spark, a.input), a.folder)}
        elif a.command in ("quarantine", "skipped"):
            rows = files.quarantine(spark, a.input) if a.command == "quarantine" else files.skipped_in(spark, a.input)
            for r in rows.toLocalIterator():
                print(json.dumps(r.asDict(), ensure_ascii=False, default=str))
            return 0
        elif a.command == "export":
            out = {"files": pipeline.run_export(spark, a.input, a.official_dir, a.clone_dir)}
        else:
            out = show_article(read_parquet(spark, a.input), a.page_id)
    except (FileNotFoundError, LookupError, ValueError) as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    print(json.dumps(out, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
