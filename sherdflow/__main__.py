"""Command line: runs over a folder of books (books_dir/<book>/**/data.xml).

    python -m sherdflow run-books --books-dir books
    python -m sherdflow run-book --book NAME [--limit N] [--persist DIR] [--resume]
    python -m sherdflow run-single --book NAME [--write-images DIR]

Prints a JSON object of counts; run-single also a line for each pair.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import reports
from .sources import docbook, images, store


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="sherdflow")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("run-book", "run-books", "run-single"):
        p = commands.add_parser(name)
        p.add_argument("--books-dir", default="books")
        p.add_argument("--limit", type=int)
        p.add_argument("--persist", metavar="DIR", help="add the run's tables to this folder")
        p.add_argument("--resume", action="store_true", help="leave out figures that the tables there have")
        if name != "run-books":
            p.add_argument("--book", required=True)
        if name == "run-single":
            p.add_argument("--write-images", metavar="DIR")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("sherdflow").getOrCreate()
    files = docbook.report_files(spark, args.books_dir)
    if args.command != "run-books":
        files = files.where(F.col("book") == args.book)
        if files.isEmpty():
            raise SystemExit(f"no data.xml in {args.books_dir}/{args.book}")
    elements = docbook.elements(files)
    done = reports.done(spark, args.persist) if args.resume and args.persist else None
    figures = elements.where("tag = 'figure' and has_media").select("book", "fileref")
    families = images.families_of(figures, files, images.images(spark, args.books_dir)) if images.any_images(spark, args.books_dir) else None
    run = (reports.run_single if args.command == "run-single" else reports.run_book)(elements, limit=args.limit, families=families, done=done)
    if args.persist:
        reports.keep(run, args.persist)
    print(json.dumps(json.loads(store.summary(reports.totals(run, files.select("book")))), ensure_ascii=False, indent=2))
    if args.command == "run-single":
        if args.write_images:
            reports.write_images(run, images.contents(spark, args.books_dir, figures, files), args.write_images)
        for row in store.pair_lines(run.pairs, args.write_images or "").toLocalIterator():
            print(row["line"])


if __name__ == "__main__":
    main()
