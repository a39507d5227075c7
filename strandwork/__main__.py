"""Command line: ``python -m strandwork <command> --store FOLDER …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import pipeline
from .plans.store import Store
from .plans.vocabulary import LOADS
from .session import local_session, ship
from .sources.landed import HUMAN_CODE, VETERINARY_CODE, code_list, read_pages
from .sources.tables import write_table


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strandwork", description=__doc__)
    parser.add_argument("--master", help="Spark master; without it a running session, or local[*]")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, about: str) -> argparse.ArgumentParser:
        one = commands.add_parser(name, help=about)
        one.add_argument("--store", required=True, help="folder of the tables")
        one.add_argument("--dry-run", action="store_true", help="work everything out, write nothing")
        return one

    load = command("ingest", "load FASTA files and their side files")
    for source in ("resfinder", "card", "ncbi"):
        load.add_argument(f"--{source}", help="FASTA file or pattern")
    load.add_argument("--card-index"), load.add_argument("--ncbi-report"), load.add_argument("--phenotypes")
    load.add_argument("--skip-links", action="store_true")
    load.add_argument("--vocabulary", help="folder of the vocabulary files; loaded as well")
    words = command("vocabulary", "load the vocabulary files and build the links anew")
    words.add_argument("--vocabulary", required=True)
    command("proteins", "translate sequences and cluster them by protein")
    command("links", "build the links of sequences anew")
    command("validate", "show broken constraints")
    out = command("export", "write a query over a stored table as tab-separated text")
    out.add_argument("--table", required=True), out.add_argument("--output", "-o", required=True), out.add_argument("--null", choices=("NULL", "empty"), default="NULL")
    codes = commands.add_parser("codes", help="read a code list from landed pages")
    codes.add_argument("codes", nargs="+"), codes.add_argument("--pages", required=True), codes.add_argument("--output", "-o", required=True)
    codes.add_argument("--veterinary", action="store_true")
    return parser


def _vocabulary(folder: str) -> dict[str, str]:
    return {name: f"{folder.rstrip('/')}/{name}.tsv" for name in LOADS}


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or (SparkSession.builder.master(args.master).getOrCreate() if args.master else local_session("*"))
    ship(spark)
    if args.command == "codes":
        seeds = spark.createDataFrame([(c,) for c in args.codes], "id string")
        found = code_list(read_pages(spark, args.pages), seeds, VETERINARY_CODE if args.veterinary else HUMAN_CODE)
        write_table(found, args.output, found.columns)
        return
    store = Store(spark, args.store, args.dry_run)
    with store.transaction():
        if args.command == "ingest":
            fasta = {s.upper(): getattr(args, s) for s in ("resfinder", "card", "ncbi") if getattr(args, s)}
            pipeline.store_ingest(store, pipeline.ingest(spark, fasta, args.card_index, args.ncbi_report, args.phenotypes))
        if args.command == "vocabulary" or args.command == "ingest" and args.vocabulary:
            pipeline.load_vocabulary(store, _vocabulary(args.vocabulary), links=not getattr(args, "skip_links", False))
        if args.command == "proteins":
            pipeline.store_proteins(store)
        if args.command == "links":
            pipeline.store_links(store)
    if args.command == "validate":
        pipeline.validate(store).show(100, False)
    elif args.command == "export":
        pipeline.export(store.read(args.table), args.output, "gene" if args.null == "NULL" else "protein")
    else:
        pipeline.run_summary(store).show(100, False)


if __name__ == "__main__":
    main()
