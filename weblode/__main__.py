"""Command line: ``spark-submit``-able or ``python -m weblode``.

    pack    turn a folder of crawled files into a table of pages
    run     index and rank a crawl
    load    load the results, or packed text files, into a store
    search  look up one word and print JSON
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from weblode.operators.pagerank import ITERATIONS
from weblode.plans import pipeline
from weblode.plans.search import search_json
from weblode.plans.store import read_store
from weblode.functions.limits import resolve_limit
from weblode.sources.crawl import pack_crawl, read_crawl
from weblode.sources.packed import read_packed_postings, read_packed_ranks
from weblode.sources.tables import read_pages


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="weblode", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    pack = commands.add_parser("pack", help="turn a folder of crawled files into a table")
    pack.add_argument("--crawl", required=True)
    pack.add_argument("--out", required=True)

    run = commands.add_parser("run", help="index and rank a crawl")
    pages = run.add_mutually_exclusive_group(required=True)
    pages.add_argument("--crawl", help="folder of crawled files")
    pages.add_argument("--pages", help="parquet table (url, html)")
    run.add_argument("--out", required=True)
    run.add_argument("-i", "--iterations", type=int, default=ITERATIONS)
    run.add_argument("-f", "--filter", nargs="*", default=[], choices=pipeline.JOBS,
                     help="jobs to leave out")
    run.add_argument("--force", action="store_true", help="replace earlier output")

    load = commands.add_parser("load", help="load results into a store")
    load.add_argument("--store", required=True)
    load.add_argument("--source", help="what run wrote")
    load.add_argument("--packed-postings", help="packed text files instead of --source")
    load.add_argument("--packed-ranks", help="packed text files instead of --source")
    load.add_argument("--inv-index", action="store_true")
    load.add_argument("--page-rank", action="store_true")
    load.add_argument("--mode", default="errorifexists",
                      choices=("errorifexists", "overwrite", "append"))

    search = commands.add_parser("search", help="look up one word")
    search.add_argument("--store", required=True)
    search.add_argument("--word")
    search.add_argument("--limit")
    search.add_argument("--out", help="write the JSON there instead of printing it")
    return parser


def _load(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.source:
        flags = {"inv-index": args.inv_index, "page-rank": args.page_rank}
        jobs = [job for job, wanted in flags.items() if wanted]
        pipeline.load_run(spark, args.source, args.store, jobs, args.mode)
        return
    postings = ranks = None
    if args.inv_index:
        postings = read_packed_postings(spark, args.packed_postings)
    if args.page_rank:
        ranks = read_packed_ranks(spark, args.packed_ranks)
    pipeline.load(args.store, postings, ranks, mode=args.mode, check_keys=True)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(arguments)
    if args.command == "load" and not args.source:
        if args.inv_index and not args.packed_postings:
            parser.error("--inv-index needs --source or --packed-postings")
        if args.page_rank and not args.packed_ranks:
            parser.error("--page-rank needs --source or --packed-ranks")
    if args.command == "search" and resolve_limit(args.limit) is None and not args.out:
        parser.error("a search for all pages needs --out")
    spark = SparkSession.builder.appName("weblode").getOrCreate()
    if args.command == "pack":
        pack_crawl(spark, args.crawl, args.out)
    elif args.command == "run":
        pages = read_crawl(spark, args.crawl) if args.crawl else read_pages(spark, args.pages)
        pipeline.run(pages, args.out, args.iterations, args.filter, args.force)
    elif args.command == "load":
        _load(spark, args)
    else:
        found = search_json(read_store(spark, args.store), args.word, args.limit)
        if args.out:
            found.select("json").write.text(args.out)
        else:
            for row in found.toLocalIterator():
                print(row["json"])


if __name__ == "__main__":
    main()
