"""Jobs for ``spark-submit``: load everything, load new files only, or answer one question.

    spark-submit bizlens/jobs.py load   --feeds <folder> --out <folder>
    spark-submit bizlens/jobs.py ingest --feeds <folder> --out <folder> --checkpoints <folder>
    spark-submit bizlens/jobs.py ask top_words --tables <folder> --business <id>

``<feeds>/<feed>`` holds the files of a feed, as JSON lines or (``--format csv``) CSV with a header.
"""

from __future__ import annotations

import argparse
import os
import sys
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from bizlens.operators import quality  # noqa: E402
from bizlens.operators.words import lemma_forms  # noqa: E402
from bizlens.plans import insights, marts  # noqa: E402
from bizlens.schemas import FEED_TABLES, TABLES  # noqa: E402
from bizlens.session import build_session, materialize  # noqa: E402
from bizlens.sources import lookups  # noqa: E402
from bizlens.sources.commits import log, merge_batches  # noqa: E402
from bizlens.sources.records import accepted, quarantine, read_records  # noqa: E402
from bizlens.sources.tables import read_tables, write_table  # noqa: E402
from bizlens.streaming.ingest import ingest_all  # noqa: E402

# Question -> (function, the tables it reads).
QUESTIONS = {
    "average_rating": (insights.average_rating, ["review"]),
    "review_trend": (insights.review_trend, ["review"]),
    "elite_circle_trend": (insights.elite_circle_trend, ["review", "user_elite", "user_friend"]),
    "checkin_trend": (insights.checkin_trend, ["checkin"]),
    "recent_reviews": (insights.recent_reviews, ["review"]),
    "recent_elite_reviews": (insights.recent_elite_reviews, ["review", "user_elite"]),
    "top_words": (insights.top_words, ["review", "review_text"]),
    "category_words": (insights.category_words, ["review", "review_text", "business_category"]),
}


def text_lookups(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame | None]:
    lexicon = lookups.read_lexicon(spark, args.lexicon) if args.lexicon else lookups.seed_lexicon(spark)
    forms = None
    if args.nouns:
        irregular = lookups.read_exceptions(spark, args.exceptions) if args.exceptions else None
        forms = materialize(lemma_forms(lookups.read_nouns(spark, args.nouns), irregular), "forms")
    stop_words = lookups.read_stop_words(spark, args.stop_words) if args.stop_words else None
    return {"lexicon": lexicon, "forms": forms, "stop_words": stop_words}


def load(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Full load of every feed, then the quality report, which is also written next to the tables.

    Row, null, label and length counts are taken while the tables are written; keys and references are then checked over
    the tables, and texts, closed businesses and rejected records over the record store.
    """
    feeds = {name: read_records(spark, name, f"{args.feeds}/{name}", args.format) for name in args.only}
    counters = quality.WriteCounters()
    tables = marts.write_all(feeds, args.out, cluster=args.cluster, counters=counters, **text_lookups(spark, args))
    parts = [counters.report(spark), *further_checks(spark, args.out, tables, args.only)]
    return write_table(reduce(DataFrame.unionByName, parts), f"{args.out}/quality")


def further_checks(spark: SparkSession, root: str, tables: dict[str, DataFrame], feeds: list[str]) -> list[DataFrame]:
    stored = {name: accepted(spark, root, name) for name in feeds}
    reports = [quality.quarantine_counts({name: quarantine(spark, root, name) for name in feeds})]
    texts = {name: df for name, df in stored.items() if "text" in df.columns}
    if any(TABLES[name].key for name in tables):
        reports.append(quality.duplicate_keys(tables))
    if any(parent in tables for name in tables for parent in TABLES[name].parents.values()):
        reports.append(quality.orphans(tables))
    if texts:
        reports.append(quality.missing_text(texts))
    if "business" in stored:
        reports.append(quality.closed_businesses(stored["business"]))
    return reports


def ingest(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Load the files that are new since the last run; the report covers all that was loaded so far."""
    paths = {name: f"{args.feeds}/{name}/*" for name in args.only}
    ingest_all(
        spark, paths, args.out, args.checkpoints, files_per_batch=args.files_per_batch, bytes_per_batch=args.bytes_per_batch,
        file_format=args.format, **text_lookups(spark, args),
    )
    if args.merge:
        for name in args.only:
            merge_batches(spark, args.out, name)
    loaded = {feed for feed, *_ in log(spark, args.out)}
    feeds = [name for name in args.only if name in loaded]
    tables = read_tables(spark, args.out, [t for f in feeds for t in FEED_TABLES[f]])
    if not tables:
        return quality.WriteCounters().report(spark)
    return reduce(DataFrame.unionByName, [quality.table_report(tables), *further_checks(spark, args.out, tables, feeds)])


def ask(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    question, names = QUESTIONS[args.question]
    tables = read_tables(spark, args.tables, names)
    options = {"sentiment": args.sentiment} if args.question == "top_words" else {}
    return question(*tables.values(), business_id=args.business, **options)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(required=True)
    for name, run in (("load", load), ("ingest", ingest)):
        job = jobs.add_parser(name)
        job.set_defaults(run=run)
        job.add_argument("--feeds", required=True)
        job.add_argument("--out", required=True)
        job.add_argument("--only", nargs="+", choices=list(FEED_TABLES), default=list(FEED_TABLES))
        for lookup in ("lexicon", "nouns", "exceptions", "stop-words"):
            job.add_argument(f"--{lookup}")
        job.add_argument("--format", choices=["json", "csv"], default="json")
        if name == "load":
            job.add_argument("--cluster", action="store_true")
        else:
            job.add_argument("--checkpoints", required=True)
            job.add_argument("--files-per-batch", type=int, default=1)
            job.add_argument("--bytes-per-batch", help="such as 100g, instead of a number of files")
            job.add_argument("--merge", action="store_true", help="afterwards make one folder of all batches")
    job = jobs.add_parser("ask")
    job.set_defaults(run=ask)
    job.add_argument("question", choices=list(QUESTIONS))
    job.add_argument("--tables", required=True)
    job.add_argument("--business", required=True)
    job.add_argument("--sentiment", choices=list(quality.LABELS))
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    args = parser().parse_args(arguments)
    result = args.run(spark or build_session(), args)
    result.show(100, truncate=80)
    return result


if __name__ == "__main__":
    main()
