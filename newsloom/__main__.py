"""Command line: `python -m newsloom <job>` or `spark-submit ... newsloom/__main__.py <job>`."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import fixed4
from newsloom.operators import naive_bayes
from newsloom.operators.epochs import Schedule
from newsloom.operators.pipeline import HASH_FEATURES, Candidate
from newsloom.operators.scoring import classify_texts
from newsloom.plans import jobs
from newsloom.session import create_spark_session
from newsloom.sources.files import MissingInput
from newsloom.staging import scope


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="newsloom")
    top.add_argument("--master")
    top.add_argument("--memory", help="of driver and executors; by default what spark-submit says")
    todo = top.add_subparsers(dest="job", required=True)

    ingest = todo.add_parser("ingest", help="labelled articles to JSON Lines")
    ingest.add_argument("articles")
    ingest.add_argument("out")
    ingest.add_argument("--dataset", default="ag_news")
    ingest.add_argument("--count", type=int)
    ingest.add_argument("--renumber", action="store_true", help="replace ids by places in id order")

    process = todo.add_parser("process", help="JSON Lines to cleaned Parquet")
    process.add_argument("raw")
    process.add_argument("out")
    process.add_argument("--partition-by", nargs="*", default=list(jobs.PARTITIONS))
    process.add_argument("--quarantine", help="folder for malformed lines")
    process.add_argument("--timestamps", choices=["lenient", "strict"], default="lenient")

    train = todo.add_parser("train", help="label map and model from cleaned Parquet")
    evaluate = todo.add_parser("evaluate", help="report on the validation rows")
    for job in (train, evaluate):
        job.add_argument("cleaned")
        job.add_argument("model")
        job.add_argument("labels")
        job.add_argument("--seed", type=int, default=42)
    train.add_argument("--ratio", default="1/10", help="validation share, as a fraction")
    train.add_argument("--vocabulary", type=int, nargs="*", default=[], help="also fit Bayes on this many words")
    train.add_argument("--smoothing", type=float, nargs="*", default=[1.0], help="counts to add, one Bayes fit per value")
    train.add_argument("--most", type=int, help="read only so many words of each text")
    train.add_argument("--features", type=int, default=HASH_FEATURES, help="cells that a regression hashes words to")
    train.add_argument("--max-iter", type=int, nargs="*", default=[], help="also fit regressions, one per value")
    train.add_argument("--epochs", type=int, help="also train by so many epochs and keep the best one")
    train.add_argument("--batch", type=int, default=Schedule.batch, help="rows of a step in an epoch")
    train.add_argument("--run", help="folder of the epochs; a job started again with it goes on from there")
    evaluate.add_argument("--predictions", help="CSV folder for the predictions")

    classify = todo.add_parser("classify", help="a CSV or TXT file of articles")
    classify.add_argument("file")
    classify.add_argument("model")
    classify.add_argument("--threshold", type=float, default=0.75)
    classify.add_argument("--most", type=int, help="classify the first articles only")
    classify.add_argument("--results", help="CSV folder for all results")
    classify.add_argument("--single-line", action="store_true", help="CSV fields hold no line breaks, which saves a pass")

    texts = todo.add_parser("texts", help="articles given on the command line")
    texts.add_argument("model")
    texts.add_argument("text", nargs="+")
    texts.add_argument("--least", type=int, default=0, help="refuse texts with fewer characters")
    for job in (evaluate, classify, texts):
        job.add_argument("--kind", choices=["bayes", "pipeline", "epochs"], help="by default the best model")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    memory = {side: args.memory for side in ("driver", "executor")} if args.memory else None
    spark = create_spark_session(f"newsloom-{args.job}", args.master, memory)
    try:
        with scope(spark):
            run(spark, args)
    except (MissingInput, ValueError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 1
    return 0


def run(spark, args) -> None:
    if args.job == "ingest":
        print(jobs.ingest(spark, args.articles, args.dataset, args.out, args.count, renumber=args.renumber))
    elif args.job == "process":
        print(jobs.process(spark, args.raw, args.out, args.partition_by, args.timestamps, args.quarantine))
    elif args.job == "train":
        num, den = map(int, args.ratio.split("/"))
        sizes = [None, *args.vocabulary]
        bayes = [naive_bayes.Candidate(added, size, args.most) for size in sizes for added in args.smoothing]
        choices = [Candidate(n) for n in args.max_iter]
        schedule = Schedule(epochs=args.epochs, batch=args.batch) if args.epochs else None
        where, how = (args.cleaned, args.model, args.labels, num, den, args.seed), (bayes, choices, args.features)
        print(jobs.train(spark, *where, *how, schedule, args.run))
    elif args.job == "evaluate":
        found = jobs.evaluate(
            spark, args.cleaned, args.model, args.labels, args.predictions, args.seed, kind=args.kind
        )
        for part in (found.accuracy, found.report, found.averages, found.confusion, found.error_sample):
            show(part)
    elif args.job == "classify":
        found = jobs.classify_file(
            spark, args.file, args.model, args.threshold, args.most, args.results, not args.single_line, args.kind
        )
        total = found.found.first()
        if total.over_cap:
            print(f"warning: {total.articles} articles found, only the first {args.most} are classified", file=sys.stderr)
        show(found.distribution)
    else:
        results = classify_texts(spark, args.text, jobs.load_model(spark, args.model, args.kind), args.least)
        shown = results.select("text", "predicted_category", fixed4(F.col("confidence")).alias("confidence"))
        shown.show(len(args.text), truncate=False)


def show(report: DataFrame) -> None:
    """Print a report in full: its rows are labels, or pairs of labels."""
    report.show(max(1, report.count()), truncate=False)


if __name__ == "__main__":
    sys.exit(main())
