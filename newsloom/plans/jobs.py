"""The jobs of the pipeline: ingest, process, train, evaluate, classify.

Each takes a session and paths and hands over to the next through files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import model_store
from newsloom.functions.text import clean_text
from newsloom.operators import epochs, metrics, naive_bayes, pipeline
from newsloom.operators.batches import article_count, cap_batch
from newsloom.operators.cleaning import clean_articles, observe_malformed, observe_quality
from newsloom.operators.labels import encode, grow_label_map, label_map, label_names
from newsloom.operators.pipeline import HASH_FEATURES, Candidate, Regression
from newsloom.operators.scoring import Model, above_threshold, classify, evaluate_rows
from newsloom.operators.split import cut_points, label_profile, mark_validation, split_sizes
from newsloom.sources import files
from newsloom.sources.articles import raw_records
from newsloom.staging import new_path, stage

PARTITIONS = ("source", "category")


@dataclass(frozen=True)
class Evaluation:
    """What an evaluation yields; every field but the predictions is small."""

    predictions: DataFrame
    accuracy: DataFrame
    report: DataFrame
    averages: DataFrame
    confusion: DataFrame
    errors: DataFrame
    error_sample: DataFrame


@dataclass(frozen=True)
class Classification:
    """All results, those over the threshold, their count per category, and how many articles there were."""

    results: DataFrame
    confident: DataFrame
    distribution: DataFrame
    found: DataFrame


def ingest(
    spark: SparkSession, articles_path: str, dataset: str, out: str, count: int | None = None, **columns: str
) -> str:
    """A Parquet table of texts and codes to JSON Lines of raw records."""
    articles = files.need(spark.read.parquet, articles_path, "check the path")
    files.write_jsonl(raw_records(articles, dataset, count, **columns), out)
    return out


def process(
    spark: SparkSession,
    raw_path: str,
    out: str,
    partition_by: Sequence[str] = PARTITIONS,
    mode: str = "lenient",
    quarantine: str | None = None,
) -> dict[str, int]:
    """JSON Lines to cleaned Parquet in one pass; returns the quality counts.

    With a folder for them, malformed lines go there as they are, with the name of their file, instead of becoming
    rows of NULLs, and their number is among the counts. Only if there are any is the input read again for them.
    """
    if quarantine is None:
        cleaned, seen = observe_quality(clean_articles(files.read_jsonl(spark, raw_path), mode))
        files.write_parquet(cleaned, out, partition_by)
        return seen.get
    checked, lines = observe_malformed(files.read_jsonl_checked(spark, raw_path))
    cleaned, seen = observe_quality(clean_articles(files.good_records(checked), mode))
    files.write_parquet(cleaned, out, partition_by)
    counts = seen.get | lines.get
    if counts["malformed"]:
        rejected = files.quarantined(files.read_jsonl_checked(spark, raw_path))
        files.write_jsonl(rejected, quarantine)
    return counts


def prepare_split(
    spark: SparkSession, cleaned_path: str, labels: DataFrame, numerator: int = 1, denominator: int = 10, seed: int = 42
) -> DataFrame:
    """Encoded model input with `is_val`; the same rows for the same seed."""
    rows = files.read_model_input(spark, cleaned_path)
    cuts = cut_points(rows, None, numerator, denominator, seed)
    return mark_validation(encode(rows, labels), cuts, seed)


def train(
    spark: SparkSession,
    cleaned_path: str,
    model_dir: str,
    label_map_path: str,
    numerator: int = 1,
    denominator: int = 10,
    seed: int = 42,
    bayes: Sequence[naive_bayes.Candidate] = (naive_bayes.Candidate(),),
    candidates: Sequence[Candidate] = (),
    features: int = HASH_FEATURES,
    schedule: epochs.Schedule | None = None,
    run_dir: str | None = None,
) -> dict[str, float]:
    """Write the label map, the split and the fitted models; returns sizes and accuracies.

    A label map that is there already grows: its categories keep their index. All else is a new version
    under `model_dir`, published when it is whole. The most accurate Bayes candidate goes under `bayes`, at the
    temperature that fits the validation rows; with regression candidates, the best of them goes
    under `pipeline`; with a schedule, the best epoch of a training goes under `epochs`. The best of them, the earlier on
    a tie, is what `load_model` gives by default. The cuts of the split go under `cuts`, so that an evaluation knows the
    validation rows although articles may have been added since. Epochs are published under `run_dir` as
    they end; a job that is started again with the same folder goes on from there.
    """
    rows = files.read_model_input(spark, cleaned_path)
    profile = label_profile(rows, seed)
    fresh = label_map(profile, id_col="first_id")
    if files.exists(spark, label_map_path):
        fresh = grow_label_map(files.read_label_map(spark, label_map_path), fresh)
    labels = stage(fresh, "label-map")
    files.write_label_map(labels, label_map_path)
    summary: dict[str, float] = {}

    def write(path: str) -> None:
        cut_points(rows, profile, numerator, denominator, seed).write.parquet(f"{path}/cuts")
        marked = mark_validation(encode(rows, labels), spark.read.parquet(f"{path}/cuts"), seed)
        sizes = {r.is_val: r.rows for r in split_sizes(marked).collect()}
        training, validation = marked.filter(~F.col("is_val")), marked.filter("is_val")
        chosen = naive_bayes.select_best(training, validation, labels, bayes)
        model = naive_bayes.save(naive_bayes.calibrated(chosen.model, validation), f"{path}/bayes")
        summary.update(
            training=sizes.get(False, 0),
            validation=sizes.get(True, 0),
            accuracy=max(chosen.accuracies),
            temperature=model.temperature,
        )
        found = {"bayes": summary["accuracy"]}
        if candidates:
            choice = pipeline.select_best(training, validation, candidates, features)
            pipeline.save(choice.model, f"{path}/pipeline")
            found["pipeline"] = summary["pipeline_accuracy"] = max(choice.accuracies)
        if schedule:
            run = run_dir or f"{path}/run"
            trained = epochs.train(training, validation, label_names(labels), run, schedule, features)
            epochs.save(trained, f"{path}/epochs")
            found["epochs"] = summary["epochs_accuracy"] = epochs.best_of(epochs.history(spark, run)).accuracy
            summary["epoch"] = trained.epoch
        best = max(found, key=lambda kind: (found[kind], -list(found).index(kind)))
        spark.createDataFrame([(best,)], "kind string").coalesce(1).write.parquet(f"{path}/best")
        files.write_label_map(labels, f"{path}/labels")

    summary["version"] = model_store.save(spark, model_dir, write).number
    return summary


def load_model(spark: SparkSession, model_dir: str, kind: str | None = None) -> Model:
    """The model of a kind, `bayes`, `pipeline` or `epochs`, of the latest version; the best one by default."""

    def load(path: str) -> Model:
        wanted = kind or spark.read.parquet(f"{path}/best").first().kind
        if wanted == "bayes":
            return naive_bayes.load(spark, f"{path}/bayes")
        if wanted == "epochs":
            return epochs.load_saved(spark, f"{path}/epochs")
        names = label_names(files.read_label_map(spark, f"{path}/labels"))
        return Regression(pipeline.load(f"{path}/pipeline"), names)

    return files.need(load, model_store.resolve(spark, model_dir), "run the train job first")


def evaluate(
    spark: SparkSession,
    cleaned_path: str,
    model_dir: str,
    label_map_path: str,
    predictions_out: str | None = None,
    seed: int = 42,
    examples: int = 5,
    kind: str | None = None,
) -> Evaluation:
    """Score the validation rows of the training split once and report on them."""
    labels = files.read_label_map(spark, label_map_path)
    version = model_store.resolve(spark, model_dir)  # model and cuts of one version
    model = load_model(spark, version, kind)
    cuts = spark.read.parquet(f"{version}/cuts")
    rows = mark_validation(encode(files.read_model_input(spark, cleaned_path), labels), cuts, seed)
    predictions = stage(evaluate_rows(rows.filter("is_val"), model), "predictions")
    if predictions_out:
        files.write_csv(predictions, predictions_out)
    return Evaluation(
        predictions=predictions,
        accuracy=metrics.accuracy(predictions),
        report=metrics.class_report(predictions, labels),
        averages=metrics.report_averages(predictions, labels),
        confusion=metrics.confusion_matrix(predictions, labels),
        errors=metrics.error_count(predictions),
        error_sample=metrics.error_sample(predictions, labels, examples),
    )


def classify_articles(
    articles: DataFrame,
    model: Model,
    threshold: float = 0.75,
    most: int | None = None,
    results_out: str | None = None,
) -> Classification:
    """Classify `(id, text)` rows; all results can go to CSV.

    `found` tells how many articles there were and whether `most` left any out.
    """
    total = F.count("*").alias("articles")
    found = article_count(articles, most) if most else articles.agg(total, F.lit(False).alias("over_cap"))
    found = stage(found, "found")
    results = stage(classify(cap_batch(articles, most), model), "results")
    if results_out:
        files.write_csv(files.results_table(results), results_out)
    return Classification(
        results=results,
        confident=above_threshold(results, threshold),
        distribution=metrics.category_distribution(results, threshold),
        found=found,
    )


def classify_file(
    spark: SparkSession,
    path: str,
    model_dir: str,
    threshold: float = 0.75,
    most: int | None = None,
    results_out: str | None = None,
    multi_line: bool = True,
    kind: str | None = None,
) -> Classification:
    """Classify a CSV file with a `text` column or a text file of one article per line.

    With `multi_line` off, fields of a CSV hold no line breaks and one file is read by many tasks.
    """
    if path.endswith(".txt"):
        articles = files.read_txt_articles(spark, path)
    else:
        articles = files.read_csv_articles(spark, path, multi_line)
    return classify_articles(articles, load_model(spark, model_dir, kind), threshold, most, results_out)


def train_on_articles(
    articles: DataFrame, vocabulary_size: int | None = None, most: int | None = None
) -> tuple[DataFrame, DataFrame, naive_bayes.BayesModel]:
    """Label map, split rows and model for raw `(id, text, category)` rows.

    The split needs ids and categories only, so text is cleaned after it and
    each side cleans its own rows.
    """
    labels, marked = split_articles(articles)
    rows = marked.withColumn("cleaned_text", clean_text("text"))
    path = new_path(articles.sparkSession, "bayes")
    return labels, rows, naive_bayes.fit(rows.filter(~F.col("is_val")), labels, path, vocabulary_size, most)


def split_articles(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Label map, and the articles with `label_idx` and `is_val`."""
    articles = articles.filter(F.col("category").isNotNull())
    profile = label_profile(articles)
    labels = stage(label_map(profile, id_col="first_id"), "label-map")
    return labels, mark_validation(encode(articles, labels), cut_points(articles, profile))


__all__ = [
    "Classification", "Evaluation", "classify_articles", "classify_file", "evaluate", "ingest",
    "label_names", "load_model", "prepare_split", "process", "train", "split_articles", "train_on_articles",
]
