"""The jobs: refine, train, export and predict, for all tasks of a family."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import tags as tag_fn
from textmill.operators import classify, clean, features, neardup, report, sampling, tagging
from textmill.operators.ledger import KeyLedger
from textmill.runtime import materialize
from textmill.sources import artifacts, records
from textmill.spec import JobSpec, TaskSpec

STEPS = ("ingest", "refine", "train", "export")


@dataclass(frozen=True)
class Refined:
    """Cleaned records, their report, the train/test split and how many rows each stage removed."""

    cleaned: DataFrame
    report: DataFrame
    split: DataFrame
    removed: DataFrame


def refine(raw: DataFrame, spec: JobSpec, near_duplicates: bool = False) -> Refined | None:
    """Dedupe, clean, report, balance and split all tasks of `raw` in one plan.

    Near duplicates are only removed on request, and within one task: the plain job
    drops exact copies; `removed` counts these and invalid rows, not near ones. Returns None if nothing is left after cleaning.
    """
    key = _dedupe_key(spec)
    # Stored, as the counts of removed rows come from it too.
    first = materialize(clean.first_rows(raw, key, by=["task"]), "first")
    unique = clean.dedupe_exact(raw, key, by=["task"], first=first)
    cleaned = clean.clean_tagged(unique) if spec.is_tagging else clean.clean_classified(unique, spec.tasks)
    # Read by the report, the class counts and every step of the split.
    cleaned = materialize(cleaned, "cleaned")
    if cleaned.isEmpty():
        return None
    removed = clean.removed_counts(first, cleaned)
    if near_duplicates:
        cleaned = materialize(_without_near_duplicates(cleaned, spec), "distinct")
    return Refined(cleaned, _report(cleaned, spec), balance_and_split(cleaned, spec), removed)


def _dedupe_key(spec: JobSpec) -> Column:
    return tag_fn.dedupe_key(F.col("tokens")) if spec.is_tagging else F.col("text")


def refine_batch(raw: DataFrame, spec: JobSpec, ledger: KeyLedger, batch: int) -> DataFrame:
    """Cleaned records of one batch without those that it or an earlier batch already brought.

    Batches in the order of their records give what `refine` cleans from all of them at once.
    """
    key = _dedupe_key(spec)
    # A missing text is a key of its own within its task.
    in_task = F.concat(F.coalesce("task", F.lit("")), F.lit("\n"), F.coalesce(F.sha2(key, 256), F.lit("")))
    fresh = ledger.admit(raw, in_task, batch)
    return clean.clean_tagged(fresh) if spec.is_tagging else clean.clean_classified(fresh, spec.tasks)


def _without_near_duplicates(df: DataFrame, spec: JobSpec) -> DataFrame:
    kept = []
    for task in spec.tasks:
        rows = df.filter(F.col("task") == task.name)
        text = F.concat_ws("", "tokens") if spec.is_tagging else F.col("text")
        survivors = neardup.dedupe_near(
            rows.select("ord", text.alias("text")), spec.near_dup_threshold, spec.num_perm
        )
        kept.append(rows.join(survivors.select("ord"), "ord", "left_semi").select(*df.columns))
    out = kept[0]
    for rows in kept[1:]:
        out = out.unionByName(rows)
    return out


def _report(cleaned: DataFrame, spec: JobSpec) -> DataFrame:
    if spec.is_tagging:
        return report.quality_report_tags(cleaned).withColumn("task", F.lit(spec.tasks[0].name))
    return report.quality_report(cleaned)


def balance_and_split(cleaned: DataFrame, spec: JobSpec) -> DataFrame:
    """Tagged data is split at random; classes are balanced, then split by class."""
    if spec.is_tagging:
        return sampling.split_random(cleaned, spec.test_share, f"{spec.seed}:split")
    balanced = sampling.undersample(cleaned, f"{spec.seed}:balance")
    sampling.check_splittable(sampling.balanced_counts(cleaned, ("task",)), spec.test_share, ("task",))
    # The balanced table is a filter of `cleaned`; its class counts feed the quotas.
    return sampling.split_stratified(balanced, spec.test_share, f"{spec.seed}:split")


def train_text_task(train: DataFrame, test: DataFrame):
    """(vocabulary, model, scored test rows) of one classification task."""
    vocab = materialize(features.fit_vocabulary(train), "vocabulary")
    width = vocab.count()
    rows = {
        name: features.assemble(docs, features.tfidf_transform(docs, vocab), width)
        for name, docs in (("train", train), ("test", test))
    }
    few = classify.partitions_for(rows["train"])
    model = classify.train_classifier(rows["train"].select("label", "features"), partitions=few)
    return vocab, model, classify.score(rows["test"], model)


def train_tagging_task(train: DataFrame, test: DataFrame, task: TaskSpec):
    """(token ids, emissions, transitions, tagged test rows) of one tagging task."""
    tokens = tagging.token_index(train)
    emissions = materialize(tagging.tag_emissions(train, task.tag_map), "emissions")
    transitions = materialize(tagging.tag_transitions(train, task.tag_map), "transitions")
    tagged = tagging.tag_viterbi(test, emissions, transitions, task.tag_map)
    return tokens, emissions, transitions, tagged


def predict_texts(docs: DataFrame, models_dir: str, task: TaskSpec, side: str = "serve") -> DataFrame:
    """Batch prediction with the exported vocabulary, with features as served or as fitted (`side`)."""
    if side not in ("serve", "fit"):
        raise ValueError(f"unknown side: {side}")
    spark = docs.sparkSession
    vocab = artifacts.read_tfidf_artifact(spark, f"{models_dir}/{task.name}/preprocessor")
    model = artifacts.load_model(f"{models_dir}/{task.name}/model")
    weights = features.tfidf_serve(docs, vocab) if side == "serve" else features.tfidf_transform(docs, vocab)
    return classify.score(features.assemble(docs, weights, vocab.count()), model)


def predict_tags(docs: DataFrame, models_dir: str, task: TaskSpec) -> DataFrame:
    """Greedy tags for the characters of each text."""
    from textmill.functions.text import chars

    spark = docs.sparkSession
    emissions = spark.read.parquet(f"{models_dir}/{task.name}/emissions")
    return tagging.tag_greedy(
        docs.withColumn("tokens", chars(F.col("text"))), emissions, task.tag_map
    )


def _raw(spark: SparkSession, spec: JobSpec, root: str) -> DataFrame | None:
    """Good records of every task whose file exists; rejects go to `rejects/`."""
    found = None
    for task in spec.tasks:
        df = records.skip_if_missing(
            lambda t=task: records.read_records(spark, f"{root}/raw/{t.name}", t, has_ord=False)
        )
        if df is None:
            continue
        good, bad = records.split_rejects(df)
        # Replaced as a whole, so that another run does not add the same lines again.
        bad.write.mode("overwrite").json(f"{root}/rejects/{task.name}")
        found = good if found is None else found.unionByName(good)
    return found


def run(
    spark: SparkSession,
    spec: JobSpec,
    root: str,
    steps: Sequence[str] = STEPS,
    date: str | None = None,
) -> dict[str, object]:
    """Run the chosen steps in their fixed order under the folder `root`.

    Layout: `payloads/<task>`, `raw/<task>`, `processed`, `reports`, `models/<task>`.
    A task without input is skipped and reported as such. Reports bear `date`, today's if not given.
    """
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    done: dict[str, object] = {}
    if "ingest" in steps:
        done["ingest"] = _ingest(spark, spec, root)
    if "refine" in steps:
        done["refine"] = _refine(spark, spec, root, date or datetime.date.today().isoformat())
    if "train" in steps:
        done["train"] = {t.name: _train(spark, spec, t, root) for t in spec.tasks}
    if "export" in steps:
        done["export"] = {t.name: _export(spark, t, root) for t in spec.tasks}
    return done


def _ingest(spark: SparkSession, spec: JobSpec, root: str) -> dict[str, str]:
    from textmill.streaming.ingest import ingest_stream

    state = {}
    for task in spec.tasks:
        source = f"{root}/payloads/{task.name}"
        if records.skip_if_missing(lambda s=source: spark.read.text(s)) is None:
            state[task.name] = "skipped"
            continue
        ingest_stream(
            spark,
            source,
            f"{root}/raw/{task.name}",
            f"{root}/checkpoints/{task.name}",
            task.expected_keys,
            records.record_schema(task),
            fmt="json",
        )
        state[task.name] = "done"
    return state


def _refine(spark: SparkSession, spec: JobSpec, root: str, date: str) -> str:
    raw = _raw(spark, spec, root)
    result = None if raw is None else refine(raw, spec)
    if result is None:
        return "skipped"
    records.write_records(result.split, f"{root}/processed", compression="gzip")
    # One row per task.
    result.removed.coalesce(1).write.mode("overwrite").json(f"{root}/reports/removed_{date}")
    for task in spec.tasks:
        rows = result.report.filter(F.col("task") == task.name).drop("task")
        artifacts.write_report(rows, task.name, f"{root}/reports", date)
    return "done"


def _split(spark: SparkSession, task: TaskSpec, root: str, split: str) -> DataFrame | None:
    schema = f"ord bigint, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in records.record_schema(task))}"
    path = f"{root}/processed/task={task.name}/split={split}"
    return records.skip_if_missing(lambda: spark.read.schema(schema).json(path))


def _train(spark: SparkSession, spec: JobSpec, task: TaskSpec, root: str) -> DataFrame | str:
    train, test = (_split(spark, task, root, s) for s in ("train", "test"))
    if train is None or test is None:
        return "skipped"
    home = f"{root}/models/{task.name}"
    if spec.is_tagging:
        tokens, emissions, transitions, tagged = train_tagging_task(train, test, task)
        tokens.write.mode("overwrite").parquet(f"{home}/tokens")
        emissions.write.mode("overwrite").parquet(f"{home}/emissions")
        transitions.write.mode("overwrite").parquet(f"{home}/transitions")
        return tagging.entity_report(tagged)
    vocab, model, scored = train_text_task(train, test)
    vocab.write.mode("overwrite").parquet(f"{home}/vocabulary")
    artifacts.save_model(model, f"{home}/model")
    return classify.classification_report(classify.confusion(scored))


def _export(spark: SparkSession, task: TaskSpec, root: str) -> str:
    home = f"{root}/models/{task.name}"
    source = f"{home}/tokens" if task.is_tagging else f"{home}/vocabulary"
    table = records.skip_if_missing(lambda: spark.read.parquet(source))
    if table is None:
        return "skipped"
    if task.is_tagging:
        artifacts.write_index_artifact(table, task.tag_map, f"{home}/preprocessor")
    else:
        artifacts.write_tfidf_artifact(table, f"{home}/preprocessor")
    return "done"
