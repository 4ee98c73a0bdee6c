"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import tags as tag_fn
from textmill.functions import text as text_fn
from textmill.functions.payload import has_keys
from textmill.operators import (
    classify,
    clean,
    crf,
    diversity as diversity_op,
    features,
    ingest,
    neardup,
    report,
    routing,
    rules as rule_op,
    sampling,
    tagging,
    topk,
)
from textmill.operators.indexing import global_index
from textmill.operators.ledger import KeyLedger
from textmill.plans import jobs, views
from textmill.runtime import materialize, new_path
from textmill.sources.records import TEXT_RECORD, load_table
from textmill.spec import CLASSIFICATION, CONFIRMATION, ENTITIES, MAX_FEATURES, QUESTION, TAGGING
from textmill.streaming import ingest as streams
from textmill.streaming import outcomes as outcome_streams

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SEED_BALANCE = f"{CLASSIFICATION.seed}:balance"
SEED_SPLIT = f"{CLASSIFICATION.seed}:split"
SEED_SAMPLE = f"{CLASSIFICATION.seed}:sample"
SAMPLE_SIZE = CLASSIFICATION.diversity_sample
# Routing rules, first match wins.
RULES = (
    (r"(?i)^(the|le|die|el|que)\b", "Statement"),
    (r"\?\s*$", "Question"),
)
ROUTE_THRESHOLD = 0.75
PIVOT_CHARS = 300
#: Letters of a word that becomes a routing rule.
RULE_CHARS = 8
LEDGER_BUCKETS = 8
FILES_PER_EPOCH = 4


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _r(column, name: str):
    return F.round(column.cast("double") if not isinstance(column, str) else F.col(column).cast("double"), 6).alias(name)


def _joined_md5(array, name: str):
    return F.md5(F.array_join(array, ",")).alias(name)


# ---------------------------------------------------------------- classification records


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.classified(spark, sf_dir)
    return clean.clean_classified(
        clean.dedupe_exact(raw, F.col("text"), by=["task"]), CLASSIFICATION.tasks
    )


def _balanced_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced and split records of both tasks; stored, since features read it often."""
    cleaned = materialize(_cleaned(spark, sf_dir), "cleaned")
    return materialize(jobs.balance_and_split(cleaned, CLASSIFICATION), "split")


def _vocabulary(train: DataFrame) -> DataFrame:
    return materialize(features.fit_vocabulary(train), "vocabulary")


@query
def label_distribution(spark, sf_dir):
    return report.label_counts(_cleaned(spark, sf_dir))


@query
def stage_removed_counts(spark, sf_dir):
    return clean.stage_counts(views.classified(spark, sf_dir), CLASSIFICATION.tasks)


@query
def normalized_text(spark, sf_dir):
    norm = text_fn.normalize_text(F.col("text"))
    return views.documents(spark, sf_dir).select(
        "ord", F.md5(norm).alias("text_md5"), F.length(norm).cast("bigint").alias("n_chars")
    )


@query
def dedupe_exact(spark, sf_dir):
    kept = clean.dedupe_exact(views.documents(spark, sf_dir), F.col("text"))
    return kept.select("ord", F.md5("text").alias("text_md5"))


@query
def quality_report(spark, sf_dir):
    return report.quality_report(_cleaned(spark, sf_dir))


@query
def class_weights(spark, sf_dir):
    return report.class_weights(_cleaned(spark, sf_dir)).select(
        "task", "label", "rows", "min_rows", _r("weight", "weight")
    )


@query
def contracts_text(spark, sf_dir):
    checks = report.contracts_text(views.classified(spark, sf_dir), script="Latin")
    return checks.withColumn("value", F.round("value", 6))


@query
def undersample(spark, sf_dir):
    cleaned = materialize(_cleaned(spark, sf_dir), "cleaned")
    return sampling.undersample(cleaned, SEED_BALANCE).select("task", "ord", "label")


@query
def split_stratified(spark, sf_dir):
    return _balanced_split(spark, sf_dir).select("task", "ord", "label", "split")


@query
def sample_n(spark, sf_dir):
    return sampling.sample_n(views.documents(spark, sf_dir), SAMPLE_SIZE, SEED_SAMPLE).select("ord")


@query
def report_from_labels(spark, sf_dir):
    """Toxicity as a prediction of poor quality, over all labelled documents."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id")
    pairs = docs.join(load_table(spark, sf_dir, "labels"), "doc_id").select(
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label"),
        F.when(F.col("toxic") == 0, "good").otherwise("poor").alias("predicted"),
    )
    return _rounded_report(classify.classification_report(classify.confusion(pairs)))


def _rounded_report(df: DataFrame) -> DataFrame:
    return df.select(
        "class", *[_r(c, c) for c in ("precision", "recall", "f1")], F.col("support").cast("bigint").alias("support")
    )


# -------------------------------------------------------------------------------- ingest


@query
def payload_items(spark, sf_dir):
    records = ingest.accepted_records(
        views.payloads(spark, sf_dir), CONFIRMATION.expected_keys, TEXT_RECORD
    )
    return records.select(
        "batch", F.col("pos").cast("bigint").alias("pos"), F.md5("text").alias("text_md5"), "label"
    )


@query
def payload_outcomes(spark, sf_dir):
    return ingest.batch_outcomes(views.payloads(spark, sf_dir), CONFIRMATION.expected_keys)


@query
def event_props_valid(spark, sf_dir):
    valid = has_keys(F.col("props"), ("k",))
    return (
        load_table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.count("*").alias("rows"), F.count_if(valid).alias("valid"))
    )


def _quota(spark, sf_dir) -> DataFrame:
    """Open requests per source: what exact dedupe left counts as stored."""
    docs = load_table(spark, sf_dir, "documents").select(
        F.col("source").alias("task"), F.col("doc_id").alias("ord"), "text"
    )
    stored = clean.dedupe_exact(docs, F.col("text"))
    return ingest.quota(
        stored,
        docs.select("task").distinct(),
        CLASSIFICATION.target_records,
        CLASSIFICATION.records_per_request,
    )


@query
def quota_plan(spark, sf_dir):
    return _quota(spark, sf_dir)


@query
def quota_requests(spark, sf_dir):
    return ingest.expand_requests(_quota(spark, sf_dir))


def _write_payload_files(spark, sf_dir) -> str:
    source = new_path(spark, "payloads")
    views.payloads(spark, sf_dir).write.json(source)
    return source


@query
def ingest_stream(spark, sf_dir):
    source, sink, checkpoint = (
        _write_payload_files(spark, sf_dir),
        new_path(spark, "ingested"),
        new_path(spark, "ingest-state"),
    )
    for _ in range(2):  # the second run finds nothing new
        streams.ingest_stream(
            spark, source, sink, checkpoint, CONFIRMATION.expected_keys, TEXT_RECORD
        )
    return spark.read.parquet(sink).select(
        "batch", F.col("pos").cast("bigint").alias("pos"), F.md5("text").alias("text_md5"), "label"
    )


def _outcomes_stream(spark, sf_dir) -> str:
    """All payload files through the stream, several epochs; the second run finds nothing new."""
    source, root, checkpoint = _write_payload_files(spark, sf_dir), new_path(spark, "sinks"), new_path(spark, "outcome-state")
    for _ in range(2):
        outcome_streams.ingest_outcomes_stream(
            spark, source, root, checkpoint, CONFIRMATION.expected_keys, TEXT_RECORD, FILES_PER_EPOCH
        )
    return root


@query
def outcomes_stream(spark, sf_dir):
    """What became of each response, as the stream stored it."""
    stored = spark.read.parquet(f"{_outcomes_stream(spark, sf_dir)}/outcomes")
    return stored.select("batch", "outcome", "accepted")


@query
def rejects_stream(spark, sf_dir):
    """Rejected items of all responses, and responses that were rejected whole, as the stream stored them."""
    stored = spark.read.parquet(f"{_outcomes_stream(spark, sf_dir)}/rejects")
    return stored.select("batch", "pos", "reason")


@query
def dedupe_stream(spark, sf_dir):
    source, sink, checkpoint = (
        new_path(spark, "records"),
        new_path(spark, "unique"),
        new_path(spark, "dedupe-state"),
    )
    docs = views.documents(spark, sf_dir).select("text")
    docs.write.parquet(source)
    streams.dedupe_stream(spark, source, sink, checkpoint, docs.schema)
    return spark.read.parquet(sink).select(F.md5("text").alias("text_md5"))


# ----------------------------------------------------------------------- tagged sentences


def _tagged_clean(spark, sf_dir) -> DataFrame:
    raw = views.tagged(spark, sf_dir)
    return clean.clean_tagged(clean.dedupe_tagged(raw, by=["task"]))


def _tagged_split(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all, train, test) cleaned sentences; stored once, the split is a filter on it."""
    cleaned = materialize(_tagged_clean(spark, sf_dir), "tagged")
    split = jobs.balance_and_split(cleaned, TAGGING)
    return split, *(split.filter(F.col("split") == s).drop("split") for s in ("train", "test"))


@query
def dedupe_tagged(spark, sf_dir):
    kept = clean.dedupe_tagged(views.tagged(spark, sf_dir), by=["task"])
    return kept.select(
        "ord",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.coalesce(F.size("tags"), F.lit(-1)).cast("bigint").alias("n_tags"),
    )


@query
def bio_characters(spark, sf_dir):
    return _tagged_clean(spark, sf_dir).select(
        "ord",
        F.size("tokens").cast("bigint").alias("n_chars"),
        _joined_md5("tokens", "tokens_md5"),
        _joined_md5("tags", "tags_md5"),
    )


@query
def bio_rendered(spark, sf_dir):
    shown = tag_fn.render(F.col("tokens"), F.col("tags"))
    return _tagged_clean(spark, sf_dir).select("ord", F.md5(shown).alias("rendered_md5"))


@query
def quality_report_tags(spark, sf_dir):
    return report.quality_report_tags(_tagged_clean(spark, sf_dir))


@query
def tag_counts(spark, sf_dir):
    return report.tag_counts(_tagged_clean(spark, sf_dir))


@query
def ner_statistics(spark, sf_dir):
    stats = report.ner_statistics(_tagged_clean(spark, sf_dir))
    return stats.withColumn("value", F.round("value", 6))


@query
def contracts_tags(spark, sf_dir):
    checks = report.contracts_tags(views.tagged(spark, sf_dir), ENTITIES.tag_map)
    return checks.withColumn("value", F.round("value", 6))


@query
def split_random(spark, sf_dir):
    cleaned = materialize(_tagged_clean(spark, sf_dir).select("task", "ord"), "tagged")
    return sampling.split_random(cleaned, TAGGING.test_share, f"{TAGGING.seed}:split").select("ord", "split")


@query
def token_index(spark, sf_dir):
    return tagging.token_index(_tagged_split(spark, sf_dir)[1])


def _encoded(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    split, train, _ = _tagged_split(spark, sf_dir)
    vocab = tagging.token_index(train)
    return split, tagging.encode_tokens(split, vocab)


@query
def encoded(spark, sf_dir):
    return _encoded(spark, sf_dir)[1].select(
        "ord", F.size("ids").cast("bigint").alias("n_ids"), _joined_md5("ids", "ids_md5")
    )


@query
def encoded_tags(spark, sf_dir):
    kept = tagging.encode_tags(_tagged_clean(spark, sf_dir), ENTITIES.tag_map)
    return kept.select(
        "ord", F.size("tag_ids").cast("bigint").alias("n_ids"), _joined_md5("tag_ids", "ids_md5")
    )


@query
def unknown_tags(spark, sf_dir):
    rejected = tagging.unknown_tags(_tagged_clean(spark, sf_dir), ENTITIES.tag_map)
    return rejected.select("ord", F.size("tags").cast("bigint").alias("n_tags"))


@query
def decoded(spark, sf_dir):
    coded = tagging.encode_tags(_tagged_clean(spark, sf_dir), ENTITIES.tag_map)
    # Ids beyond the map come back as O.
    shifted = F.transform("tag_ids", lambda i: i + 1)
    names = tagging.decode_tags(shifted, ENTITIES.tag_map)
    return coded.select("ord", _joined_md5(names, "tags_md5"))


@query
def padded(spark, sf_dir):
    coded = materialize(_encoded(spark, sf_dir)[1].select("ord", "ids"), "encoded")
    return tagging.pad_batch(coded, TAGGING.batch_size).select(
        "ord",
        "batch",
        F.size("padded").cast("bigint").alias("width"),
        F.size(F.filter("mask", lambda m: m)).cast("bigint").alias("n_real"),
        _joined_md5("padded", "padded_md5"),
    )


@query
def emissions(spark, sf_dir):
    table = tagging.tag_emissions(_tagged_split(spark, sf_dir)[1], ENTITIES.tag_map)
    return table.select("token", F.posexplode("scores").alias("tag_ix", "score")).select(
        "token", F.col("tag_ix").cast("bigint").alias("tag_ix"), _r("score", "score")
    )


@query
def transitions(spark, sf_dir):
    table = tagging.tag_transitions(_tagged_split(spark, sf_dir)[1], ENTITIES.tag_map)
    return table.select("prev", "tag", _r("score", "score"))


@query
def tag_greedy(spark, sf_dir):
    split, train, _ = _tagged_split(spark, sf_dir)
    table = materialize(tagging.tag_emissions(train, ENTITIES.tag_map), "emissions")
    found = tagging.tag_greedy(split, table, ENTITIES.tag_map)
    return found.select("ord", _joined_md5("predicted", "predicted_md5"))


@query
def entity_report(spark, sf_dir):
    _, train, test = _tagged_split(spark, sf_dir)
    table = materialize(tagging.tag_emissions(train, ENTITIES.tag_map), "emissions")
    found = tagging.tag_greedy(test, table, ENTITIES.tag_map)
    return _rounded_report(tagging.entity_report(found))


def _viterbi(spark, sf_dir, test_only: bool) -> DataFrame:
    split, train, test = _tagged_split(spark, sf_dir)
    table = materialize(tagging.tag_emissions(train, ENTITIES.tag_map), "emissions")
    steps = tagging.tag_transitions(train, ENTITIES.tag_map)
    return tagging.tag_viterbi(test if test_only else split, table, steps, ENTITIES.tag_map)


@query
def tag_viterbi(spark, sf_dir):
    return _viterbi(spark, sf_dir, False).select("ord", _joined_md5("predicted", "predicted_md5"))


@query
def tag_evaluate(spark, sf_dir):
    return _rounded_report(tagging.entity_report(_viterbi(spark, sf_dir, True)))


def _trained(spark, sf_dir):
    _, train, test = _tagged_split(spark, sf_dir)
    return crf.train_crf(train, ENTITIES.tag_map), train, test


@query
def crf_report(spark, sf_dir):
    tagger, _, test = _trained(spark, sf_dir)
    found = tagging.tag_viterbi(test, tagger.emissions, tagger.transitions, ENTITIES.tag_map)
    return _rounded_report(tagging.entity_report(found))


@query
def crf_loss(spark, sf_dir):
    """Loss per token on the test part, under trained and under counted scores."""
    tagger, train, test = _trained(spark, sf_dir)
    counted = materialize(tagging.tag_emissions(train, ENTITIES.tag_map), "emissions"), tagging.tag_transitions(train, ENTITIES.tag_map)
    out = []
    for name, tables in (("trained", (tagger.emissions, tagger.transitions)), ("counted", counted)):
        losses = crf.path_losses(test, *tables, ENTITIES.tag_map)
        out.append(crf.mean_path_loss(losses).select(F.lit(name).alias("scores"), "sentences", "tokens", _r("mean_loss", "mean_loss")))
    return out[0].unionByName(out[1])


# ------------------------------------------------------------------------------- features


def _ngram_stats(spark, sf_dir, grams) -> DataFrame:
    return features.corpus_stats(features.term_sums(views.documents(spark, sf_dir), "all", grams)).drop("block")


@query
def word_ngrams(spark, sf_dir):
    return _ngram_stats(spark, sf_dir, text_fn.word_ngrams)


@query
def char_wb_ngrams(spark, sf_dir):
    return _ngram_stats(spark, sf_dir, text_fn.char_wb_ngrams)


@query
def char_ngrams(spark, sf_dir):
    return _ngram_stats(spark, sf_dir, text_fn.char_ngrams)


def _each_task(spark, sf_dir, build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """`build(balanced records, train part)` of every classification task, with its name in `task`."""
    split = _balanced_split(spark, sf_dir)
    out = None
    for task in CLASSIFICATION.tasks:
        docs = split.filter(F.col("task") == task.name).drop("task")
        built = build(docs, docs.filter(F.col("split") == "train")).withColumn("task", F.lit(task.name))
        out = built if out is None else out.unionByName(built)
    return out


def _vocab_block(spark, sf_dir, block: str) -> DataFrame:
    grams = {block: features.FIT_GRAMS[block]}
    table = _each_task(spark, sf_dir, lambda docs, train: features.fit_vocabulary(train, grams))
    return table.select("task", F.col("ix").cast("bigint").alias("ix"), "term", "tf", "df", _r("idf", "idf"))


@query
def vocab_words(spark, sf_dir):
    return _vocab_block(spark, sf_dir, "word")


@query
def vocab_chars(spark, sf_dir):
    return _vocab_block(spark, sf_dir, "char")


def _frequent(spark, sf_dir, block: str) -> DataFrame:
    counts = features.term_sums(views.documents(spark, sf_dir), block, features.FIT_GRAMS[block])
    return topk.top_k_exact(counts, MAX_FEATURES[block]).select("term", "tf", "df")


@query
def frequent_words(spark, sf_dir):
    """The most frequent word 1-2-grams of all documents, counted for proven candidates only."""
    return _frequent(spark, sf_dir, "word")


@query
def frequent_chars(spark, sf_dir):
    """The most frequent in-word 2-5-grams of all documents, counted for proven candidates only."""
    return _frequent(spark, sf_dir, "char")


def _long(weights: DataFrame) -> DataFrame:
    return weights.select("task", "ord", "block", F.col("ix").cast("bigint").alias("ix"), _r("weight", "weight"))


@query
def tfidf_fit(spark, sf_dir):
    return _long(_each_task(spark, sf_dir, lambda docs, train: features.tfidf_transform(docs, _vocabulary(train))))


@query
def tfidf_serve(spark, sf_dir):
    return _long(_each_task(spark, sf_dir, lambda docs, train: features.tfidf_serve(docs, _vocabulary(train))))


@query
def vector_entries(spark, sf_dir):
    """Index and value of every entry of the served vectors."""
    entries = _each_task(
        spark, sf_dir, lambda docs, train: features.vector_entries(features.tfidf_serve(docs, _vocabulary(train)))
    )
    return entries.select("task", "ord", "ix", _r("value", "value"))


@query
def zero_vectors(spark, sf_dir):
    """Question turns and customer names (below 0) that share no word with the confirmation vocabulary."""
    split = _balanced_split(spark, sf_dir)
    train = split.filter((F.col("task") == CONFIRMATION.name) & (F.col("split") == "train"))
    vocab = materialize(features.fit_vocabulary(train, {"word": features.FIT_GRAMS["word"]}), "vocabulary")
    names = load_table(spark, sf_dir, "customer").select((-1 - F.col("c_custkey")).alias("ord"), F.col("c_name").alias("text"))
    docs = views.questions(spark, sf_dir).select("ord", "text").unionByName(names)
    known = features.term_counts(docs, {"word": text_fn.words}).join(vocab.select("term"), "term")
    return features.zero_vectors(docs, known)


@query
def skew(spark, sf_dir):
    cosines = _each_task(spark, sf_dir, lambda docs, train: features.skew(docs, _vocabulary(train)))
    return cosines.select("task", "ord", "block", _r("cosine", "cosine"))


def _test_scores(docs: DataFrame, train: DataFrame) -> DataFrame:
    test = docs.filter(F.col("split") == "test").select("ord", "text", "label")
    return jobs.train_text_task(train.select("ord", "text", "label"), test)[2]


@query
def classifier_predictions(spark, sf_dir):
    scored = _each_task(spark, sf_dir, _test_scores)
    return scored.select("task", "ord", "label", "predicted", "probability")


@query
def classifier_report(spark, sf_dir):
    return _each_task(
        spark, sf_dir, lambda docs, train: classify.classification_report(classify.confusion(_test_scores(docs, train)))
    )


@query
def classifier_loss(spark, sf_dir):
    return _each_task(spark, sf_dir, lambda docs, train: classify.mean_loss(_test_scores(docs, train)))


@query
def route(spark, sf_dir):
    """Question turns by rule, then by a length model with odds chars / 300."""
    odds = F.length("text") / F.lit(PIVOT_CHARS)
    p = odds / (1 + odds)
    scored = views.questions(spark, sf_dir).select(
        "ord",
        "text",
        F.when(p > 0.5, "Statement").otherwise("Question").alias("predicted"),
        F.greatest(p, 1 - p).alias("probability"),
    )
    routed = routing.route(scored, RULES, ROUTE_THRESHOLD)
    return routed.select("ord", "tier", "decision")


@query
def route_rules(spark, sf_dir):
    """Documents by one rule for each long word of the benchmark; the rest go to the length model."""
    word = r"[A-Za-z]+"
    words = (
        load_table(spark, sf_dir, "benchmark")
        .select("item_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(word), F.lit(0)))).alias("literal"))
        .filter(F.length("literal") >= RULE_CHARS)
        .groupBy("literal")
        .agg(F.min("item_id").cast("string").alias("outcome"))
    )
    # The longest word decides; numbered in a sort over slices, not in one task.
    table = materialize(global_index(words.withColumn("_short", -F.length("literal")), ["_short", "literal"], "rule", 1), "rules")
    bounds = [F.concat(F.lit(b), F.lit("[A-Za-z]"), F.lit(")")) for b in ("(?<!", "(?!")]
    table = table.select("rule", "literal", F.concat(bounds[0], "literal", bounds[1]).alias("pattern"), "outcome")
    p = F.length("text") / (F.length("text") + F.lit(PIVOT_CHARS))
    scored = views.documents(spark, sf_dir).select(
        "ord", "text", F.lit("long").alias("predicted"), p.alias("probability")
    )
    return rule_op.route_by_rules(scored, table, ROUTE_THRESHOLD).select("ord", "rule", "tier", "decision")


@query
def route_trained(spark, sf_dir):
    """Question turns of the test part by rule, then by the trained classifier's probability."""
    split = _balanced_split(spark, sf_dir)
    docs = split.filter(F.col("task") == QUESTION.name).drop("task")
    scored = _test_scores(docs, docs.filter(F.col("split") == "train"))
    table = spark.createDataFrame(
        [(n, None, pattern, outcome) for n, (pattern, outcome) in enumerate(RULES)],
        "rule bigint, literal string, pattern string, outcome string",
    )
    routed = rule_op.route_by_rules(scored, table, ROUTE_THRESHOLD)
    return routed.select("ord", "label", "rule", "tier", "decision")


# ------------------------------------------------------------ near duplicates, diversity


@query
def near_dup_lsh(spark, sf_dir):
    docs = views.documents(spark, sf_dir)
    found = neardup.near_dup_clusters(docs, CLASSIFICATION.near_dup_threshold, CLASSIFICATION.num_perm)
    return found.select("ord", F.col("component").alias("cluster"))


@query
def near_dup_exact(spark, sf_dir):
    """Every document with its class of near duplicates, without MinHash."""
    found = neardup.near_dup_exact(views.documents(spark, sf_dir), CLASSIFICATION.near_dup_threshold)
    return found.select("ord", "shingles", F.col("component").alias("cluster"))


@query
def dedupe_near(spark, sf_dir):
    kept = neardup.dedupe_near(
        views.documents(spark, sf_dir), CLASSIFICATION.near_dup_threshold, CLASSIFICATION.num_perm
    )
    return kept.select("ord")


@query
def dedupe_near_tags(spark, sf_dir):
    """Tagged sentences at their own, higher threshold."""
    rows = views.tagged(spark, sf_dir).filter(F.col("tags").isNotNull())
    texts = rows.select("ord", F.concat_ws("", "tokens").alias("text"))
    return neardup.dedupe_near(texts, TAGGING.near_dup_threshold, TAGGING.num_perm).select("ord")


@query
def diversity(spark, sf_dir):
    found = diversity_op.diversity(views.vectors(spark, sf_dir), SAMPLE_SIZE, SEED_SAMPLE)
    return found.select("vectors", _r("mean_cosine", "mean_cosine"))


@query
def diversity_all(spark, sf_dir):
    found = diversity_op.diversity(views.vectors(spark, sf_dir))
    return found.select("vectors", _r("mean_cosine", "mean_cosine"))


# ----------------------------------------------------------------------------------- jobs


@query
def refine_all(spark, sf_dir):
    """Both families refined, written and read back; rows per task, split and label."""
    from textmill.sources.records import write_records

    root = new_path(spark, "refined")
    texts = jobs.refine(views.classified(spark, sf_dir), CLASSIFICATION).split
    tagged = jobs.refine(views.tagged(spark, sf_dir), TAGGING).split
    write_records(texts, f"{root}/texts", compression="gzip")
    write_records(tagged, f"{root}/tagged", compression="gzip")
    schema = "label string, task string, split string"
    stored = spark.read.schema(schema).json(f"{root}/texts").unionByName(
        spark.read.schema(schema).json(f"{root}/tagged")
    )
    return stored.groupBy("task", "split", "label").agg(F.count("*").alias("rows"))


@query
def refine_removed(spark, sf_dir):
    """Rows that dedupe and cleaning removed in the refine job of both families."""
    texts = jobs.refine(views.classified(spark, sf_dir), CLASSIFICATION).removed
    return texts.unionByName(jobs.refine(views.tagged(spark, sf_dir), TAGGING).removed)


@query
def refine_batches(spark, sf_dir):
    """All classification records in two batches, by odd and even length; the second is given twice."""
    raw = views.classified(spark, sf_dir)
    ledger = KeyLedger(spark, new_path(spark, "ledger"), LEDGER_BUCKETS)
    late = F.coalesce(F.length("text") % 2 == 1, F.lit(True))
    parts = []
    for batch, rows in ((1, raw.filter(~late)), (2, raw.filter(late)), (2, raw.filter(late))):
        # Records of both tasks may share a number; the ledger's are unique.
        numbered = rows.withColumn("record", F.col("ord")).withColumn(
            "ord", F.col("ord") * 2 + (F.col("task") == QUESTION.name).cast("bigint")
        )
        parts.append(jobs.refine_batch(numbered, CLASSIFICATION, ledger, batch).withColumn("batch", F.lit(batch).cast("bigint")))
    kept = parts[0].unionByName(parts[2])
    return kept.select("batch", "task", F.col("record").alias("ord"), "label", F.md5("text").alias("text_md5"))


@query
def train_all(spark, sf_dir):
    """The whole classification job from payload files to stored models."""
    root = new_path(spark, "job")
    for task in CLASSIFICATION.tasks:
        rows = views.classified(spark, sf_dir).filter(F.col("task") == task.name)
        rows.select("text", "label").write.json(f"{root}/raw/{task.name}")
    done = jobs.run(spark, CLASSIFICATION, root, steps=("refine", "train", "export"))
    reports = [df.withColumn("task", F.lit(name)) for name, df in done["train"].items()]
    return reports[0].unionByName(reports[1])
