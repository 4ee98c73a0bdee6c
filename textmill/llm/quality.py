"""Quality rules: a decision list learned from labelled statistics.

Statistics of every text are column expressions. A bounded sample of labelled documents is
described by them and collected; sequential covering grows conjunctions of thresholds for
the rejected class one at a time, prunes each on rows that it was not grown on, and stops at the
first one that is not precise enough. The list comes back as an ordered `when` expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import SPACES, random_unit, text_or_empty, words_of
from textmill.runtime import materialize

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: Labelled documents that a fit looks at, about; all of them if there are no more.
SAMPLE = 4000
#: Least precision of a rule on its pruning rows, and least number of rejected rows it covers there.
PRECISION, SUPPORT = 0.97, 4
MOST_CONDITIONS, MOST_RULES, MOST_THRESHOLDS = 3, 8, 40

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _tail(values: str, start: int) -> Column:
    """The list from its 1-based position `start` on."""
    return F.slice(values, start, F.greatest(F.size(values) - (start - 1), F.lit(0)))


def text_statistics(docs: DataFrame) -> DataFrame:
    """`docs` with the counts of its whole texts, a null text counting as empty.

    `n_words` runs of non-spaces, `word_chars` code points in them, `n_symbols` characters of
    `#*$%&|<>`, `n_dup_lines` lines with a word that equal an earlier line, `n_repeat_words` words in
    five-word windows that the text holds twice or more. Windows are compared by 64-bit hashes. Existing columns of these
    names are replaced. Only texts that repeat a window have their windows sorted.
    """
    rows = docs.drop(*COUNTS).withColumn("_llm_text", text_or_empty()).withColumn("_llm_words", words_of(F.col("_llm_text")))
    lines = F.filter(F.split("_llm_text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    rows = rows.withColumn("_llm_lines", lines).withColumn("_llm_w1", F.transform("_llm_words", lambda w: F.xxhash64(w)))
    rows = rows.select(
        *[c for c in docs.columns if c not in COUNTS],
        F.size("_llm_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_llm_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_llm_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_llm_lines") - F.size(F.array_distinct("_llm_lines"))).cast("long").alias("n_dup_lines"),
        "_llm_w1",
    )
    # Hashes of 2, 4 and 5 words from those of their parts; the last positions hash nulls and are cut off.
    mix = lambda a, b: F.xxhash64(a, b)
    rows = rows.withColumn("_llm_w2", F.zip_with("_llm_w1", _tail("_llm_w1", 2), mix))
    rows = rows.withColumn("_llm_w4", F.zip_with("_llm_w2", _tail("_llm_w2", 3), mix))
    rows = rows.withColumn("_llm_w5", F.zip_with("_llm_w4", _tail("_llm_w1", 5), mix)).drop("_llm_w2", "_llm_w4")
    rows = rows.withColumn("_llm_w5", F.slice("_llm_w5", 1, F.greatest(F.size("_llm_w1") - (WINDOW - 1), F.lit(0)))).drop("_llm_w1")
    repeats = F.size(F.array_distinct("_llm_w5")) < F.size("_llm_w5")
    rows = rows.withColumn("_llm_w5", F.when(repeats, F.col("_llm_w5")))
    placed = F.sort_array(F.transform("_llm_w5", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_llm_placed", placed).drop("_llm_w5")
    same = F.zip_with("_llm_placed", _tail("_llm_placed", 2), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    rows = rows.withColumn("_llm_same", same)
    either = F.zip_with("_llm_same", F.concat(F.array(F.lit(False)), "_llm_same"), lambda a, b: F.coalesce(a, F.lit(False)) | b)
    rows = rows.withColumn("_llm_hit", either).drop("_llm_same")
    at = F.zip_with("_llm_placed", "_llm_hit", lambda p, hit: F.when(hit, p["i"]))
    rows = rows.withColumn("_llm_at", F.sort_array(F.filter(at, lambda i: i.isNotNull()))).drop("_llm_placed", "_llm_hit")
    covered = F.zip_with("_llm_at", _tail("_llm_at", 2), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda n, x: n + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("_llm_at")


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def measures() -> dict[str, Column]:
    """What the rules compare with thresholds, from the counts; 0 for a text without words."""
    share = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")).otherwise(0.0)
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars"),
        "symbols_per_word": share("n_symbols"),
        "repeated_lines": F.col("n_dup_lines").cast("double"),
        "repeated_share": share("n_repeat_words"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    at_least: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.measure] >= self.threshold if self.at_least else row[self.measure] <= self.threshold

    def column(self) -> Column:
        value = measures()[self.measure]
        return value >= F.lit(self.threshold) if self.at_least else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _bad(rows: list[dict]) -> int:
    return sum(r["bad"] for r in rows)


def _thresholds(rows: list[dict], measure: str) -> list[float]:
    values = sorted({r[measure] for r in rows})
    step = max(1, len(values) // MOST_THRESHOLDS)
    return values[::step] + values[-1:]


def _grow(rows: list[dict]) -> Rule:
    """Add the condition of the highest information gain until no accepted row is covered."""
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS and 0 < _bad(rows) < len(rows):
        before, best = math.log2(_bad(rows) / len(rows)), (0.0, None, rows)
        for measure in measures():
            for threshold in _thresholds(rows, measure):
                for at_least in (True, False):
                    condition = Condition(measure, at_least, threshold)
                    left = [r for r in rows if condition.holds(r)]
                    if bad := _bad(left):
                        gain = bad * (math.log2(bad / len(left)) - before)
                        if gain > best[0]:
                            best = (gain, condition, left)
        if best[1] is None:
            break
        rule, rows = (*rule, best[1]), best[2]
    return rule


def _worth(rule: Rule, rows: list[dict]) -> float:
    covered = _covered(rule, rows)
    return (2 * _bad(covered) - len(covered)) / len(covered) if covered else -1.0


def learn_rules(rows: list[dict]) -> list[Rule]:
    """Ordered conjunctions for the rejected class, from rows of measures with `bad` and `prune` flags.

    Two of three rows grow a rule, the others prune it: last conditions go while that does not
    lower (rejected - accepted) / covered. No rule comes from rows of one class.
    """
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        growing, pruning = [r for r in rows if not r["prune"]], [r for r in rows if r["prune"]]
        rule = _grow(growing)
        while len(rule) > 1 and _worth(rule[:-1], pruning) >= _worth(rule, pruning):
            rule = rule[:-1]
        held = _covered(rule, pruning)
        if not rule or _bad(held) < SUPPORT or _bad(held) < PRECISION * len(held):
            break
        rules.append(rule)
        rows = [r for r in rows if not all(c.holds(r) for c in rule)]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[dict]:
    """About `sample` labelled rows of measures, chosen by a hash of doc_id.

    Rows without a quality label or that fail the base rules are left out. A doc_id with several labels has
    its lowest; of documents that share a doc_id the one with the smallest measures counts. So a
    repeated row changes nothing, and what is broadcast and collected stays near `sample` rows.
    """
    labels = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").alias("_llm_id"), "quality")
    share = sample / max(labels.agg(F.countDistinct("_llm_id")).first()[0], 1)
    picked = labels.filter(random_unit("label", F.col("_llm_id")) < share)
    chosen = materialize(picked.groupBy("_llm_id").agg(F.min("quality").alias("quality")), "label-sample")
    # About `sample` rows by construction, one per doc_id, so the texts are not shuffled.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_llm_id"))
    described = text_statistics(joined)
    prune = random_unit("prune", F.col("doc_id")) < 1 / 3
    columns = [c.alias(name) for name, c in measures().items()]
    bad = (F.col("quality") == 0).cast("int").alias("bad")
    # Base failures are taken out at the end: as a filter, the optimizer would push their long expression down.
    rows = described.select("doc_id", *columns, bad, prune.alias("prune"), base_failed().alias("failed"))
    # Any number of documents may share a chosen doc_id; one row of each is collected.
    one = rows.groupBy("doc_id").agg(F.min(F.struct(*[c for c in rows.columns if c != "doc_id"])).alias("_llm_row"))
    collected = one.select("doc_id", "_llm_row.*").collect()
    return [r.asDict() for r in sorted(collected) if not r["failed"]]


def first_rule(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    none = F.lit(None).cast("int")
    if not rules:
        return none
    chain = F
    for number, rule in enumerate(rules, 1):
        chain = chain.when(reduce(lambda a, b: a & b, [c.column() for c in rule]), F.lit(number))
    return chain.otherwise(none)


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`docs` with counts, `base_failed`, `rule` (number of the rule that rejects it) and `kept`.

    Every row comes back, also without doc_id or label. An empty table, or labels of one class
    only, give an empty list of rules; the base rules still hold. Existing columns of these names are replaced.
    """
    rules = learn_rules(labelled_sample(docs, labels, sample))
    judged = text_statistics(docs.drop("base_failed", "rule", "kept"))
    judged = judged.withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with the columns of `docs`."""
    # A filter stays above a row number; below it, the optimizer would copy the statistics'
    # expressions into the filter many times.
    judged = judge(docs, labels, sample).withColumn("_llm_row", F.monotonically_increasing_id())
    return judged.filter("kept AND _llm_row >= 0").select(docs.columns)
