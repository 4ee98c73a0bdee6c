"""Secret scans with a trigram index.

Each rule's regular expression gives a Boolean query of trigrams that any match must contain. A
task reads its documents in blocks, builds the postings of the trigrams that the rules ask for,
intersects and joins them as the queries say, and runs a rule over its candidates only. A rule
without mandatory trigrams runs over all texts. Index and texts stay in the same task: nothing
is shuffled, and a source or copy that fills a third of the table is spread as its rows are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import blocks
from textmill.llm.trigrams import BlockIndex, trigram_query, trigrams_of

#: Bytes of text of a block, or a single longer text.
BLOCK_BYTES = 4 << 20
SPANS = "array<struct<kind: string, start: long, end: long>>"


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and not overlapping; those whose `group` is shorter than `least` are dropped."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 1


# The kinds that the query counts.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # The same spans as [0-9a-f]+ of 24 or more characters: a run is matched as a whole either way.
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Kinds that the index adds at little cost, as each has mandatory trigrams.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/=-]{16,}", re.ASCII | re.IGNORECASE),
    Rule("login", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES


def scan_block(texts: list[bytes], rules: Sequence[Rule]) -> list[list[dict]]:
    """Spans of each text, in code points, by start and then in the order of the rules."""
    queries = [trigram_query(r.pattern, r.flags) for r in rules]
    index = BlockIndex([t.lower() for t in texts], set().union(*[trigrams_of(q) for q in queries]))
    decoded: dict[int, str] = {}
    found: list[list] = [[] for _ in texts]
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        expression = re.compile(rule.pattern, rule.flags)
        for i in index.candidates(query).tolist():
            if i not in decoded:
                decoded[i] = texts[i].decode("utf-8", "replace")
            for m in expression.finditer(decoded[i]):
                if len(m[rule.group]) >= rule.least:
                    found[i].append((m.start(), number, {"kind": rule.kind, "start": m.start(), "end": m.end()}))
    return [[span for *_, span in sorted(spans, key=lambda s: s[:2])] for spans in found]


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """`(doc_id, spans)`: the spans that the rules find in each row's text.

    Starts are inclusive, ends exclusive, both in code points. A null or empty text has no spans; a very long text is a block
    of its own and is searched whole. An empty table gives no row.
    Every row of `docs` comes back, also one without doc_id or one that repeats another; columns other than doc_id
    and text are not read.
    """

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        for batch in batches:
            for ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                spans = pa.array(scan_block([t or b"" for t in texts], rules), kind)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), spans], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(scan, f"doc_id long, spans {SPANS}")


def secret_digests(found: DataFrame) -> DataFrame:
    """The counts and digests of the base kinds, and all spans as a string."""
    base = {r.kind for r in BASE_RULES}

    def written(spans):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(r.kind) for r in BASE_RULES],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(*base))).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
