"""Independent SQL for the registered queries, run by DuckDB on the same tables.

Left out, because SQL has no form of them: the trained classifier and what is computed
from it, and the Viterbi search. Tests check these against brute force or a Newton solve.
"""

from __future__ import annotations

from textmill.plans.queries import (
    PIVOT_CHARS,
    ROUTE_THRESHOLD,
    RULE_CHARS,
    RULES,
    SAMPLE_SIZE,
    SEED_BALANCE,
    SEED_SAMPLE,
    SEED_SPLIT,
)
from textmill.plans.views import (
    RECORDS_PER_RESPONSE,
)
from textmill.spec import CLASSIFICATION, ENTITIES, MAX_FEATURES, TAGGING

TAGS = sorted(ENTITIES.tag_map, key=ENTITIES.tag_map.get)
TAG_LIST = "[" + ", ".join(f"'{t}'" for t in TAGS) + "]"


def _norm(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[\\s\\x0b\\x1c-\\x1f\\x85\\pZ]+', ' ', 'g'))"


def _with(*parts: str, select: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(p.strip() for p in parts) + "\n" + select.strip()


# ---------------------------------------------------------------- classification records

QUESTIONS = f"""
q_raw AS (
  SELECT 'is_question' AS task, conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS ord, text,
         CASE role WHEN 'user' THEN 'Question' WHEN 'assistant' THEN 'Statement' ELSE role END AS label
  FROM conversations)
"""
RAW = f"""
{QUESTIONS.strip()},
c_raw AS (
  SELECT 'confirmation' AS task, doc_id AS ord, text,
         CASE WHEN toxic = 1 THEN 'Unsure' WHEN quality = 1 THEN 'Affirm' ELSE 'Deny' END AS label
  FROM documents JOIN labels USING (doc_id)
  UNION ALL SELECT * FROM q_raw)
"""
VALID = (
    "((task = 'confirmation' AND label IN ('Affirm', 'Deny'))"
    " OR (task = 'is_question' AND label IN ('Question', 'Statement')))"
)
CLEAN = f"""
{RAW.strip()},
c_dedup AS (
  SELECT * FROM c_raw QUALIFY row_number() OVER (PARTITION BY task, text ORDER BY ord) = 1),
c_norm AS (SELECT task, ord, {_norm('text')} AS text, label FROM c_dedup),
c_clean AS (SELECT * FROM c_norm WHERE {VALID} AND text <> '')
"""
SPLIT = f"""
{CLEAN.strip()},
c_counts AS (SELECT task, label, count(*) AS n FROM c_clean GROUP BY ALL),
c_min AS (SELECT task, min(n) AS m FROM c_counts GROUP BY task),
c_under AS (
  SELECT c.* FROM c_clean c JOIN c_min USING (task)
  QUALIFY row_number() OVER (PARTITION BY task, label ORDER BY md5('{SEED_BALANCE}|' || ord), ord) <= m),
u_counts AS (SELECT task, label, count(*) AS n FROM c_under GROUP BY ALL),
u_total AS (
  SELECT task, sum(n)::BIGINT AS total, sum(n)::BIGINT - ceil({CLASSIFICATION.test_share} * sum(n))::BIGINT AS n_train
  FROM u_counts GROUP BY task),
u_floor AS (
  SELECT task, label, n_train, n * n_train / total AS exact, floor(n * n_train / total)::BIGINT AS low
  FROM u_counts JOIN u_total USING (task)),
u_quota AS (
  SELECT task, label,
         low + CASE WHEN row_number() OVER (PARTITION BY task ORDER BY exact - low DESC, label)
                         <= n_train - sum(low) OVER (PARTITION BY task) THEN 1 ELSE 0 END AS quota
  FROM u_floor),
c_split AS (
  SELECT u.*, CASE WHEN row_number() OVER (PARTITION BY task, label ORDER BY md5('{SEED_SPLIT}|' || ord), ord)
                        <= quota THEN 'train' ELSE 'test' END AS split
  FROM c_under u JOIN u_quota USING (task, label))
"""

# ----------------------------------------------------------------------- tagged sentences

TAGGED = r"""
t_parts AS (
  SELECT doc_id AS ord, quality, toxic,
         list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda p: p <> '') AS tokens
  FROM documents LEFT JOIN labels USING (doc_id)),
t_tags AS (
  SELECT *, list_transform(list_zip(tokens, list_prepend('', tokens)[1:len(tokens)]), lambda z:
    CASE WHEN regexp_matches(z[1], '^\p{Lu}') THEN 'B-PROJ'
         WHEN regexp_matches(z[1], '^[0-9]') THEN 'B-XXX'
         WHEN z[1][-1] = ',' AND regexp_matches(z[2], '^\p{Lu}') THEN 'I-PROJ'
         WHEN z[1][-1] = ',' THEN 'B-PERS'
         WHEN z[1][-1] = '.' AND z[2][-1] = ',' THEN 'I-EVT'
         WHEN z[1][-1] = '.' THEN 'B-EVT'
         ELSE 'O' END) AS all_tags
  FROM t_parts),
t_raw AS (
  SELECT ord, tokens,
         CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN all_tags[1:len(all_tags) - 1] ELSE all_tags END AS tags
  FROM t_tags),
t_dedup AS (
  SELECT * FROM t_raw
  QUALIFY row_number() OVER (PARTITION BY coalesce(array_to_string(tokens, ''), '') ORDER BY ord) = 1)
"""
TAGGED_CLEAN = f"""
{TAGGED.strip()},
t_pairs AS (
  SELECT ord, flatten(list_transform(
      list_zip(tokens[1:least(len(tokens), len(tags))], tags[1:least(len(tokens), len(tags))]), lambda z:
        list_transform(range(1, length(z[1]) + 1), lambda i: {{
          'token': substr(z[1], i, 1),
          'tag': CASE WHEN i > 1 AND starts_with(z[2], 'B-') THEN 'I-' || substr(z[2], 3) ELSE z[2] END}}))) AS pairs
  FROM t_dedup WHERE tokens IS NOT NULL AND tags IS NOT NULL),
t_clean AS (
  SELECT ord, list_transform(pairs, lambda p: p.token) AS tokens, list_transform(pairs, lambda p: p.tag) AS tags, pairs
  FROM t_pairs)
"""
TAGGED_SPLIT = f"""
{TAGGED_CLEAN.strip()},
t_split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{TAGGING.seed}:split|' || ord), ord)
                      <= count(*) OVER () - ceil({TAGGING.test_share} * count(*) OVER ())
                 THEN 'train' ELSE 'test' END AS split
  FROM t_clean),
t_train AS (SELECT ord, pairs, tags FROM t_split WHERE split = 'train'),
t_index AS (
  SELECT token, row_number() OVER (ORDER BY token) AS ix
  FROM (SELECT DISTINCT unnest(pairs).token AS token FROM t_train)
  UNION ALL SELECT '<PAD>', 0
  UNION ALL SELECT '<UNK>', (SELECT count(DISTINCT p.token) FROM (SELECT unnest(pairs) AS p FROM t_train)) + 1)
"""
ENCODED = f"""
{TAGGED_SPLIT.strip()},
t_pos AS (
  SELECT ord, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS pos FROM t_split),
t_ids AS (
  SELECT ord, list(coalesce(i.ix, u.ix) ORDER BY pos) AS ids
  FROM t_pos LEFT JOIN t_index i USING (token) CROSS JOIN (SELECT ix FROM t_index WHERE token = '<UNK>') u
  GROUP BY ord),
t_encoded AS (SELECT s.ord, coalesce(ids, []) AS ids FROM t_split s LEFT JOIN t_ids USING (ord))
"""
EMISSIONS = f"""
{TAGGED_SPLIT.strip()},
e_pairs AS (SELECT unnest(pairs) AS p FROM t_train),
e_known AS (SELECT p.token AS token, p.tag AS tag FROM e_pairs),
e_tokens AS (SELECT DISTINCT token FROM e_known),
e_counts AS (
  SELECT token, tag, count(*) AS n FROM e_known GROUP BY ALL
  UNION ALL SELECT '<UNK>', tag, count(*) FROM e_known GROUP BY tag),
e_grid AS (
  SELECT token, t.tag, t.tag_ix, coalesce(n, 0) AS n
  FROM (SELECT token FROM e_tokens UNION ALL SELECT '<UNK>')
  CROSS JOIN (SELECT unnest({TAG_LIST}) AS tag, unnest(range({len(TAGS)})) AS tag_ix) t
  LEFT JOIN e_counts USING (token, tag)),
e_scores AS (
  SELECT token, tag, tag_ix, ln((n + 1) / (sum(n) OVER (PARTITION BY token) + {len(TAGS)})) AS score FROM e_grid)
"""
GREEDY = f"""
{EMISSIONS.strip()},
g_best AS (
  SELECT token, tag FROM e_scores
  QUALIFY row_number() OVER (PARTITION BY token ORDER BY score DESC, tag_ix) = 1),
g_pos AS (
  SELECT ord, split, unnest(pairs) AS p, unnest(range(1, len(pairs) + 1)) AS pos FROM t_split),
g_pred AS (
  SELECT ord, split, pos, p.tag AS truth, coalesce(b.tag, u.tag) AS pred
  FROM (SELECT *, p.token AS token FROM g_pos) LEFT JOIN g_best b USING (token)
  CROSS JOIN (SELECT tag FROM g_best WHERE token = '<UNK>') u)
"""


def _report(source: str, truth: str, pred: str) -> tuple[str, str]:
    """CTEs and select of a classification report over pairs."""
    parts = f"""
r_pairs AS (SELECT {truth} AS truth, {pred} AS pred FROM {source}),
r_class AS (SELECT truth AS class FROM r_pairs UNION SELECT pred FROM r_pairs),
r_counts AS (
  SELECT class,
         (SELECT count(*) FROM r_pairs WHERE truth = class AND pred = class) AS tp,
         (SELECT count(*) FROM r_pairs WHERE truth = class) AS support,
         (SELECT count(*) FROM r_pairs WHERE pred = class) AS predicted
  FROM r_class),
r_pr AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall
  FROM r_counts),
r_f AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM r_pr)
"""
    select = """
SELECT class, round(precision::DOUBLE, 6) AS precision, round(recall::DOUBLE, 6) AS recall,
       round(f1::DOUBLE, 6) AS f1, support::BIGINT AS support FROM r_f
UNION ALL
SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
       round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM r_f
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM r_f
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       sum(support)::BIGINT FROM r_f
"""
    return parts, select


# -------------------------------------------------------------------------------- ingest

PAYLOAD = f"""
p_docs AS (
  SELECT CASE WHEN toxic = 1 THEN -1 - doc_id ELSE doc_id // {RECORDS_PER_RESPONSE} END AS batch, doc_id, text,
         coalesce(quality, 1) AS quality
  FROM documents LEFT JOIN labels USING (doc_id)),
p_kind AS (
  SELECT batch, CASE WHEN batch >= 0 THEN 'list' WHEN min(quality) = 0 THEN 'unparsable' ELSE 'not_a_list' END AS kind
  FROM p_docs GROUP BY batch),
p_items AS (
  SELECT batch, row_number() OVER (PARTITION BY batch ORDER BY doc_id) - 1 AS pos, text, quality FROM p_docs),
p_valid AS (
  SELECT batch, pos, md5(text) AS text_md5, 'Affirm' AS label
  FROM p_items JOIN p_kind USING (batch) WHERE kind = 'list' AND quality = 1)
"""
PAYLOAD_ITEMS = _with(PAYLOAD, select="SELECT batch, pos, text_md5, label FROM p_valid")
QUOTA = f"""
s_kept AS (SELECT source AS task, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
s_have AS (SELECT task, count(*) AS n FROM s_kept GROUP BY task),
s_plan AS (
  SELECT task, coalesce(n, 0) AS existing, {CLASSIFICATION.target_records} - coalesce(n, 0) AS deficit
  FROM (SELECT DISTINCT source AS task FROM documents) LEFT JOIN s_have USING (task)),
s_open AS (
  SELECT task, existing, deficit, ceil(deficit / {CLASSIFICATION.records_per_request})::BIGINT AS requests
  FROM s_plan WHERE deficit > 0)
"""

# ------------------------------------------------------------------------------- features


def _word_terms(source: str, name: str, pairs: bool) -> str:
    terms = "w"
    if pairs:
        terms = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
{name} AS (
  SELECT ord, unnest({terms}) AS term
  FROM (SELECT ord, regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}') AS w FROM {source}))
"""


def _wb_terms(source: str, name: str) -> str:
    return f"""
{name}_w AS (
  SELECT ord, ' ' || w || ' ' AS w
  FROM (SELECT ord, unnest(string_split({_norm('text')}, ' ')) AS w FROM {source}) WHERE w <> ''),
{name} AS (
  SELECT ord, substr(w, i, n) AS term
  FROM (SELECT ord, w, n, unnest(range(1, length(w) - n + 2)) AS i
        FROM {name}_w CROSS JOIN (SELECT unnest([2, 3, 4, 5]) AS n)))
"""


def _windows(source: str, text: str, name: str, low: int, high: int) -> str:
    """CTEs ending in `name` (ord, term): character windows of `low`..`high`."""
    leads = ", ".join(f"lead(c0, {k}) OVER w AS c{k}" for k in range(1, high))
    union = " UNION ALL ".join(
        f"SELECT ord, {' || '.join(f'c{k}' for k in range(n))} AS term FROM {name}_l WHERE c{n - 1} IS NOT NULL"
        for n in range(low, high + 1)
    )
    return f"""
{name}_c AS (
  SELECT ord, unnest(c) AS c0, unnest(range(len(c))) AS pos
  FROM (SELECT ord, string_split({text}, '') AS c FROM {source})),
{name}_l AS (SELECT ord, c0, {leads} FROM {name}_c WINDOW w AS (PARTITION BY ord ORDER BY pos)),
{name} AS ({union})
"""


def _char_terms(source: str, name: str) -> str:
    return _windows(source, "lower(text)", name, 2, 5)


def _stats(terms: str) -> str:
    return f"""
SELECT term, count(*) AS tf, count(DISTINCT ord) AS df FROM {terms} GROUP BY term
"""


DOCS = "d_docs AS (SELECT doc_id AS ord, text FROM documents)"


def _vocab(train: str, block: str) -> str:
    """CTEs ending in `v_<block>` (ix, term, tf, df, idf)."""
    name = f"v_{block}"
    terms = _word_terms(train, f"{name}_t", True) if block == "word" else _wb_terms(train, f"{name}_t")
    return f"""
{terms.strip()},
{name}_s AS ({_stats(f'{name}_t').strip()}),
{name}_k AS (SELECT * FROM {name}_s ORDER BY tf DESC, term LIMIT {MAX_FEATURES[block]}),
{name} AS (
  SELECT row_number() OVER (ORDER BY term) - 1 AS ix, term, tf, df,
         ln((1 + (SELECT count(*) FROM {train})) / (1 + df)) + 1 AS idf
  FROM {name}_k)
"""


def _train(task: str) -> str:
    return f"""
{SPLIT.strip()},
f_docs AS (SELECT ord, text FROM c_split WHERE task = '{task}'),
f_train AS (SELECT ord, text FROM c_split WHERE task = '{task}' AND split = 'train')
"""


def _weights(docs: str, blocks: dict[str, str], weight: str, name: str) -> str:
    """CTEs ending in `name` (ord, block, ix, weight) from term CTEs per block."""
    parts, union = [], []
    for block, terms in blocks.items():
        w = f"{name}_{block}"
        parts.append(f"""
{w}_c AS (SELECT ord, term, count(*) AS n FROM {terms} GROUP BY ALL),
{w}_w AS (SELECT ord, '{block}' AS block, ix, {weight} AS weight FROM {w}_c c JOIN v_{block} v USING (term))""")
        union.append(f"SELECT *, weight / sqrt(sum(weight * weight) OVER (PARTITION BY ord)) AS unit FROM {w}_w")
    return (
        ",".join(p.strip("\n") for p in parts)
        + f",\n{name} AS (SELECT ord, block, ix, unit AS weight FROM ("
        + "\nUNION ALL ".join(union)
        + "))"
    )


FIT_WEIGHT = "(1 + ln(n)) * v.idf"
SERVE_WEIGHT = "n * v.idf::FLOAT::DOUBLE"
VOCAB = f"""
{_vocab('f_train', 'word').strip()},
{_vocab('f_train', 'char').strip()}
"""


def _each_task(*parts: str, select: str) -> str:
    """The same SQL for every classification task, with its name."""
    return "\nUNION ALL\n".join(
        f"SELECT '{t.name}' AS task, * FROM ({_with(_train(t.name), *parts, select=select)})" for t in CLASSIFICATION.tasks
    )


FIT = f"""
{_word_terms('f_docs', 'a_word', True).strip()},
{_wb_terms('f_docs', 'a_char').strip()},
{_weights('f_docs', {'word': 'a_word', 'char': 'a_char'}, FIT_WEIGHT, 'fit')}
"""


def _serve(docs: str) -> str:
    return f"""
{_word_terms(docs, 'b_word', False).strip()},
{_char_terms(docs, 'b_char').strip()},
{_weights(docs, {'word': 'b_word', 'char': 'b_char'}, SERVE_WEIGHT, 'raw_serve')},
serve AS (SELECT ord, block, ix, weight::FLOAT AS weight FROM raw_serve)
"""


# ------------------------------------------------------------ near duplicates, diversity



def _near(texts: str, threshold: float) -> str:
    """Clusters of `(ord, text)` by the similarity of all pairs.

    Pairs that can reach the threshold share one of their rarest shingles; the others
    are left out of the comparison without changing its result.
    """
    return f"""
l_norm AS (SELECT ord, {_norm('text')} AS t FROM ({texts})),
{_windows('l_norm', 't', 'l_win', 5, 5).strip()},
l_set AS (
  SELECT ord, term AS s FROM l_win
  UNION SELECT ord, t FROM l_norm WHERE length(t) BETWEEN 1 AND 4),
l_rare AS (
  SELECT ord, s, count(*) OVER (PARTITION BY ord) AS n, row_number() OVER (PARTITION BY ord ORDER BY df, s) AS r
  FROM (SELECT ord, s, count(*) OVER (PARTITION BY s) AS df FROM l_set)),
l_first AS (SELECT * FROM l_rare WHERE r <= n - ceil({threshold} * n) + 1),
l_cand AS (
  SELECT DISTINCT a.ord AS u, b.ord AS v FROM l_first a JOIN l_first b ON a.s = b.s AND a.ord < b.ord
  WHERE least(a.n, b.n) >= {threshold} * greatest(a.n, b.n)),
l_lists AS (SELECT ord, list(s) AS shingles FROM l_set GROUP BY ord),
l_both AS (
  SELECT u, v, len(list_intersect(a.shingles, b.shingles)) AS shared, len(a.shingles) + len(b.shingles) AS total
  FROM l_cand JOIN l_lists a ON a.ord = u JOIN l_lists b ON b.ord = v),
l_pairs AS (SELECT u, v FROM l_both WHERE shared::DOUBLE / (total - shared) >= {threshold}),
l_edges AS (SELECT u, v FROM l_pairs UNION SELECT v, u FROM l_pairs),
x_reach AS (SELECT u AS a, u AS b FROM l_edges UNION SELECT x_reach.a, e.v FROM x_reach JOIN l_edges e ON e.u = x_reach.b),
l_cluster AS (SELECT a AS ord, min(b) AS cluster FROM x_reach GROUP BY a)
"""


def _diversity(source: str) -> str:
    return f"""
SELECT max(n) AS vectors, round((sum(s * s) - max(n)) / (max(n) * (max(n) - 1)), 6) AS mean_cosine FROM (
  SELECT dim, sum(x / norm) AS s, count(*) AS n FROM (
    SELECT unnest(range(64)) AS dim, unnest(v) AS x, norm FROM (
      SELECT v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm
      FROM (SELECT embedding::DOUBLE[] AS v FROM {source})))
  GROUP BY dim)
"""


_toxic_parts, _report_select = _report(
    "labels JOIN documents USING (doc_id)",
    "CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END",
    "CASE WHEN toxic = 0 THEN 'good' ELSE 'poor' END",
)
_entity_parts, _ = _report(
    "(SELECT * FROM g_pred WHERE split = 'test' AND truth <> 'O')", "truth", "pred"
)
_check = "SELECT {0} AS task, '{1}' AS \"check\", rows, ({2})::BIGINT AS violations, round(({3})::DOUBLE, 6) AS value, {4} AS passed FROM x_sum"
_tag_check = "SELECT '{0}' AS \"check\", rows, ({1})::BIGINT AS violations, round(({2})::DOUBLE, 6) AS value, {3} AS passed FROM x_sum"


def _simple(name: str, column: str) -> str:
    return _tag_check.format(name, column, f"{column} / rows", f"{column} = 0")


ORACLES: dict[str, str] = {
    "label_distribution": _with(
        CLEAN, select='SELECT task, label, count(*) AS "count" FROM c_clean GROUP BY ALL'
    ),
    "stage_removed_counts": _with(
        CLEAN,
        select="""
SELECT task, loaded, loaded - deduped AS removed_duplicates, deduped - kept AS removed_invalid, kept
FROM (SELECT task, count(*) AS loaded FROM c_raw GROUP BY task)
JOIN (SELECT task, count(*) AS deduped FROM c_dedup GROUP BY task) USING (task)
JOIN (SELECT task, count(*) AS kept FROM c_clean GROUP BY task) USING (task)""",
    ),
    "normalized_text": f"""
SELECT ord, md5(t) AS text_md5, length(t) AS n_chars
FROM (SELECT doc_id AS ord, {_norm('text')} AS t FROM documents)""",
    "dedupe_exact": """
SELECT min(doc_id) AS ord, md5(text) AS text_md5 FROM documents GROUP BY text""",
    "quality_report": _with(
        CLEAN,
        select="""
SELECT task, 'rows' AS section, 'total' AS key, count(*) AS value FROM c_clean GROUP BY task
UNION ALL SELECT task, 'label', label, count(*) FROM c_clean GROUP BY task, label""",
    ),
    "class_weights": _with(
        CLEAN,
        "x_counts AS (SELECT task, label, count(*) AS rows FROM c_clean GROUP BY ALL)",
        select="""
SELECT task, label, rows, min(rows) OVER w AS min_rows,
       round(sum(rows) OVER w / (count(*) OVER w * rows), 6) AS weight
FROM x_counts WINDOW w AS (PARTITION BY task)""",
    ),
    "contracts_text": _with(
        RAW,
        """
x_label AS (SELECT task, label, count(*) AS n FROM c_raw GROUP BY ALL),
x_sum AS (
  SELECT task, count(*) AS rows, count(*) - count(DISTINCT text) AS dup,
         count(*) FILTER (NOT regexp_matches(text, '\\p{Latin}')) AS alien,
         (SELECT max(n) / min(n) FROM x_label l WHERE l.task = c_raw.task) AS ratio
  FROM c_raw GROUP BY task)""",
        select="\nUNION ALL ".join(
            [
                _check.format("task", "unique", "dup", "dup / rows", "dup = 0"),
                _check.format("task", "balanced", "0", "ratio", "ratio <= 1.5"),
                _check.format("task", "script", "alien", "alien / rows", "alien = 0"),
            ]
        ),
    ),
    "undersample": _with(SPLIT, select="SELECT task, ord, label FROM c_under"),
    "split_stratified": _with(SPLIT, select="SELECT task, ord, label, split FROM c_split"),
    "sample_n": f"""
SELECT doc_id AS ord FROM documents ORDER BY md5('{SEED_SAMPLE}|' || doc_id), doc_id LIMIT {SAMPLE_SIZE}""",
    "report_from_labels": _with(_toxic_parts, select=_report_select),
    "payload_items": PAYLOAD_ITEMS,
    "payload_outcomes": _with(
        PAYLOAD,
        select="""
SELECT batch, CASE WHEN kind <> 'list' THEN kind WHEN n = 0 THEN 'no_valid_item' ELSE 'accepted' END AS outcome, n AS accepted
FROM (SELECT k.batch, kind, count(v.pos) AS n FROM p_kind k LEFT JOIN p_valid v USING (batch) GROUP BY ALL)""",
    ),
    "outcomes_stream": _with(
        PAYLOAD,
        select="""
SELECT batch, CASE WHEN kind <> 'list' THEN kind WHEN n = 0 THEN 'no_valid_item' ELSE 'accepted' END AS outcome, n AS accepted
FROM (SELECT k.batch, kind, count(v.pos) AS n FROM p_kind k LEFT JOIN p_valid v USING (batch) GROUP BY ALL)""",
    ),
    "rejects_stream": _with(
        PAYLOAD,
        select="""
SELECT batch, pos, 'missing_keys' AS reason FROM p_items JOIN p_kind USING (batch) WHERE kind = 'list' AND quality <> 1
UNION ALL SELECT batch, NULL, kind FROM p_kind WHERE kind <> 'list'""",
    ),
    "event_props_valid": """
SELECT event_type, count(*) AS rows,
       count(*) FILTER (json_type(props) = 'OBJECT' AND list_contains(json_keys(props), 'k')) AS valid
FROM events GROUP BY event_type""",
    "quota_plan": _with(QUOTA, select="SELECT task, existing, deficit, requests FROM s_open"),
    "quota_requests": _with(
        QUOTA, select="SELECT task, unnest(range(1, requests + 1)) AS request FROM s_open"
    ),
    "ingest_stream": PAYLOAD_ITEMS,
    "dedupe_stream": "SELECT md5(text) AS text_md5 FROM (SELECT DISTINCT text FROM documents)",
    "dedupe_tagged": _with(
        TAGGED,
        select="SELECT ord, len(tokens) AS n_tokens, coalesce(len(tags), -1) AS n_tags FROM t_dedup",
    ),
    "bio_characters": _with(
        TAGGED_CLEAN,
        select="""
SELECT ord, len(tokens) AS n_chars, md5(array_to_string(tokens, ',')) AS tokens_md5,
       md5(array_to_string(tags, ',')) AS tags_md5 FROM t_clean""",
    ),
    "bio_rendered": _with(
        TAGGED_CLEAN,
        select="""
SELECT ord, md5(array_to_string(list_transform(pairs, lambda p:
         CASE WHEN p.tag = 'O' THEN p.token ELSE '[' || p.token || '|' || p.tag || ']' END), ' ')) AS rendered_md5
FROM t_clean""",
    ),
    "quality_report_tags": _with(
        TAGGED_CLEAN,
        select="""
SELECT 'rows' AS section, 'total' AS key, count(*) AS value FROM t_clean
UNION ALL SELECT 'tag', tag, count(*) FROM (SELECT unnest(tags) AS tag FROM t_clean) GROUP BY tag""",
    ),
    "tag_counts": _with(
        TAGGED_CLEAN,
        select='SELECT tag, count(*) AS "count" FROM (SELECT unnest(tags) AS tag FROM t_clean) GROUP BY tag',
    ),
    "ner_statistics": _with(
        TAGGED_CLEAN,
        """
x_len AS (SELECT len(tags) AS n, len(list_filter(tags, lambda t: t <> 'O')) = 0 AS plain FROM t_clean),
x_stat AS (
  SELECT count(*)::DOUBLE AS sentences, min(n)::DOUBLE AS min_length, avg(n) AS mean_length,
         quantile_cont(n, 0.5)::DOUBLE AS median_length, max(n)::DOUBLE AS max_length,
         avg(plain::INT) AS share_without_entity FROM x_len)""",
        select="""
SELECT 'sentence' AS section, name AS key, round(value, 6) AS value FROM (UNPIVOT x_stat ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL
SELECT 'entity', substr(tag, 3), count(*)::DOUBLE FROM (SELECT unnest(tags) AS tag FROM t_clean)
WHERE starts_with(tag, 'B-') GROUP BY tag""",
    ),
    "contracts_tags": _with(
        TAGGED,
        f"""
x_rows AS (
  SELECT *, coalesce(array_to_string(tokens, ''), '') AS txt,
         list_zip(tags, list_prepend('O', tags)[1:len(tags)]) AS steps FROM t_raw),
x_sum AS (
  SELECT count(*) AS rows,
    count(*) FILTER (tags IS NULL OR len(tokens) <> len(tags)) AS lens,
    count(*) FILTER (tags IS NULL OR NOT list_has_all({TAG_LIST}, tags)) AS strange,
    count(*) FILTER (tags IS NULL OR len(list_filter(steps, lambda z: starts_with(z[1], 'I-')
        AND NOT (z[2][1:2] IN ('B-', 'I-') AND z[2][3:] = z[1][3:]))) > 0) AS seq,
    count(*) FILTER (len(list_filter(tokens, lambda t: length(t) <> 1)) > 0) AS multi,
    count(*) FILTER (tags IS NOT NULL AND len(list_filter(tags, lambda t: t <> 'O')) = 0) AS plain,
    count(*) FILTER (length(txt) NOT BETWEEN 5 AND 50) AS span,
    count(*) - count(DISTINCT txt) AS dup,
    3 - (SELECT count(DISTINCT tag) FROM (SELECT unnest(tags) AS tag FROM t_raw)
         WHERE tag IN ('B-PROJ', 'B-PERS', 'B-EVT')) AS absent
  FROM x_rows)""",
        select="\nUNION ALL ".join(
            [
                _simple("equal_lengths", "lens"),
                _simple("known_tags", "strange"),
                _simple("tag_order", "seq"),
                _simple("single_characters", "multi"),
                _tag_check.format("share_without_entity", "0", "plain / rows", "plain / rows BETWEEN 0.2 AND 0.3"),
                _simple("sentence_length", "span"),
                _simple("unique", "dup"),
                _tag_check.format("all_types_occur", "absent", "absent", "absent = 0"),
            ]
        ),
    ),
    "split_random": _with(TAGGED_SPLIT, select="SELECT ord, split FROM t_split"),
    "token_index": _with(TAGGED_SPLIT, select="SELECT token, ix FROM t_index"),
    "encoded": _with(
        ENCODED, select="SELECT ord, len(ids) AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM t_encoded"
    ),
    "encoded_tags": _with(
        TAGGED_CLEAN,
        select=f"""
SELECT ord, len(tags) AS n_ids,
       md5(array_to_string(list_transform(tags, lambda t: list_position({TAG_LIST}, t) - 1), ',')) AS ids_md5
FROM t_clean WHERE list_has_all({TAG_LIST}, tags)""",
    ),
    "unknown_tags": _with(
        TAGGED_CLEAN,
        select=f"SELECT ord, len(tags) AS n_tags FROM t_clean WHERE NOT list_has_all({TAG_LIST}, tags)",
    ),
    "decoded": _with(
        TAGGED_CLEAN,
        select=f"""
SELECT ord, md5(array_to_string(list_transform(tags, lambda t:
         coalesce({TAG_LIST}[list_position({TAG_LIST}, t) + 1], 'O')), ',')) AS tags_md5
FROM t_clean WHERE list_has_all({TAG_LIST}, tags)""",
    ),
    "padded": _with(
        ENCODED,
        f"""
x_batch AS (SELECT ord, ids, (row_number() OVER (ORDER BY ord) - 1) // {TAGGING.batch_size} AS batch FROM t_encoded),
x_width AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS width FROM x_batch)""",
        select="""
SELECT ord, batch, width, len(ids) AS n_real,
       md5(array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda i: 0::BIGINT)), ',')) AS padded_md5
FROM x_width""",
    ),
    "emissions": _with(EMISSIONS, select="SELECT token, tag_ix, round(score, 6) AS score FROM e_scores"),
    "transitions": _with(
        TAGGED_SPLIT,
        f"""
x_pairs AS (
  SELECT z[1] AS prev, z[2] AS tag
  FROM (SELECT unnest(list_zip(list_prepend('<START>', tags)[1:len(tags)], tags)) AS z FROM t_train)),
x_grid AS (
  SELECT p.prev, t.tag FROM (SELECT unnest(list_prepend('<START>', {TAG_LIST})) AS prev) p
  CROSS JOIN (SELECT unnest({TAG_LIST}) AS tag) t),
x_counts AS (SELECT prev, tag, count(*) AS n FROM x_pairs GROUP BY ALL)""",
        select=f"""
SELECT prev, tag, round(ln((coalesce(n, 0) + 1) / (coalesce(sum(n) OVER (PARTITION BY prev), 0) + {len(TAGS)})), 6) AS score
FROM x_grid LEFT JOIN x_counts USING (prev, tag)""",
    ),
    "tag_greedy": _with(
        GREEDY,
        "x_pred AS (SELECT ord, md5(string_agg(pred, ',' ORDER BY pos)) AS predicted_md5 FROM g_pred GROUP BY ord)",
        select="""
SELECT ord, coalesce(predicted_md5, md5('')) AS predicted_md5 FROM t_split LEFT JOIN x_pred USING (ord)""",
    ),
    "entity_report": _with(GREEDY, _entity_parts, select=_report_select),
    "word_ngrams": _with(DOCS, _word_terms("d_docs", "x_t", True), select=_stats("x_t")),
    "char_wb_ngrams": _with(DOCS, _wb_terms("d_docs", "x_t"), select=_stats("x_t")),
    "char_ngrams": _with(DOCS, _char_terms("d_docs", "x_t"), select=_stats("x_t")),
    "frequent_words": _with(
        DOCS, _word_terms("d_docs", "x_t", True),
        select=f"SELECT term, tf, df FROM ({_stats('x_t')}) ORDER BY tf DESC, term LIMIT {MAX_FEATURES['word']}",
    ),
    "frequent_chars": _with(
        DOCS, _wb_terms("d_docs", "x_t"),
        select=f"SELECT term, tf, df FROM ({_stats('x_t')}) ORDER BY tf DESC, term LIMIT {MAX_FEATURES['char']}",
    ),
    "refine_batches": _with(
        RAW,
        f"""
x_first AS (
  SELECT *, CASE WHEN length(text) % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS batch FROM c_raw
  QUALIFY row_number() OVER (PARTITION BY task, text ORDER BY ord) = 1),
x_norm AS (SELECT batch, task, ord, {_norm('text')} AS text, label FROM x_first)""",
        select=f"SELECT batch, task, ord, label, md5(text) AS text_md5 FROM x_norm WHERE {VALID} AND text <> ''",
    ),
    "refine_removed": _with(
        CLEAN,
        TAGGED_CLEAN,
        select=f"""
SELECT task, loaded, loaded - deduped AS removed_duplicates, deduped - kept AS removed_invalid, kept
FROM (SELECT task, count(*) AS loaded FROM c_raw GROUP BY task)
JOIN (SELECT task, count(*) AS deduped FROM c_dedup GROUP BY task) USING (task)
JOIN (SELECT task, count(*) AS kept FROM c_clean GROUP BY task) USING (task)
UNION ALL
SELECT '{ENTITIES.name}', loaded, loaded - deduped, deduped - kept, kept
FROM (SELECT count(*) AS loaded FROM t_raw), (SELECT count(*) AS deduped FROM t_dedup), (SELECT count(*) AS kept FROM t_clean)""",
    ),
    "vocab_words": _each_task(
        _vocab("f_train", "word"),
        select="SELECT ix, term, tf, df, round(idf, 6) AS idf FROM v_word",
    ),
    "vocab_chars": _each_task(
        _vocab("f_train", "char"),
        select="SELECT ix, term, tf, df, round(idf, 6) AS idf FROM v_char",
    ),
    "tfidf_fit": _each_task(
        VOCAB, FIT, select="SELECT ord, block, ix, round(weight, 6) AS weight FROM fit"
    ),
    "tfidf_serve": _each_task(
        VOCAB, _serve("f_docs"),
        select="SELECT ord, block, ix, round(weight::DOUBLE, 6) AS weight FROM serve",
    ),
    "vector_entries": _each_task(
        VOCAB, _serve("f_docs"),
        select="""
SELECT ord, ix + CASE block WHEN 'char' THEN (SELECT count(*) FROM v_word) ELSE 0 END AS ix, round(weight::DOUBLE, 6) AS value
FROM serve WHERE weight <> 0""",
    ),
    "zero_vectors": _with(
        _train("confirmation"), _vocab("f_train", "word"),
        "x_docs AS (SELECT ord, text FROM q_raw UNION ALL SELECT -1 - c_custkey, c_name FROM customer)",
        _word_terms("x_docs", "x_t", False),
        select="SELECT ord FROM x_docs WHERE ord NOT IN (SELECT ord FROM x_t JOIN v_word USING (term))",
    ),
    "skew": _each_task(
        VOCAB, FIT, _serve("f_docs"),
        select="""
SELECT ord, block, round(sum(coalesce(f.weight, 0) * coalesce(s.weight::DOUBLE, 0)), 6) AS cosine
FROM fit f FULL JOIN serve s USING (ord, block, ix) GROUP BY ord, block""",
    ),
    "route": _with(
        QUESTIONS,
        f"""
x_score AS (
  SELECT ord, text, (length(text) / {PIVOT_CHARS}) / (1 + length(text) / {PIVOT_CHARS}) AS p FROM q_raw)""",
        select=f"""
SELECT ord,
  CASE {' '.join(f"WHEN regexp_matches(text, '{p}') THEN 'rule'" for p, _ in RULES)}
       WHEN greatest(p, 1 - p) >= {ROUTE_THRESHOLD} THEN 'model' ELSE 'escalate' END AS tier,
  CASE {' '.join(f"WHEN regexp_matches(text, '{p}') THEN '{o}'" for p, o in RULES)}
       WHEN greatest(p, 1 - p) >= {ROUTE_THRESHOLD} THEN CASE WHEN p > 0.5 THEN 'Statement' ELSE 'Question' END
       ELSE 'escalate' END AS decision
FROM x_score""",
    ),
    "route_rules": _with(
        f"""
x_words AS (
  SELECT word, min(item_id)::VARCHAR AS outcome
  FROM (SELECT item_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM benchmark)
  WHERE length(word) >= {RULE_CHARS} GROUP BY word),
x_rules AS (SELECT word, outcome, row_number() OVER (ORDER BY length(word) DESC, word) AS rule FROM x_words),
x_hits AS (
  SELECT ord, min(rule) AS rule
  FROM (SELECT DISTINCT doc_id AS ord, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM documents)
  JOIN x_rules USING (word) GROUP BY ord),
x_docs AS (
  SELECT doc_id AS ord, rule, outcome, length(text) / (length(text) + {PIVOT_CHARS}) >= {ROUTE_THRESHOLD} AS sure
  FROM documents LEFT JOIN x_hits ON ord = doc_id LEFT JOIN x_rules USING (rule))""",
        select="""
SELECT ord, rule, CASE WHEN rule IS NOT NULL THEN 'rule' WHEN sure THEN 'model' ELSE 'escalate' END AS tier,
       CASE WHEN rule IS NOT NULL THEN outcome WHEN sure THEN 'long' ELSE 'escalate' END AS decision
FROM x_docs""",
    ),
    "near_dup_lsh": _with(
        DOCS,
        _near("SELECT ord, text FROM d_docs", CLASSIFICATION.near_dup_threshold),
        select="SELECT ord, cluster FROM l_cluster",
        recursive=True,
    ),
    "near_dup_exact": _with(
        DOCS,
        _near("SELECT ord, text FROM d_docs", CLASSIFICATION.near_dup_threshold),
        select="""
SELECT ord, coalesce(n, 0) AS shingles, coalesce(cluster, ord) AS cluster
FROM d_docs LEFT JOIN (SELECT ord, count(*) AS n FROM l_set GROUP BY ord) USING (ord) LEFT JOIN l_cluster USING (ord)""",
        recursive=True,
    ),
    "dedupe_near": _with(
        DOCS,
        _near("SELECT ord, text FROM d_docs", CLASSIFICATION.near_dup_threshold),
        select="SELECT ord FROM d_docs WHERE ord NOT IN (SELECT ord FROM l_cluster WHERE cluster < ord)",
        recursive=True,
    ),
    "dedupe_near_tags": _with(
        """
n_docs AS (
  SELECT doc_id AS ord, regexp_replace(text, '[ \\t\\r\\n]+', '', 'g') AS text
  FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(toxic, 0) <> 1)""",
        _near("SELECT ord, text FROM n_docs", TAGGING.near_dup_threshold),
        select="SELECT ord FROM n_docs WHERE ord NOT IN (SELECT ord FROM l_cluster WHERE cluster < ord)",
        recursive=True,
    ),
    "diversity": _diversity(
        f"(SELECT * FROM embeddings ORDER BY md5('{SEED_SAMPLE}|' || vec_id), vec_id LIMIT {SAMPLE_SIZE})"
    ),
    "diversity_all": _diversity("embeddings"),
    "refine_all": _with(
        SPLIT, TAGGED_SPLIT,
        select="""
SELECT task, split, label, count(*) AS rows FROM c_split GROUP BY ALL
UNION ALL SELECT 'ner_core_entity', split, NULL, count(*) FROM t_split GROUP BY ALL""",
    ),
}
