"""SQL twins of the registered queries, for an independent check.

Queries whose result depends on the fitted trees or on the partitioning have none.
"""

from __future__ import annotations

from fractions import Fraction

# The share of test rows of the registered queries, as it is stored.
TEST_SHARE = Fraction(0.2)

CUSTOMER_WITH_NULLS = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       nullif(c_mktsegment, 'BUILDING') AS c_mktsegment
FROM customer
"""

NATION_COUNTS = """
SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment <> '{left_out}' GROUP BY c_nationkey
"""

USERS_WITH_NULLS = "(SELECT nullif(user_id, 8) AS user_id, event_type, ts, value FROM events)"

RETURNED = """(
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS state
FROM lineitem)"""

STATES = f"""(
SELECT state AS value, count(*) AS n,
       row_number() OVER (ORDER BY count(*) DESC, state) - 1 AS idx,
       sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS class_weight
FROM {RETURNED} GROUP BY state)"""


def portable_part(key: str) -> str:
    number = f"CAST('0x' || substr(md5(concat_ws('|', '42', {key})), 1, 15) AS BIGINT)"
    return f"CASE WHEN {number} < {2**60 - round(TEST_SHARE * 2**60)} THEN 'train' ELSE 'test' END"


# The primes of the 64-bit xxHash, and its hash of the integer 42
# (the split seed), which is the seed for the key that follows.
PRIMES = (
    11400714785074694791,
    14029467366897019727,
    1609587929392839161,
    9650029242287828579,
    2870177450012600261,
)
SEED_HASH = 18059084824599107352


def wide(value: str | int) -> str:
    return f"CAST({value} AS UHUGEINT)"


def times(value: str, factor: int) -> str:
    return f"({value} * {wide(factor)}) % {wide(2**64)}"


def rotated(value: str, bits: int) -> str:
    return f"({value} * {wide(2**bits)}) % {wide(2**64)} + {value} // {wide(2 ** (64 - bits))}"


def parts(key: str, table: str) -> str:
    """Each whole-number key with its split part, by the 64-bit xxHash of (42, key)."""
    p1, p2, p3, p4, p5 = PRIMES
    start = wide((SEED_HASH + p5 + 8) % 2**64)
    return f"""(
SELECT key,
       {times(wide("key"), p2)} AS a,
       {rotated("a", 31)} AS b,
       xor({start}, {times("b", p1)}) AS c,
       {rotated("c", 27)} AS d,
       ({times("d", p1)} + {wide(p4)}) % {wide(2**64)} AS e,
       {times(f"xor(e, e // {wide(2**33)})", p2)} AS f,
       {times(f"xor(f, f // {wide(2**29)})", p3)} AS g,
       xor(g, g // {wide(2**32)}) AS h,
       (h + {wide(2**63)}) % {wide(2**64)} AS number,
       CASE WHEN number < {wide(2**64 - round(TEST_SHARE * 2**64))} THEN 'train' ELSE 'test' END AS split_part
FROM (SELECT DISTINCT {key} AS key FROM {table}))"""


def ranks(value: str, table: str) -> str:
    """Values by falling frequency, then by text, numbered from 0."""
    return f"""(
SELECT {value} AS value, row_number() OVER (ORDER BY count(*) DESC, {value}) - 1 AS idx
FROM {table} WHERE {value} IS NOT NULL GROUP BY {value})"""


DOCUMENT_ROWS = """(
SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars,
       CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words
FROM documents)"""

LABELLED = f"(SELECT d.*, l.quality FROM {DOCUMENT_ROWS} d JOIN labels l USING (doc_id))"

LANGUAGES = f"""(
SELECT doc_id, quality, CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS language, split_part,
       count(*) OVER () / (2 * count(*) OVER (PARTITION BY quality)) AS class_weight
FROM documents JOIN labels USING (doc_id) JOIN {parts("doc_id", "labels")} ON key = doc_id)"""

# The first tree of one split: each side's mean of -1 and 1 over the training rows.
LEAVES = f"""(
SELECT language, 'plain' AS weights, avg(2 * quality - 1) AS mean
FROM {LANGUAGES} WHERE split_part = 'train' GROUP BY language
UNION ALL
SELECT language, 'weighted', sum(class_weight * (2 * quality - 1)) / sum(class_weight)
FROM {LANGUAGES} WHERE split_part = 'train' GROUP BY language)"""

# The second tree: each side's mean of the loss's slope at the first one's margin.
SECOND_LEAVES = f"""(
SELECT language, weights, any_value(l.mean) + 0.3 * sum(w * slope) / sum(w) AS mean
FROM (
  SELECT language, weights, l.mean, CASE WHEN weights = 'plain' THEN 1 ELSE class_weight END AS w,
         4 * (2 * quality - 1) / (1 + exp(2 * (2 * quality - 1) * l.mean)) AS slope
  FROM {LANGUAGES} JOIN {LEAVES} l USING (language) WHERE split_part = 'train') l
GROUP BY language, weights)"""

RULE = """(
SELECT doc_id, CAST(quality AS DOUBLE) AS label, CAST(n_chars AS DOUBLE) AS score,
       CAST(n_chars > {border} AS DOUBLE) AS prediction
FROM documents JOIN labels USING (doc_id))"""

CONFUSION = f"(SELECT label, prediction, count(*) AS n FROM {RULE.format(border=1500)} GROUP BY ALL)"


def class_report(confusion: str) -> str:
    return f"""(
SELECT class, support, predicted, hits, 2 * hits / (support + predicted) AS f1
FROM (
  SELECT class, CAST(sum(s) AS BIGINT) AS support, CAST(sum(p) AS BIGINT) AS predicted,
         CAST(sum(h) AS BIGINT) AS hits
  FROM (
    SELECT label AS class, n AS s, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS h
    FROM {confusion}
    UNION ALL SELECT prediction, 0, n, 0 FROM {confusion})
  GROUP BY class))"""


def shares(confusion: str) -> str:
    return f"""(
SELECT round(sum(hits) / sum(support), 9) AS accuracy,
       round(sum(f1 * support) / sum(support), 9) AS f1
FROM {class_report(confusion)})"""


def rule_run(border: int) -> str:
    confusion = f"(SELECT label, prediction, count(*) AS n FROM {RULE.format(border=border)} GROUP BY ALL)"
    return f"""
SELECT 'border_{border}' AS run_name, {border} AS border, accuracy, f1, '0,1' AS label_values
FROM {shares(confusion)}"""


RULE_RUNS = " UNION ALL ".join(rule_run(border) for border in (500, 1500, 3000))

NAMED = """(
SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN 'Customer#0'
       WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name
FROM customer)"""

SEEN_NAMES = ranks("c_name", f"(SELECT * FROM {NAMED} WHERE c_custkey % 11 <> 0)")

GAPPY = """(
SELECT l_orderkey, l_linenumber, nullif(l_quantity, 1.0) AS l_quantity,
       CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS l_extendedprice,
       CASE WHEN l_discount BETWEEN 0.005 AND 0.095 THEN l_discount END AS l_discount,
       CASE WHEN l_tax BETWEEN 0.005 AND 0.075 THEN l_tax END AS l_tax
FROM lineitem)"""


def imputed(*columns: str) -> str:
    medians = ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in columns)
    filled = ", ".join(f"coalesce({c}, m_{c}) AS {c}_imputed" for c in columns)
    return f"""
SELECT l_orderkey, l_linenumber, {filled}
FROM {GAPPY} CROSS JOIN (SELECT {medians} FROM {GAPPY})"""


LANG = ranks("lang", "documents")
SOURCE = ranks("source", "documents")

INDEXED = f"""(
SELECT d.*, a.idx AS lang_idx, b.idx AS source_idx
FROM {DOCUMENT_ROWS} d
JOIN {LANG} a ON a.value = d.lang JOIN {SOURCE} b ON b.value = d.source)"""

SEEN_SEGMENTS = ranks("segment", "(SELECT nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)")
SEEN_SOURCES = ranks("source", "(SELECT nullif(source, 'src3') AS source FROM documents)")

SCORED_ORDERS = """
SELECT o_orderkey, o_orderstatus, o_orderpriority,
       CAST(o_totalprice > 200000 AS DOUBLE) AS prediction,
       CASE WHEN o_totalprice > 200000 THEN '0.25,0.75' ELSE '0.75,0.25' END AS probability
FROM orders
"""


def column_count(name: str, role: str, null: str = "false", blank: str = "false", table: str = "lineitem") -> str:
    return f"""
SELECT '{name}' AS column_name, '{role}' AS role, count(*) AS n_rows,
       count(*) FILTER (WHERE {null}) AS n_null, count(*) FILTER (WHERE {blank}) AS n_blank
FROM {table}"""


ORACLES: dict[str, str] = {
    "csv_roundtrip": CUSTOMER_WITH_NULLS,
    "csv_text_scan": CUSTOMER_WITH_NULLS,
    "csv_malformed": NATION_COUNTS.format(left_out="MACHINERY"),
    "csv_malformed_text": NATION_COUNTS.format(left_out="MACHINERY"),
    "csv_malformed_typed": NATION_COUNTS.format(left_out="FURNITURE"),
    "request_rows": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 25""",
    "request_json": CUSTOMER_WITH_NULLS,
    "split_requests": CUSTOMER_WITH_NULLS,
    "csv_two_orders": CUSTOMER_WITH_NULLS,
    "csv_two_orders_text": CUSTOMER_WITH_NULLS,
    "csv_two_orders_stream": """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'missing') AS c_mktsegment, c_acctbal,
       CAST(NULL AS VARCHAR) AS broken FROM customer
UNION ALL SELECT NULL, NULL, NULL, c_custkey || ',' || c_name FROM customer""",
    "requests_malformed": CUSTOMER_WITH_NULLS + "WHERE c_custkey % 7 <> 0",
    "split_requests_malformed": CUSTOMER_WITH_NULLS + "WHERE c_custkey % 7 <> 0",
    "request_document": CUSTOMER_WITH_NULLS + "ORDER BY c_custkey LIMIT 25",
    "normalize_header": """
SELECT c_custkey, c_name, c_acctbal AS "c_acct.bal" FROM customer""",
    "column_profile": " UNION ALL ".join(
        [
            column_count("l_partkey", "numeric"),
            column_count("l_suppkey", "numeric"),
            column_count("l_quantity", "numeric"),
            column_count("l_extendedprice", "numeric"),
            column_count("l_discount", "numeric"),
            column_count("l_tax", "numeric", null="l_tax = 0"),
            column_count("l_linestatus", "categorical", blank="l_linestatus = 'O'"),
            column_count("l_shipdate", "categorical"),
        ]
    ),
    "label_profile": """
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE event_type = 'error') AS n_null_labels,
       count(*) FILTER (WHERE event_type = 'view') AS n_blank_labels,
       count(DISTINCT nullif(event_type, 'error')) AS n_classes
FROM events""",
    "blank_to_missing": """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'signup', 'view') THEN 'missing'
            WHEN event_type = 'click' THEN ' click ' ELSE event_type END AS event_type
FROM events""",
    "numeric_cast": """
SELECT event_id,
       CASE WHEN event_type NOT IN ('error', 'signup')
            THEN try_cast(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
       CAST(event_type = 'view' AS DOUBLE) AS is_view
FROM events""",
    "drop_null_label": """
SELECT event_id, event_type FROM events WHERE nullif(event_type, 'error') IS NOT NULL""",
    "dedup_ids_label": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1""",
    "dedup_null_ids": f"""
SELECT * FROM {USERS_WITH_NULLS}
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC) = 1""",
    "dedup_keep_null_ids": f"""
SELECT * FROM {USERS_WITH_NULLS}
QUALIFY user_id IS NULL
     OR row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, value) = 1""",
    "dedup_prepared": """
SELECT user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "customer_names": f"""
SELECT c_custkey, c_name, CAST(idx AS DOUBLE) AS label
FROM customer JOIN {ranks("c_name", "customer")} r ON r.value = c_name""",
    "label_dictionary": """
SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS INTEGER) AS label,
       o_orderstatus AS value, count(*) AS n
FROM orders GROUP BY o_orderstatus""",
    "label_index": f"""
SELECT o_orderkey, o_orderstatus, CAST(idx AS DOUBLE) AS label
FROM orders JOIN {ranks("o_orderstatus", "orders")} r ON r.value = o_orderstatus""",
    "class_weights": f"SELECT value, n, CAST(class_weight AS DOUBLE) AS class_weight FROM {STATES}",
    "row_weights": f"""
SELECT l_orderkey, l_linenumber, state, CAST(idx AS DOUBLE) AS label,
       CAST(class_weight AS DOUBLE) AS class_weight
FROM {RETURNED} JOIN {STATES} ON value = state""",
    "hash_split": f"""
SELECT o_orderkey, o_totalprice, split_part
FROM orders JOIN {parts("o_orderkey", "orders")} ON key = o_orderkey""",
    "portable_split": f"""
SELECT o_orderkey, o_totalprice, {portable_part("o_orderkey")} AS split_part FROM orders""",
    "split_counts": f"""
SELECT split_part, count(*) AS n
FROM orders JOIN {parts("o_orderkey", "orders")} ON key = o_orderkey GROUP BY split_part""",
    "random_split_cover": "SELECT o_orderkey, o_totalprice FROM orders",
    "category_index": f"""
SELECT doc_id, lang, source, CAST(a.idx AS DOUBLE) AS lang_idx,
       CAST(coalesce(b.idx, (SELECT count(*) FROM {SEEN_SOURCES})) AS DOUBLE) AS source_idx
FROM documents JOIN {LANG} a ON a.value = lang LEFT JOIN {SEEN_SOURCES} b ON b.value = source""",
    "category_index_table": f"""
SELECT c_custkey, n.c_name, c_mktsegment,
       CAST(coalesce(a.idx, (SELECT count(*) FROM {SEEN_NAMES})) AS DOUBLE) AS c_name_idx,
       CAST(b.idx AS DOUBLE) AS c_mktsegment_idx
FROM {NAMED} n LEFT JOIN {SEEN_NAMES} a ON a.value = n.c_name
JOIN {ranks("c_mktsegment", f"(SELECT * FROM {NAMED} WHERE c_custkey % 11 <> 0)")} b ON b.value = c_mktsegment""",
    "one_hot": f"""
SELECT c_custkey, CAST(k + 1 AS INTEGER) AS size, CAST(coalesce(idx, k) AS BIGINT) AS slot,
       CAST(1 AS DOUBLE) AS total
FROM customer CROSS JOIN (SELECT count(*) AS k FROM {SEEN_SEGMENTS})
LEFT JOIN {SEEN_SEGMENTS} s ON s.value = c_mktsegment""",
    "median_surrogates": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, quantile_disc({c}, 0.5) AS surrogate FROM {GAPPY}"
        for c in ("l_quantity", "l_extendedprice")
    ),
    "impute_exact": imputed("l_quantity", "l_extendedprice"),
    "impute_median": imputed("l_discount", "l_tax"),
    "feature_vector": f"""
WITH rows AS (SELECT * FROM {INDEXED}),
     sizes AS (SELECT count(DISTINCT lang) + 1 AS langs, count(DISTINCT source) + 1 AS sources FROM documents)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, value FROM (
  SELECT doc_id, lang_idx AS slot, CAST(1 AS DOUBLE) AS value FROM rows
  UNION ALL SELECT doc_id, langs + source_idx, 1 FROM rows, sizes
  UNION ALL SELECT doc_id, langs + sources, n_chars FROM rows, sizes
  UNION ALL SELECT doc_id, langs + sources + 1, n_words FROM rows, sizes)
WHERE value <> 0""",
    "expected_columns": " UNION ALL ".join(
        column_count(name, role, table="documents")
        for name, role in (
            ("lang", "categorical"),
            ("source", "categorical"),
            ("n_chars", "numeric"),
            ("n_words", "numeric"),
        )
    ),
    "training_rows": f"""
SELECT doc_id, quality, lang, source, n_chars, n_words, CAST(quality AS DOUBLE) AS label,
       CAST(count(*) OVER () / (2 * count(*) OVER (PARTITION BY quality)) AS DOUBLE) AS class_weight,
       split_part
FROM {LABELLED} JOIN {parts("doc_id", "labels")} ON key = doc_id""",
    "score_contract": f"""
SELECT doc_id, CAST(quality AS DOUBLE) AS label, true AS shares_sum_to_one, true AS margins_cancel,
       true AS logistic_share, true AS majority_prediction
FROM labels JOIN documents USING (doc_id)
JOIN {parts("doc_id", "labels")} ON key = doc_id WHERE split_part = 'test'""",
    "batch_contract": """
SELECT doc_id, true AS shares_sum_to_one, true AS majority_prediction, true AS label_text
FROM documents""",
    "stream_equals_batch": """
SELECT doc_id, true AS same_prediction, true AS same_probability FROM documents""",
    "run_dictionaries": """
SELECT 'small' AS run_name, CAST(quality AS INTEGER) AS label, CAST(quality AS VARCHAR) AS value,
       CAST(sum(count(*)) OVER () / (2 * count(*)) AS DOUBLE) AS class_weight
FROM labels JOIN documents USING (doc_id) GROUP BY quality""",
    "stream_features": f"""
SELECT doc_id, CAST(lang_idx AS DOUBLE) AS lang_idx, CAST(source_idx AS DOUBLE) AS source_idx,
       n_chars AS n_chars_imputed, n_words AS n_words_imputed
FROM {INDEXED}""",
    "registered_features": f"""
SELECT doc_id, CAST(lang_idx AS DOUBLE) AS lang_idx, CAST(source_idx AS DOUBLE) AS source_idx
FROM {INDEXED}""",
    "one_tree_scores": f"""
SELECT doc_id, language, weights, round(1 / (1 + exp(-2 * mean)), 9) AS probability
FROM {LANGUAGES} JOIN {LEAVES} USING (language) WHERE split_part = 'train'""",
    "two_tree_scores": f"""
SELECT doc_id, language, weights, round(1 / (1 + exp(-2 * mean)), 9) AS probability
FROM {LANGUAGES} JOIN {SECOND_LEAVES} USING (language) WHERE split_part = 'train'""",
    "refusals": """
WITH l AS (SELECT quality FROM documents JOIN labels USING (doc_id)),
     n AS (SELECT count(*) AS n, count_if(quality = 1) AS ones, count(DISTINCT quality) AS classes FROM l)
SELECT * FROM (
  SELECT unnest(['absent file', 'no label column', 'no rows', 'many classes', 'no features',
                 'missing input', 'test size', 'sample size']) AS attempt,
         true AS refused, CAST(NULL AS BIGINT) AS number
  UNION ALL SELECT 'null labels', ones > 0, CAST(ones AS BIGINT) FROM n
  UNION ALL SELECT 'one class', true, CAST(1 AS BIGINT)
  UNION ALL SELECT 'nothing', n = 0 OR classes <> 2, NULL FROM n)""",
    "training_metrics": f"""
WITH scored AS (
  SELECT mean, quality FROM {LANGUAGES} JOIN {LEAVES} USING (language)
  WHERE split_part = 'test' AND weights = 'plain'),
per AS (SELECT mean, sum(quality) AS p, sum(1 - quality) AS n FROM scored GROUP BY mean),
below AS (SELECT p, n, sum(n) OVER (ORDER BY mean) - n AS lower FROM per)
SELECT 'one_tree' AS run_name,
       (SELECT round(avg(CAST((mean > 0) = (quality = 1) AS INTEGER)), 9) FROM scored) AS accuracy,
       (SELECT f1 FROM {shares("""(
         SELECT CAST(quality AS DOUBLE) AS label, CAST(mean > 0 AS DOUBLE) AS prediction, count(*) AS n
         FROM scored GROUP BY ALL)""")}) AS f1,
       (SELECT round(sum(p * (lower + n / 2)) / (sum(p) * sum(n)), 9) FROM below) AS roc_auc""",
    "grid_to_production": """
SELECT doc_id, true AS is_best, CAST(1 AS BIGINT) AS versions FROM documents""",
    "chosen_features": f"""
WITH rows AS (
  SELECT d.*, split_part FROM {LABELLED} d JOIN {parts("doc_id", "labels")} ON key = doc_id),
known AS (
  SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS idx
  FROM rows WHERE split_part = 'train' GROUP BY source)
SELECT doc_id, CAST(coalesce(idx, (SELECT count(*) FROM known)) AS DOUBLE) AS source_idx,
       n_chars AS n_chars_imputed
FROM rows LEFT JOIN known USING (source) WHERE split_part = 'test'""",
    "confusion": f"SELECT * FROM {CONFUSION}",
    "class_report": f"""
SELECT class, support, predicted, hits, round(f1, 9) AS f1 FROM {class_report(CONFUSION)}""",
    "accuracy_and_f1": f"SELECT * FROM {shares(CONFUSION)}",
    "roc_auc": f"""
WITH per AS (
  SELECT score, sum(label) AS p, sum(1 - label) AS n FROM {RULE.format(border=1500)} GROUP BY score),
below AS (SELECT p, n, sum(n) OVER (ORDER BY score) - n AS lower FROM per)
SELECT round(sum(p * (lower + n / 2)) / (sum(p) * sum(n)), 9) AS roc_auc FROM below""",
    "output_columns": f"SELECT o_orderkey, o_orderstatus, prediction, probability FROM ({SCORED_ORDERS})",
    "output_keep_input": SCORED_ORDERS,
    "prediction_sample": f"""
SELECT o_orderkey, o_orderstatus, prediction, probability FROM ({SCORED_ORDERS})
ORDER BY o_orderkey LIMIT 200""",
    "run_log": RULE_RUNS,
    "best_run": f"""
SELECT run_name, accuracy FROM ({RULE_RUNS}) ORDER BY accuracy DESC, run_name LIMIT 1""",
}
