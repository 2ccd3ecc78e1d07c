"""The queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query and the module that holds it.
_MODULES = {
    "op1_language_id": "language_id",
    "op2_decontamination": "decontaminate",
    "op3_packing": "packing",
    "op4_token_counts": "token_counts",
    "op5_toxicity": "toxicity",
    "op6_sharding": "sharding",
    "op7_html_extraction": "html_extraction",
    "op8_quality_rules": "quality_rules",
    "op9_lm_scoring": "katz",
    "op10_jaccard_join": "lsh_forest",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"featherline.llm.{m}"), name) for name, m in _MODULES.items()}


#: Decontamination by comparing every window with every other.
OP2 = r"""
WITH b AS (SELECT item_id, w FROM (SELECT item_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT item_id, least(10, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS g FROM b),
sizes AS (SELECT DISTINCT n FROM bw),
d AS (SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM documents),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM d, sizes WHERE len(w) >= n),
m AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2}
