"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import jaccard
from rivulet.llm.registry import query, table

SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b USING (s) JOIN sizes m ON m.doc_id = a.doc_id
    JOIN sizes n ON n.doc_id = b.doc_id WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 5 * count(*) >= 4 * (m.n + n.n - count(*))
),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
class AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
number AS (SELECT x, count(*) AS n FROM links GROUP BY x),
sets AS (SELECT doc_id, string_agg(s, chr(1) ORDER BY s) AS everything FROM shingles GROUP BY doc_id),
copies AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY everything) AS copy_id FROM sets)
SELECT d.doc_id, coalesce(least(c.y, d.doc_id), d.doc_id) AS class_id, coalesce(k.copy_id, d.doc_id) AS copy_id, coalesce(n.n, 0) AS n_links
FROM documents d LEFT JOIN class c ON c.x = d.doc_id LEFT JOIN number n ON n.x = d.doc_id LEFT JOIN copies k ON k.doc_id = d.doc_id
"""


@query("op5_jaccard_join", SQL)
def op5_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "class_id", "copy_id", "n_links")
