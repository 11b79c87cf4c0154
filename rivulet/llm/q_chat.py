"""Query of the chat formatter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import chat
from rivulet.llm.registry import query, table

CONFLICT = "\\### Assistant: </turn> ok"

SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(14 + length(role) + length(text) + len(regexp_extract_all(text, '### |</turn>')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""


@query("op3_chat_format", SQL)
def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONFLICT), (-7, 1, "assistant", CONFLICT)], source.schema)
    return chat.read_back(chat.format_turns(source.unionByName(extra)))
