"""Query of the WARC writer and reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import warc
from rivulet.llm.registry import query, table
from rivulet.session import shared_folder

SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest, max(page_id) OVER (PARTITION BY body) AS lead FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < lead THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < lead THEN lead END AS refers_to
FROM q
"""


@query("op2_warc", SQL)
def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    kind = pages.schema["page_id"].dataType
    path = f"{shared_folder(spark)}/archive"
    warc.write(warc.records(pages), path)
    revisit = F.col("record_type") == "revisit"
    return warc.read(spark, path).select(
        F.col("record_id").try_cast(kind).alias("page_id"),
        F.when(revisit, F.col("declared_bytes")).otherwise(F.length("payload").cast("bigint")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
        "record_type", F.col("refers_to").try_cast(kind).alias("refers_to"))
