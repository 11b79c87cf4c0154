r"""WARC archives: written as text files by Spark, read back in splits with verified record boundaries.

Writing: a record is one string (header, blank line, payload) and the record terminator is the line
separator, so any store Spark writes to will do. Payloads of at least ``least_bytes`` that are equal
are stored once, with the largest id; the others are revisit records.

Reading: files are split at the record magic, wherever it stands, so a large file is read by many
tasks. They are scanned once: what stands between magics is numbered and stored, as another scan may be
split elsewhere when executors come or go. A magic may lie inside a payload. Every task therefore only emits candidates, each with the
offset that its Content-Length names as its successor's. Pointers are doubled inside each split until
they leave it; what enters the splits is followed from the file's start in the same way; only what is
reached is a record. The payload of a record that is one piece needs no shuffle; pieces of a record
with magic inside are gathered per record.

Defined results: null payloads are empty; a null id is written as empty and read back as null; equal
rows with the largest id are all responses; line ends and blanks in a URL are written as %20. Records
after a damaged one cannot be reached and are not returned. No rows, no records.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.session import materialize, shared_folder

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST_BYTES = 1000


def records(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """key, url, payload (UTF-8), bytes, digest (SHA-1), record_type, refers_to."""
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("key"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"bytes": F.length("payload").cast("bigint"), "digest": F.sha1("payload")})
    repeated = materialize(
        rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.max("key").alias("lead"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and lead is not null").select("digest", "lead"))
    rows = rows.join(repeated, "digest", "left")
    revisit = F.col("lead").isNotNull() & ~F.col("key").eqNullSafe(F.col("lead"))
    return rows.select("key", "url", "payload", "bytes", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("lead")).alias("refers_to"))


def write(rows: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``records`` as WARC files under ``path``."""
    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    def name(key: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    header = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name("key")), line("WARC-Date", date),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                                 line("WARC-Refers-To", name("refers_to")), line("X-Payload-Length", F.col("bytes").cast("string")))).otherwise(""),
        line("Content-Type", "text/html; charset=utf-8"), F.lit("Content-Length: "), F.length(block).cast("string"), F.lit(END))
    value = F.concat(F.encode(header, "UTF-8"), block).cast("string")
    rows.select(value.alias("value")).write.option("lineSep", END).text(path)


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magics, numbered in the order of the only scan and stored: file, block, rid, value."""
    found = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("rid"), "value")
    stored = shared_folder(spark)
    found.write.option("compression", "zstd").parquet(stored)
    return spark.read.schema(found.schema).parquet(stored)


def _with_header(df: DataFrame) -> DataFrame:
    """header (up to the blank line), its bytes, and the declared length; null where there is none."""
    df = df.withColumn("header", F.substring_index("value", END, 1))
    length = F.col("header_bytes") + len(END) <= F.octet_length("value")
    return df.withColumn("header_bytes", F.octet_length("header").cast("bigint")).withColumn(
        "declared", F.when(length, F.expr("try_cast(regexp_extract(header, '(?im)^Content-Length:[ \\\\t]*([0-9]{1,18})[ \\\\t]*(\\\\r|$)', 1) AS bigint)")))


def _candidates(pieces: DataFrame) -> DataFrame:
    """file, block, rid, at (offset of the magic), after (end of the piece), to (declared successor; null if none)."""
    found = materialize(_with_header(pieces.withColumn("bytes", F.octet_length("value").cast("bigint"))).select(
        "file", "block", "rid", "bytes", "header_bytes", "declared"))
    step = F.col("bytes") + len(MAGIC)
    inside = Window.partitionBy("file", "block").orderBy("rid")
    blocks = found.groupBy("file", "block").agg(F.sum(step).alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    placed = found.withColumn("inner", F.sum(step).over(inside) - step).join(blocks, ["file", "block"])
    start = F.col("base") + F.col("inner")  # the piece's first byte, right after the magic
    return materialize(placed.select(
        "file", "block", "rid", (start - len(MAGIC)).alias("at"), (start + F.col("bytes")).alias("after"),
        (start + F.col("header_bytes") + F.col("declared") + 2 * len(END)).alias("to")))


def _next(at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Index of the candidate each pointer names, or -1."""
    spot = np.minimum(np.searchsorted(at, to), len(at) - 1)
    return np.where(at[spot] == to, spot, -1)


def _leave(at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Where the chain from every candidate points when it names none of ``at`` any more, by doubling pointers."""
    to = to.copy()
    while True:
        spot = _next(at, to)
        jump = np.flatnonzero(spot >= 0)
        if not len(jump):
            return to
        to[jump] = to[spot[jump]]


def _reached(at: np.ndarray, to: np.ndarray, start: int) -> np.ndarray:
    """Marks of the candidates on the chain from offset ``start``: the marked set doubles with the pointers."""
    spot = _next(at, to)
    mark = at == start
    while True:
        new = mark.copy()
        new[spot[mark & (spot >= 0)]] = True
        if (new == mark).all():
            return mark
        mark = new
        spot = np.where(spot >= 0, spot[spot], -1) if (spot >= 0).any() else spot


def _odd_pieces(candidates: DataFrame) -> DataFrame:
    """(rid, file, record): pieces that are not a whole record, with the end of the record that holds them."""
    names = ["file", "block", "at", "to"]

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        at, to = pdf["at"].to_numpy(), pdf["to"].fillna(-1).to_numpy(np.int64)
        return pdf.assign(leave=_leave(at, to), first=at[0])[["file", "block", "at", "leave", "first"]]

    exits = materialize(candidates.select(*names).groupBy("file", "block").applyInPandas(
        links, "file string, block bigint, at bigint, leave bigint, first bigint"))
    # only candidates that some chain enters from another split, and the files' starts
    targets = exits.select("file", F.col("leave").alias("at")).unionByName(exits.select("file").distinct().withColumn("at", F.lit(0).cast("bigint"))).distinct()
    nodes = exits.join(targets, ["file", "at"], "left_semi").select("file", "block", "at", "leave")
    splits = exits.select("file", "block", "first").distinct()
    along = nodes.select("file", "block", "at", "leave", F.lit(False).alias("split")).unionByName(
        splits.select("file", "block", F.col("first").alias("at"), F.lit(-1).cast("bigint").alias("leave"), F.lit(True).alias("split")))

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, splits = pdf[~pdf["split"]].sort_values("at"), pdf[pdf["split"]]
        at, leave = nodes["at"].to_numpy(), nodes["leave"].to_numpy()
        mark = _reached(at, leave, 0)
        entries = at[mark]
        last = leave[mark][-1] if mark.any() else 0  # the end of the chain, and of the file if nothing is damaged
        spot = np.searchsorted(entries, splits["at"].to_numpy())
        return splits[["file", "block"]].assign(entry=np.append(entries, last)[spot])

    entries = along.groupBy("file").applyInPandas(enter, "file string, block bigint, entry bigint")

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        at, to, after = pdf["at"].to_numpy(), pdf["to"].fillna(-1).to_numpy(np.int64), pdf["after"].to_numpy()
        entry = int(pdf["entry"].iloc[0])
        mark = _reached(at, to, entry)
        holder = np.maximum.accumulate(np.where(mark, np.arange(len(at)), -1))
        record = np.where(holder >= 0, to[np.maximum(holder, 0)], entry)
        odd = ~(mark & (after == to))
        return pdf.assign(record=record)[odd][["rid", "file", "record"]]

    joined = candidates.join(entries, ["file", "block"])
    return materialize(joined.groupBy("file", "block").applyInPandas(judge, "rid bigint, file string, record bigint"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``: record_type, record_id, refers_to, url, digest (as written),
    declared_bytes of a revisit's payload, and payload."""
    pieces = _pieces(spark, path)
    odd = _odd_pieces(_candidates(pieces))
    pieces = pieces.select("rid", "value").join(odd, "rid", "left")
    whole = pieces.where("file is null").select("value")
    parts = pieces.where("file is not null").groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rid", "value"))), lambda p: p["value"]), MAGIC).alias("value"))
    # a record begins with its own header; what precedes a file's first magic has none
    both = _with_header(whole.unionByName(parts.select("value"))).where("declared is not null and octet_length(value) >= header_bytes + 4 + declared")
    payload = F.expr("substring(cast(value AS binary), cast(header_bytes + 5 AS int), cast(declared AS int))")
    urn = r"^<urn:page:(.*)>$"
    return both.select(
        _field("WARC-Type").alias("record_type"), F.regexp_extract(_field("WARC-Record-ID"), urn, 1).alias("record_id"),
        F.when(_field("WARC-Refers-To") != "", F.regexp_extract(_field("WARC-Refers-To"), urn, 1)).alias("refers_to"),
        _field("WARC-Target-URI").alias("url"), F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        F.expr("try_cast(regexp_extract(header, '(?im)^X-Payload-Length:[ ]*([0-9]+)', 1) AS bigint)").alias("declared_bytes"), payload.alias("payload"))
