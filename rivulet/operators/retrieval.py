"""Document reading, chunking, indexing rows and similarity search over chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import WHITE, bind, strip_white, uuid5
from rivulet.operators.similarity import nearest

# Chunk sizes, id namespace, document kinds, similarity threshold, result limits.
CHUNK_SIZE, CHUNK_OVERLAP = 900, 150
NAMESPACE = "5f2d7c0e-3a1b-4c55-9d0e-6f7a8b9c0d1e"
DOCUMENT_KINDS = ("tarifa", "regla", "norma", "contrato", "faq", "datos")
EVIDENCE_THRESHOLD = 0.55
K_LIMITS = (1, 20)
HEADER_END = "\n---\n"


def read_header_documents(files: DataFrame, text: str = "value") -> DataFrame:
    """Parse 'key: value' headers up to the first '---' line; ``problem`` says why a file is rejected."""
    cut = F.locate(HEADER_END, F.col(text))
    header = F.when(cut > 0, F.substring(F.col(text), F.lit(1), cut - 1)).otherwise(F.col(text))
    body = F.when(cut > 0, F.substring(F.col(text), cut + len(HEADER_END), F.length(text))).otherwise(F.lit(""))
    lines = F.filter(F.split(header, r"\r?\n"), lambda s: F.contains(s, F.lit(":")))
    pairs = F.transform(lines, lambda s: F.struct(
        strip_white(F.substring_index(s, ":", 1)).alias("k"), strip_white(F.substring(s, F.locate(":", s) + 1, F.length(s))).alias("v")))

    def value(key: str) -> Column:
        return F.try_element_at(F.transform(F.filter(F.col("_pairs"), lambda p: p["k"] == key), lambda p: p["v"]), F.lit(-1))

    out = files.withColumn("_pairs", pairs).withColumns({
        "title": value("titulo"), "kind": value("tipo"), "source": value("fuente"),
        "url": F.nullif(value("url"), F.lit("")), "body": strip_white(body)})
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(k)) for c, k in (("source", "fuente"), ("kind", "tipo"), ("title", "titulo"))]))
    return out.withColumn("problem", F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))).when(
        ~F.col("kind").isin(*DOCUMENT_KINDS), "unknown kind")).drop("_pairs")


def _pack(parts: Column, limit: int, gap: int, size, join, restart) -> Column:
    """Join consecutive parts while they and ``gap`` characters fit; ``restart(full, part)`` opens the next one."""
    start = F.struct(F.lit("").alias("now"), F.array().cast("array<string>").alias("done"))

    def step(s, part):
        overflow = (s["now"] != "") & (F.length(s["now"]) + size(part) + gap > limit)
        return F.struct(F.when(overflow, restart(s["now"], part)).otherwise(join(s["now"], part)).alias("now"),
                        F.when(overflow, F.array_append(s["done"], s["now"])).otherwise(s["done"]).alias("done"))

    return F.aggregate(parts, start, step, lambda s: F.when(s["now"] != "", F.array_append(s["done"], s["now"])).otherwise(s["done"]))


def chunk_text(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Chunks of about ``size`` characters: whole paragraphs, long ones cut at sentence ends.

    Each chunk after the first opens with the tail of the previous one, at most
    ``overlap`` characters and from a word start.
    """
    paragraphs = F.filter(F.transform(F.split(text, r"(?U)\n\s*\n"), strip_white), lambda p: p != "")

    def sentences(p):
        # each part once as it lies (its length counts), without its right end, and bare
        parts = F.transform(F.split(p, r"(?U)(?<=[.;:])\s+|\n"), lambda s: F.struct(
            F.length(s).alias("n"), F.rtrim(s, F.lit(WHITE)).alias("text"), strip_white(s).alias("bare")))
        return _pack(parts, size, 1, lambda part: part["n"], lambda now, part: F.when(now == "", part["bare"]).when(
            part["text"] == "", now).otherwise(F.concat(now, F.lit(" "), part["text"])), lambda full, part: part["bare"])

    pieces = F.flatten(F.transform(paragraphs, lambda p: F.when(F.length(p) <= size, F.array(p)).otherwise(sentences(p))))

    def reopen(full, part):
        tail = F.when(F.length(full) > overlap, F.substring(full, -overlap, overlap)).otherwise(full)
        word = F.when(F.instr(tail, " ") > 0, F.substring(tail, F.instr(tail, " ") + 1, F.length(tail))).otherwise(tail)
        return F.concat(word, F.lit("\n\n"), part) if overlap else part

    def follow(now, part):
        return F.when(now == "", part).otherwise(F.concat(now, F.lit("\n\n"), part))

    return bind(pieces, lambda p: _pack(p, size, 2, F.length, follow, reopen))


def document_id(source: Column, title: Column) -> Column:
    return uuid5(NAMESPACE, F.concat(source, F.lit("::"), title))


def chunk_id(document: Column, order: Column) -> Column:
    return uuid5(NAMESPACE, F.concat(document, F.lit("::"), order.cast("string")))


def build_corpus(sources: list[DataFrame], size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Union of document sources (title, kind, source, url, text) with their chunks; documents without chunks drop out."""
    docs = reduce(DataFrame.unionByName, sources).withColumn("chunks", chunk_text(F.col("text"), size, overlap))
    return docs.where(F.size("chunks") > 0)


def index_rows(corpus: DataFrame) -> DataFrame:
    """One row per chunk: ids, order, content and metadata map."""
    docs = corpus.withColumn("document_id", document_id(F.col("source"), F.col("title")))
    rows = docs.select("document_id", "title", "kind", "source", "url", F.posexplode("chunks").alias("position", "content"))
    return rows.select(
        chunk_id(F.col("document_id"), F.col("position")).alias("chunk_id"), "document_id", "title", "position", "content",
        F.create_map(F.lit("fuente"), "source", F.lit("tipo"), "kind", F.lit("caracteres"), F.length("content").cast("string")).alias("metadata"))


def chunk_sizes(corpus: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks and characters per document."""
    lengths = F.transform("chunks", lambda c: F.length(c))
    return corpus.select(*keys, F.size("chunks").alias("n_chunks"), F.aggregate(lengths, F.lit(0), lambda s, x: s + x).alias("n_characters"),
                         F.array_max(lengths).alias("largest"))


def search_chunks(queries: DataFrame, chunks: DataFrame, documents: DataFrame, k: int, *, qid: str, bid: str, document: str,
                  vector: str, **blocks) -> DataFrame:
    """k most similar chunks of every query with document title; unit vectors on both sides."""
    k = max(K_LIMITS[0], min(K_LIMITS[1], k))
    found = nearest(queries, chunks, k, qid=qid, bid=bid, columns=[vector], **blocks)
    return found.join(chunks.select(bid, document), bid).join(documents, document)


def evidence_filter(queries: DataFrame, found: DataFrame, qid: str, title: str, threshold: float = EVIDENCE_THRESHOLD) -> DataFrame:
    """Per query: whether a chunk reaches the threshold, how many do, and their titles in order without repeats (at most k)."""
    useful = found.where(F.col("similarity") >= threshold).groupBy(qid).agg(
        F.array_sort(F.collect_list(F.struct("place", title))).alias("_t"))
    rows = queries.select(qid).join(useful, qid, "left")
    return rows.select(qid, F.col("_t").isNotNull().alias("evidence"), F.coalesce(F.size("_t"), F.lit(0)).alias("n_chunks"),
                       F.array_distinct(F.transform(F.coalesce(F.col("_t"), F.array().cast(useful.schema["_t"].dataType)),
                                                    lambda r: r[title])).alias("titles"))


def valid_citations(cited: Column, n: Column) -> Column:
    """Cited numbers inside 1..n; an empty result means the answer cites nothing valid."""
    return F.filter(cited, lambda i: (i >= 1) & (i <= n))
