r"""Secret scanning with character Markov models, in DataFrame functions only.

Fixed patterns find assigned values, access keys and long hexadecimal runs. Beyond them, every run of
16 or more token characters is scored by the log-likelihood ratio of two first-order character Markov
models, one of random strings and one of ordinary identifiers, trained from labelled samples; runs
whose ratio exceeds the prior odds of an ordinary run are spans of kind ``markov``. A model is one
integer per pair of token symbols (thousandths of a nat), so its size is fixed by the alphabet.

Spans are code points, end exclusive. Running totals over the matches of a text are taken in blocks,
so a text with very many matches stays linear for practical purposes; nothing is shuffled.

Defined results: a null text is empty; an empty text has no spans; rows are scored one by one, so
repeated rows give repeated results; of ``documents`` only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of spans and their patterns, in order.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the same spans as AKIA[A-Z0-9]+ of 16 or more characters
HEX = r"[0-9a-f]{32,}"  # the same spans as [0-9a-f]+ of 32 or more characters
KINDS = ("assign", "access", "hex", "markov")

RUN = "[A-Za-z0-9_+/-]"
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/-"
SIZE = len(SYMBOLS) + 1  # 0 stands for the start of a run
BLOCK = 256
SPAN = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratio (random over ordinary) of every pair of symbols, in thousandths."""

    weights: tuple[int, ...]

    def literal(self) -> Column:
        return F.expr(f"array({','.join(map(str, self.weights))})")


def _symbols(run: Column) -> Column:
    """Symbol numbers of a run, with the start mark in front."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(run, ""), lambda c: F.instr(F.lit(SYMBOLS), c)))


def _pairs(run: Column) -> Column:
    s = _symbols(run)
    return F.zip_with(F.slice(s, 1, F.length(run)), F.slice(s, 2, F.length(run)), lambda a, b: a * SIZE + b)


def train(samples: DataFrame, value: str, label: str, smoothing: float = 30.0) -> MarkovModel:
    """Models from labelled strings of run characters (label 1: random, 0: ordinary; others are ignored).

    The transitions are counted on the executors; SIZE * SIZE counts per label reach the driver.
    """
    counts = (
        samples.where(F.col(label).isin(0, 1) & F.col(value).rlike(f"^{RUN}+$"))
        .select(F.col(label).alias("label"), F.explode(_pairs(F.col(value))).alias("pair"))
        .groupBy("label", "pair").count().collect())
    table = {(r["label"], r["pair"]): r["count"] for r in counts}
    def logs(kind: int) -> list[float]:
        """Log probability of every pair; a rare first symbol leans on how often the second one occurs at all."""
        single = [sum(table.get((kind, a * SIZE + b), 0) for a in range(SIZE)) + 0.5 for b in range(1, SIZE)]
        share = [0.0] + [x / sum(single) for x in single]
        out = []
        for a in range(SIZE):
            row = [table.get((kind, a * SIZE + b), 0) + smoothing * share[b] for b in range(SIZE)]
            out += [log(x / sum(row)) if x else 0.0 for x in row]
        return out

    return MarkovModel(tuple(round(1000 * (r - o)) for r, o in zip(logs(1), logs(0))))


def labelled_samples(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(value, label) from texts: values the fixed patterns find and digests in common encodings are
    random strings, all other runs of four or more characters are ordinary."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    seed = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    digest = F.sha2(seed, 256)
    encoded = F.array(
        digest, F.substring(digest, 1, 32), F.regexp_replace(F.base64(F.unhex(digest)), "=+$", ""),
        F.upper(F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(seed, F.lit(b"u")), 256))), "[^A-Za-z0-9]", "")))
    found = F.filter(F.concat(F.regexp_extract_all(t, F.lit(ASSIGN), 2), F.regexp_extract_all(t, F.lit(ACCESS), 0),
                              F.regexp_extract_all(t, F.lit(HEX), 0)), lambda v: (F.length(v) >= 16) & v.rlike("[0-9]"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, ASSIGN, " "), ACCESS, " "), HEX, " ")
    random = texts.select(F.explode(F.concat(encoded, found)).alias("value"), F.lit(1).alias("label"))
    ordinary = texts.select(F.explode(F.regexp_extract_all(rest, F.lit(RUN + "{4,}"), 0)).alias("value"), F.lit(0).alias("label"))
    return random.unionByName(ordinary)


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows (never over twice as many), chosen by a hash of the key; for fitting only."""
    n = max(1, df.count())
    share = min(1.0, rows / n)
    return df.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1)).limit(2 * rows)


def _running(steps: Column) -> Column:
    """Sums of all steps before each one."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(steps, b * BLOCK + 1, BLOCK))

    def scan(xs: Column, start: Column) -> Column:
        sums = F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return F.slice(sums, 1, F.size(xs))

    totals = F.transform(blocks, lambda xs: F.aggregate(xs, F.lit(0), lambda acc, x: acc + x))
    return F.flatten(F.zip_with(blocks, scan(totals, F.lit(0)), scan))


def _matches(df: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Columns name_hits (matched strings), name_gaps (what lies around them), name_at (their starts)."""
    has = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumns({
        f"{name}_hits": F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        f"{name}_gaps": F.when(has, F.split(text, pattern, -1)).otherwise(none)})
    hits, gaps = F.col(f"{name}_hits"), F.slice(F.col(f"{name}_gaps"), 1, F.size(f"{name}_hits"))
    before = _running(F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h)))
    at = F.zip_with(before, gaps, lambda b, g: b + F.length(g))
    return df.withColumn(f"{name}_at", F.when(F.size(hits) > 0, at).otherwise(F.array().cast("array<int>")))


def _spans(name: str, kind: int, keep=None) -> Column:
    spans = F.zip_with(f"{name}_at", f"{name}_hits", lambda a, h: F.struct(
        a.cast("int").alias("start"), F.lit(kind).alias("kind"), (a + F.length(h)).cast("int").alias("end"), h.alias("hit")))
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["hit"]))
    return F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])).cast(SPAN)


def _is_assigned(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 8


def _masked(text: str, name: str, keep) -> Column:
    """The text with the kept matches of ``name`` blanked out, of the same length."""
    def blank(gap: Column, hit: Column) -> Column:
        return F.concat(gap, F.when(hit.isNull(), "").when(keep(hit), F.repeat(F.lit(" "), F.length(hit))).otherwise(hit))

    pieces = F.zip_with(f"{name}_gaps", f"{name}_hits", blank)
    return F.when(F.size(f"{name}_hits") > 0, F.array_join(pieces, "")).otherwise(F.col(text))


def scan(documents: DataFrame, model: MarkovModel, *, key: str = "doc_id", text: str = "text", min_length: int = 16,
         log_odds: int = 14_000) -> DataFrame:
    """(key, text, base, spans): spans of the fixed patterns, and all spans, ordered by start and kind.

    A run of ``min_length`` or more characters is added where its ratio reaches ``log_odds``
    (thousandths of a nat) and no fixed pattern covers any of it.
    """
    df = documents.select(F.struct(F.col(key).alias("key")).alias("_rest_of_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return _scan(df, model, min_length, log_odds).select(
        F.col("_rest_of_row.key").alias(key), F.col("_text").alias(text), "base", "spans")


def redacted(documents: DataFrame, model: MarkovModel, *, text: str = "text", mark: str = "<SECRET>", min_length: int = 16,
             log_odds: int = 14_000) -> DataFrame:
    """``documents`` with every span replaced by ``mark``; all rows and columns stay, a null text stays null."""
    names = documents.columns
    df = documents.select(F.struct(*names).alias("_rest_of_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    safe = redact(_scan(df, model, min_length, log_odds), "_text", "spans", mark)
    whole = [F.when(F.col(f"_rest_of_row.{c}").isNotNull(), F.col("_text")).alias(c) if c == text else F.col(f"_rest_of_row.{c}").alias(c) for c in names]
    return safe.select(*whole)


def _scan(df: DataFrame, model: MarkovModel, min_length: int, log_odds: int) -> DataFrame:
    """_rest_of_row, _text, base, spans from _rest_of_row and _text."""
    df = _matches(_matches(_matches(df, "_text", "a", ASSIGN), "_text", "k", ACCESS), "_text", "x", HEX)
    df = df.select(
        "_rest_of_row", "_text", _masked("_text", "a", _is_assigned).alias("_rest"),
        F.array_sort(F.concat(_spans("a", 0, _is_assigned), _spans("k", 1), _spans("x", 2))).alias("base"))
    weights = model.literal()

    def unlikely(run: Column) -> Column:  # access keys and hexadecimal runs lie inside one run
        score = F.aggregate(_pairs(run), F.lit(0), lambda acc, p: acc + F.element_at(weights, p + 1))
        return ~run.rlike(f"{ACCESS}|{HEX}") & (score >= log_odds)

    df = _matches(df, "_rest", "m", f"{RUN}{{{min_length},}}")
    more = _spans("m", 3, unlikely)
    spans = F.when(F.size("m_hits") > 0, F.array_sort(F.concat("base", more))).otherwise(F.col("base"))
    return df.select("_rest_of_row", "_text", "base", spans.alias("spans"))


def describe(spans: str) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def redact(found: DataFrame, text: str = "text", spans: str = "spans", mark: str = "<SECRET>") -> DataFrame:
    """``found`` with every span of the text replaced by ``mark``; overlapping spans are replaced as one."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        new = F.when(s["start"] >= acc["at"], F.array(
            F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["parts"], new).alias("parts"))

    def end(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substring(F.col(text), acc["at"] + 1, F.length(text)))

    return found.withColumn(text, F.when(F.size(spans) > 0, F.aggregate(spans, start, step, end)).otherwise(F.col(text)))
