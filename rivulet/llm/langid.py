"""Language identification by averaged hashed subword embeddings.

A word's vector is the mean of the vectors of its character n-grams (hashed to buckets, word ends
marked), a text's vector is the mean over its words, and a linear softmax gives the languages. Vectors
and weights are trained together by stochastic gradient descent in numpy on a bounded sample of
labelled texts, cut into passages. A part of the sample is kept back: it sets the temperature, which
calibrates the confidence, and both bounds of the rejection:

* the least confidence whose accepted texts are right in ``ACCURACY`` of the cases;
* the least *familiarity* (the median over a text's words of the share of n-grams seen in the fit, so that names
  and keys do not count) with which at most ``FOREIGN`` of what is accepted is foreign. Foreign are, in even weight to
  the kept-back texts, the same texts judged by the n-grams of all *other* languages, and the same texts
  with their letters shuffled.

Neither bound may reject more than 1 - ``KEEP`` of the kept-back texts; as the least of n such texts would still
lose one document in n, a bound also stays ``MARGIN`` of the way from it to even chances or to the foreign median.

For prediction the vectors are folded with the softmax weights into one table (buckets x languages),
whose size is fixed, so it is broadcast; every text is scored whole, in one pass without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0, not accepted; so is
every text if no labelled text could be learned from. Repeated rows and ids give repeated results.
Only the named columns are read; others of any name pass through. Every language with a text that holds a
letter is learned; more than ``MAX_LANGUAGES`` labels, which are no languages any more, raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.textblocks import LETTERS, bound_batches, flat_bytes, lean, mix, unused, words_of
from rivulet.session import materialize, share

BITS = 17
GRAMS = (2, 3, 4, 5)
DIMENSIONS = 16
PASSAGE_WORDS = 40
#: Bounds of the fitting sample: texts per language, texts in all (but ``LEAST_TEXTS`` per language always),
#: characters of a text's passage. The table of vectors holds 2 ** BITS x languages numbers.
PER_LANGUAGE, ALL_TEXTS, LEAST_TEXTS, PASSAGE_CHARS, MAX_LANGUAGES = 250, 64_000, 10, 20_000, 1_024
#: Rejection: share right among accepted texts, share of foreign texts among accepted ones, kept-back texts accepted, margin.
ACCURACY, FOREIGN, KEEP, MARGIN = 0.99, 0.1, 0.999, 1 / 3


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # buckets x languages: logits of one n-gram
    bias: np.ndarray
    temperature: float
    threshold: float
    seen: np.ndarray  # per bucket, whether the fit saw an n-gram of it
    familiar: float  # least familiarity of an accepted text
    kept: float = 1.0  # share of the kept-back texts accepted
    foreign_rejected: float = 0.0  # share of their foreign counterparts rejected


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of every word, and how many each word has (words follow each other)."""
    data, offsets = flat_bytes(words)
    n = len(words)
    sizes = np.diff(offsets) + 2
    starts = np.concatenate([[0], np.cumsum(sizes)])
    wide = np.full(int(starts[-1]), 1, np.uint64)  # 1 marks both ends of a word
    body = np.ones(len(wide), bool)
    body[starts[:-1]] = False
    body[starts[1:] - 1] = False
    wide[body] = data
    word = np.repeat(np.arange(n), sizes)
    left = np.repeat(starts[1:], sizes) - np.arange(len(wide))  # bytes up to the word's end
    found, owner, rolling = [], [], np.zeros(len(wide), np.uint64)
    for k in range(1, max(GRAMS) + 1):
        m = len(wide) - k + 1
        if m <= 0:
            break
        rolling = rolling[:m] * np.uint64(0x100000001B3) + wide[k - 1:]
        if k in GRAMS:
            fits = left[:m] >= k
            found.append((mix(rolling[fits] + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64))
            owner.append(word[:m][fits])
    bucket, owner = np.concatenate(found or [np.empty(0, np.int64)]), np.concatenate(owner or [np.empty(0, np.int64)])
    return bucket, owner


def _familiarity(seen: np.ndarray, bucket: np.ndarray, owner: np.ndarray, token: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Lower median over a text's words of the share of seen n-grams; the greater of two words, 1 for one, 0 for none."""
    n = int(token.max()) + 1 if len(token) else 0
    word = np.bincount(owner, weights=seen[bucket], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
    count, share = np.bincount(text, minlength=texts), word[token]
    out = np.where(count > 0, 1.0, 0.0)
    if len(text):  # the words of a text follow each other
        begin = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        at, order = text[begin], np.lexsort((share, text))
        n = count[at]
        out[at] = np.where(n > 1, share[order][begin + np.where(n > 2, (n - 1) // 2, n // 2)], 1.0)
    return out


def _logits(model: LanguageModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Mean logits of every text, and its familiarity."""
    words, token, text = words_of(texts, LETTERS)
    bucket, owner = grams(words)
    n, languages = len(words), len(model.languages)
    per_word = np.bincount(owner, minlength=n)
    count = np.bincount(text, minlength=len(texts))
    out = np.empty((len(texts), languages))
    for j in range(languages):
        word = np.bincount(owner, weights=model.table[bucket, j], minlength=n) / np.maximum(per_word, 1)
        out[:, j] = np.bincount(text, weights=word[token], minlength=len(texts)) / np.maximum(count, 1) + model.bias[j]
    return out, _familiarity(model.seen, bucket, owner, token, text, len(texts))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], *, epochs: int = 4, rate: float = 0.3, seed: int = 11) -> LanguageModel:
    """Fit on labelled texts; every fifth text of a language is kept back to calibrate."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0, 1.0, np.zeros(1 << BITS, bool), 1.0)
    rng = np.random.default_rng(seed)
    number = {x: i for i, x in enumerate(languages)}
    target = np.array([number[x] for x in labels])
    turn = np.empty(len(texts), np.int64)  # place of a text among those of its language
    by_language = np.argsort(target, kind="stable")
    turn[by_language] = np.arange(len(texts)) - np.searchsorted(target[by_language], target[by_language])
    calibrate = turn % 5 == 4
    order = pa.array([t for t, c in zip(texts, calibrate) if not c], pa.large_string())
    words, token, text = words_of(order, LETTERS)
    bucket, owner = grams(words)
    by_word = np.argsort(owner, kind="stable")
    bucket = bucket[by_word]
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])
    # passages of consecutive words of one text
    cut = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1])])) if len(text) else np.empty(0, np.int64)
    place = np.arange(len(text)) - np.repeat(cut, np.diff(np.append(cut, len(text))))
    passage = np.cumsum((place % PASSAGE_WORDS == 0).astype(np.int64)) - 1
    n_passages = int(passage[-1]) + 1 if len(passage) else 0
    at = np.searchsorted(passage, np.arange(n_passages + 1))
    goal = target[~calibrate][text[at[:-1]]] if n_passages else np.empty(0, np.int64)

    vectors = (rng.random((1 << BITS, DIMENSIONS), dtype=np.float32) - 0.5) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    steps, done = max(1, epochs * n_passages), 0
    for _ in range(epochs):
        for i in rng.permutation(n_passages):
            w = token[at[i]:at[i + 1]]
            sizes = first[w + 1] - first[w]
            spots = np.repeat(first[w] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            ids = bucket[spots]
            share = np.repeat(1.0 / (sizes * len(w)), sizes).astype(np.float32)
            hidden = share @ vectors[ids]
            logits = hidden @ weights
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[goal[i]] -= 1
            step = rate * (1 - done / steps)
            back = weights @ p
            weights -= step * np.outer(hidden, p)
            np.add.at(vectors, ids, (-step * len(w)) * share[:, None] * back[None, :])
            done += 1
    spread = np.zeros(1 << BITS, np.int64)  # languages that have an n-gram in a bucket
    own = []
    for j in range(len(languages)):
        mine = np.zeros(len(words), bool)
        mine[token[target[~calibrate][text] == j]] = True
        own.append(np.unique(bucket[np.repeat(mine, np.diff(first))]))
        spread[own[-1]] += 1
    vectors[spread == 0] = 0  # n-grams that say nothing, so that unknown scripts end near even chances
    model = LanguageModel(languages, (vectors @ weights).astype(np.float32), np.zeros(len(languages)), 1.0, 0.0, spread > 0, 0.0)
    held = [t for t, c in zip(texts, calibrate) if c]
    if not held:
        return model
    logits, familiar = _logits(model, pa.array(held, pa.large_string()))
    goal = target[calibrate]
    grid = np.geomspace(0.5, 20, 60)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(goal)), goal], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    sure, lost = p.max(axis=1), int((1 - KEEP) * len(held))
    chance = 1 / len(languages)
    least = float(np.sort(sure)[lost])
    threshold = min(least_bound(sure, p.argmax(axis=1) == goal, ACCURACY), least - MARGIN * (least - chance))
    foreign = [_foreign(held, goal, own, spread), _shuffled(held, spread > 0, rng)]
    foreign = np.concatenate(foreign if len(languages) > 1 else foreign[1:])
    weight = np.concatenate([np.full(len(held), 1 / len(held)), np.full(len(foreign), 1 / len(foreign))])
    right = np.concatenate([np.ones(len(held), bool), np.zeros(len(foreign), bool)])
    least = float(np.sort(familiar)[lost])
    bound = min(least - MARGIN * max(0.0, least - float(np.median(foreign))), least_bound(np.concatenate([familiar, foreign]), right, 1 - FOREIGN, weight))
    kept = (familiar >= bound) & (sure >= threshold)
    return replace(model, temperature=temperature, threshold=threshold, familiar=bound, kept=float(kept.mean()), foreign_rejected=float((foreign < bound).mean()))


def least_bound(value: np.ndarray, right: np.ndarray, share: float, weight: np.ndarray | None = None) -> float:
    """The least of ``value`` from which on ``share`` of the weight is right; beyond all of them if there is none."""
    weight = np.ones(len(value)) if weight is None else weight
    order = np.argsort(-value, kind="stable")
    good = np.cumsum((weight * right)[order]) / np.cumsum(weight[order])
    last = np.append(value[order][1:] != value[order][:-1], True)  # equal values are accepted together
    fits = np.flatnonzero(last & (good >= share))
    if not len(fits):
        return float(value.max()) + 1.0
    return 0.0 if fits[-1] == len(value) - 1 else float(value[order][fits[-1]])


def _foreign(texts: list[str], goal: np.ndarray, own: list[np.ndarray], spread: np.ndarray) -> np.ndarray:
    """Familiarity of every text to the n-grams of the languages that are not its own."""
    out = np.zeros(len(texts))
    for j in np.unique(goal):
        others = spread.copy()
        others[own[j]] -= 1
        at = np.flatnonzero(goal == j)
        words, token, text = words_of(pa.array([texts[i] for i in at], pa.large_string()), LETTERS)
        out[at] = _familiarity(others > 0, *grams(words), token, text, len(at))
    return out


def _shuffled(texts: list[str], seen: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Familiarity of the texts with their letters in random order, words as long as before."""
    mixed = []
    for t in texts:
        codes = np.array(list(t))
        letters = np.array([c.isalpha() for c in t])
        codes[letters] = rng.permutation(codes[letters])
        mixed.append("".join(codes))
    words, token, text = words_of(pa.array(mixed, pa.large_string()), LETTERS)
    return _familiarity(seen, *grams(words), token, text, len(texts))


def fitting_sample(documents: DataFrame, text: str, lang: str, key: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(text, lang): passages of about ``per_language`` different labelled texts of every language, chosen by a hash,
    copies once, and of fewer where there are so many languages that ``ALL_TEXTS`` would be exceeded. A passage lies at a place given
    by the hash, or begins with the first letter where there is none."""
    named = documents.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(key, text).alias("hash"))
    named = named.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = materialize(named.groupBy("lang").agg(F.approx_count_distinct("hash").alias("count")))  # its size is known when it is joined
    languages = counts.count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} labels of languages, more than {MAX_LANGUAGES}")
    each = min(per_language, max(LEAST_TEXTS, ALL_TEXTS // max(1, languages)))
    chosen = named.join(counts, "lang").where(F.pmod("hash", F.lit(1_000_000)) <= F.lit(each) * 1_000_000 / F.col("count"))
    start = 1 + F.pmod("hash", F.greatest(F.lit(1), F.length("text") - PASSAGE_CHARS + 1)).cast("int")
    passage = F.substring("text", start, F.lit(PASSAGE_CHARS))
    passage = F.when(passage.rlike(r"\p{L}"), passage).otherwise(F.substring("text", F.regexp_instr("text", F.lit(r"(\p{L})")), F.lit(PASSAGE_CHARS)))
    once = chosen.select(passage.alias("text"), "lang", "hash").groupBy("lang", "hash").agg(F.min("text").alias("text"))
    ranked = once.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash")))
    return ranked.where(F.col("place") <= 2 * each).select("text", "lang")


def fit(documents: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> LanguageModel:
    """Train on a bounded sample of ``documents``."""
    rows = fitting_sample(documents, text, lang, key).collect()
    rows = sorted((r["text"], r["lang"]) for r in rows)
    rng = np.random.default_rng(3)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    return train([r[0] for r in rows], [r[1] for r in rows], **options)


def predict(documents: DataFrame, model: LanguageModel, *, text: str = "text", prefix: str = "lang_") -> DataFrame:
    """``documents`` with prefix + pred, score and accepted; columns of these names are replaced."""
    spark = documents.sparkSession
    bound_batches(spark)
    shared = share(spark, model)
    names = [f"{prefix}{x}" for x in ("pred", "score", "accepted")]
    rows = documents.drop(*names)
    kept, has = rows.schema.fields, unused(rows.columns, "letters")
    source = rows.withColumn(has, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            letters = batch.column(has).to_numpy(zero_copy_only=False).astype(bool)
            pred, score, familiar = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            if m.languages and batch.num_rows:
                logits, familiar = _logits(m, batch.column(text))
                p = _softmax(logits / m.temperature)
                best = p.argmax(axis=1)
                pred[letters] = np.array(m.languages, object)[best[letters]]
                score[letters] = p.max(axis=1)[letters]
            accepted = letters & (score >= m.threshold) & (familiar >= m.familiar) & bool(m.languages)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(pred, pa.string()), pa.array(score), pa.array(accepted)], [*[f.name for f in kept], *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return source.mapInArrow(lean(run), f"{fields}, {names[0]} string, {names[1]} double, {names[2]} boolean")
