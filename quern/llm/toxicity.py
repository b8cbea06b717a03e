"""Toxicity by maximum-scoring segments of token log-odds.

Fit. Tokens are words and, for inflected forms, the first 4 to 7 bytes of words. A token's log-odds
between toxic and other labelled documents have a Dirichlet prior in either class, PRIOR for each token and shared out as the
classes are, so that a token which neither has seen has odds of zero. They are drawn towards zero by CAUTION standard
deviations, so that few documents tell little. Counted are documents; for tokens that speak for toxicity, places where the same words stand
around a token count once, lest copies of a document make its rare words look telling, and a prefix
counts only if it begins LEAST_FORMS words. Every word weighs its own log-odds, or those of its likeliest stem if they are
higher, less DRIFT, so that a random text's score falls. A word that comes again in a text tells less each time.

Search. One linear pass over a text's words finds all maximal segments: those whose score can't be
made higher by growing or cutting them. The passages are those that are expected in text that isn't toxic at most
SIGNIFICANT times.

Calibration. In text that isn't toxic, maximal scores follow an extreme-value law: a segment of score
s in n words is expected n * exp(-rate * s) times, where the rate solves E exp(rate * weight) = 1 over the words of
documents that aren't toxic. A document's segments are combined by the law for the sum of the r best,
and the best r is taken. The document's score is a logistic function of the logarithm of one more than minus the logarithm of that
expected number. The rate and the function are fitted to the documents of each of PARTS parts as models see them in which
their words weren't counted.

Scale. The model is fitted on at most MOST_LABELLED documents with each label, and is one table of 64-bit
hashes. Scoring is one narrow stage over whole texts. Words are hashed, looked up and weighed by
numpy; only words of positive weight (few in any text) are seen by Python.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import by_place, held_out, in_slices, pick, position, small_batches, stored, table
from .labelled import calibrated, sample_of, texts_of
from .words import NO_LETTER, Words, mixed

#: Documents with each label that the model is fitted on, at most.
MOST_LABELLED = 4000
#: Parts of them: the law and the score's function are fitted to each part as a model of all other parts sees it.
PARTS = 4
PREFIXES = (7, 6, 5, 4)
PRIOR = 1.0
CAUTION = 2.0
DRIFT = 0.5
THRESHOLD = 0.7
SIGNIFICANT = 0.1
#: Different words that a prefix begins, at least: an inflected stem has many forms.
LEAST_FORMS = 5
#: The held-out fold of labels: crc32(doc_id) mod FOLDS = FOLD.
FOLDS, FOLD = 3, 1


@cache
def _resized() -> re.Pattern:
    """Characters that have more or fewer bytes in lower case."""
    sizes = ((c, c.lower()) for c in map(chr, range(0x80, 0x110000)) if not 0xD800 <= ord(c) < 0xE000)
    return re.compile("[%s]" % "".join(re.escape(c) for c, low in sizes if c != low and len(c.encode()) != len(low.encode())))


def lowered(texts: list[str | None]) -> list[bytes]:
    """UTF-8 of texts in lower case, byte for byte where it was; characters that would change their size stay as they are."""
    out = []
    for x in texts:
        x = x or ""
        if not x.isascii() and (odd := _resized()).search(x):
            x = "".join(c if odd.match(c) else c.lower() for c in x)
        out.append((x if "Σ" not in x else x.replace("Σ", "σ")).lower().encode())
    return out


@dataclass
class Odds:
    """Sorted token hashes and their log-odds; the rate of the extreme-value law."""

    hashes: np.ndarray
    weights: np.ndarray
    rate: float
    #: A text's score is sigmoid(scale * log(1 + surprise) + shift).
    scale: float = 0.0
    shift: float = 0.0

    def score(self, surprise: float) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.scale * math.log1p(surprise) + self.shift))))

    def of(self, words: Words) -> np.ndarray:
        """The weight of each word: its log-odds or, if these aren't negative, its stem's if they are higher; less DRIFT.

        What tells of toxicity tells less each time it comes again: positive odds are divided by how often the text has had the word.
        """
        whole = words.hashes()
        odds = self._known(whole)
        stem = np.max([self._known(words.prefixes(n)) for n in PREFIXES], 0)
        odds = np.where(odds < 0, odds, np.maximum(odds, stem))
        at = np.flatnonzero(odds > 0)
        order = at[np.lexsort((at, whole[at], np.searchsorted(words.first, at, side="right")))]
        new = np.ones(len(order), bool)
        of = np.searchsorted(words.first, order, side="right")
        new[1:] = (whole[order][1:] != whole[order][:-1]) | (of[1:] != of[:-1])
        begins = np.flatnonzero(new)
        odds[order] /= np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order)))) + 1
        return odds - DRIFT

    def _known(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.weights[at], 0.0)


def maximal_segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (first, beyond the last, score) of words of these weights.

    Candidates, each with the running total before and at its end: a new one joins back
    to the nearest earlier candidate that begins lower, if it ends higher than that one does. Each candidate
    knows that one from when it came, so the search for it leaps over those that begin higher, and none is leapt over twice: whoever comes
    later meets the one that leapt. So the time is linear. Only words of positive weight begin a candidate.
    """
    # first, beyond the last, total before, total at the end, place of the nearest candidate that begins lower (-1: none).
    stack: list[tuple[int, int, float, float, int]] = []
    totals, places = np.cumsum(weights), np.flatnonzero(weights > 0)
    after = totals[places]
    before = np.where(places > 0, totals[places - 1], 0.0) if len(places) else after
    for place, before_, total in zip(places.tolist(), before.tolist(), after.tolist()):
        first, low, left, k = place, before_, len(stack), len(stack) - 1
        while k >= 0 and stack[k][2] >= low:
            k = stack[k][4]
        while k >= 0 and stack[k][3] < total:
            first, _, low, _, lower = stack[k]
            left, k = k, lower
        del stack[left:]
        stack.append((first, place + 1, low, total, k))
    return [(a, b, high - low) for a, b, low, high, _ in stack]


def surprise(scores: list[float], n: int, rate: float) -> float:
    """Minus the logarithm of how often text that isn't toxic, of n words, has segments like these: the best over the r best; 0 at least.

    The law for a sum: the r best normalised scores are expected as high as t with e**-t t**(r-1) / (r! (r-1)!).
    """
    if not scores:
        return 0.0
    total = np.cumsum(rate * np.sort(scores)[::-1] - math.log(max(n, 1)))
    before = np.arange(len(total))
    factorials = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, len(total) + 1)))])
    at = total > 0
    found = total[at] - before[at] * np.log(total[at]) + factorials[1:][at] + factorials[:-1][at]
    return max(0.0, float(found.max())) if at.any() else 0.0


def law_rate(chance: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum chance * exp(rate * weight) = 1."""

    def over(x: float) -> bool:
        return float((chance * np.exp(np.minimum(x * weights, 700))).sum()) > 1

    low, high = 0.0, 1e-3
    while not over(high) and high < 100:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return low


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each token of a batch: in how many of its documents of each part with label 0 and 1 it is. At hash 0: documents in all."""
    for batch in in_slices(batches, "text"):
        words, kind = Words(lowered(batch.column("text").to_pylist()), NO_LETTER), _kinds(batch)
        document = words.document()
        found = [np.stack([np.zeros(len(kind), np.uint64), np.arange(len(kind), dtype=np.uint64)], 1)]
        for h in (words.hashes(), *(words.prefixes(n) for n in PREFIXES)):
            at = np.flatnonzero(h)
            found.append(np.stack([h[at], document[at].astype(np.uint64)], 1))
        every = np.unique(np.concatenate(found), axis=0)
        h, where = np.unique(every[:, 0], return_inverse=True)
        counts = np.bincount(where * 2 * PARTS + kind[every[:, 1].astype(np.int64)], minlength=len(h) * 2 * PARTS).reshape(len(h), 2 * PARTS)
        yield pa.record_batch({"h": pa.array(h.view(np.int64)), **{f"n{k}": pa.array(counts[:, k]) for k in range(2 * PARTS)}})


def _kinds(batch: pa.RecordBatch) -> np.ndarray:
    """Of each document its part and its label, in one number."""
    return 2 * batch.column("part").to_numpy().astype(np.int64) + batch.column("label").to_numpy()


def _contexts(tokens: np.ndarray):
    """What stands at each place of these tokens in texts: the document (what 0), the words around it (1) and the word itself (2), as hashes; the part as a bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            words, kind = Words(lowered(batch.column("text").to_pylist()), NO_LETTER), _kinds(batch)
            ids, document, whole = batch.column("doc_id").to_numpy(zero_copy_only=False), words.document(), words.hashes()
            around = np.concatenate([[0], whole, [0]]).astype(np.uint64)
            around = mixed(around[:-2] * np.uint64(3) + around[2:] * np.uint64(5))
            for h in (whole, *(words.prefixes(n) for n in PREFIXES)):
                at = np.flatnonzero(np.isin(h, tokens))
                for what, value in enumerate((ids[document[at]], around[at].view(np.int64), whole[at].view(np.int64))):
                    rows = np.unique(np.stack([h[at].view(np.int64), kind[document[at]], value.astype(np.int64)], 1), axis=0)
                    yield pa.record_batch({"h": pa.array(rows[:, 0]), "label": pa.array(rows[:, 1] & 1), "part": pa.array(1 << (rows[:, 1] >> 1)), "what": pa.array(np.full(len(rows), what)), "value": pa.array(rows[:, 2])})

    return run


def log_odds(y0: np.ndarray, y1: np.ndarray, n0: float, n1: float) -> np.ndarray:
    """Of tokens that y0 of n0 and y1 of n1 documents have; drawn towards zero by their uncertainty, and zero where that is larger."""
    a0, a1 = PRIOR * n0 / (n0 + n1), PRIOR * n1 / (n0 + n1)
    odds = np.log1p(y1 / a1) - np.log1p(y0 / a0)
    return np.sign(odds) * np.maximum(0, np.abs(odds) - CAUTION * np.sqrt(1 / (y1 + a1) + 1 / (y0 + a0)))


def _fewest(there: np.ndarray) -> int:
    """In how many documents a token must be, at least, to have odds other than zero in a model of all parts or of all but one."""
    totals = [there.sum(0), *(there.sum(0) - there)]
    for n in range(2, 100):
        y1 = np.arange(n + 1.0)
        if any(t.all() and log_odds(n - y1, y1, *t).any() for t in totals):
            return n
    return 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, folds: int = FOLDS, fold: int = FOLD) -> Odds:
    """A model of labels.toxic, from at most most_labelled documents with each label outside the held-out fold.

    Without labels of both kinds every text's score is (ones + 1) / (labels + 2). A null text is empty.
    """
    small_batches(docs.sparkSession)
    sample, counts = sample_of(labels, "toxic", most_labelled, folds, fold)
    part = F.pmod(F.xxhash64("doc_id", F.lit(PARTS)), F.lit(PARTS)).cast("int")
    texts = stored(texts_of(docs, sample).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), "label", part.alias("part")), "toxic-sample")
    names = [f"n{k}" for k in range(2 * PARTS)]
    seen = texts.select("text", "label", "part").mapInArrow(_presence, "h bigint, " + ", ".join(f"{n} bigint" for n in names)).groupBy("h").agg(*(F.sum(n).alias(n) for n in names))
    seen = stored(seen, "toxic-tokens")
    there = seen.where("h = 0").toPandas()[names].to_numpy(float).reshape(-1, PARTS, 2).sum(0)
    # Tokens of so few documents that their odds are zero in any model stay where they are. Of the rest there are no more than
    # the sample's documents have tokens, divided by that number of documents.
    seen = seen.where("h = 0 or " + " + ".join(names) + f" >= {_fewest(there)}").toPandas().sort_values("h")
    each = seen[names].to_numpy(float).reshape(-1, PARTS, 2)
    if not len(there) or not there.sum(0).all():
        return Odds(np.empty(0, np.uint64), np.empty(0), 1.0, 0.0, math.log((counts[1] + 1) / (counts[0] + 1)))
    hashes, each = seen.h.to_numpy(np.int64)[seen.h.to_numpy() != 0], each[seen.h.to_numpy() != 0]
    # The model itself is of all parts; one for each part is of all the others. With few documents, all are of all.
    few = (there.sum(0) - there).min() < PARTS
    left_out = [None] * (PARTS + 1) if few else [None, *range(PARTS)]
    totals = [there.sum(0) - (0 if k is None else there[k]) for k in left_out]
    odds = [log_odds(*(each.sum(1) - (0 if k is None else each[:, k])).T, *n) for k, n in zip(left_out, totals)]
    maybe = np.sort(hashes[np.max(odds, 0) > 0].view(np.uint64))
    places = texts.mapInArrow(_contexts(maybe), "h bigint, label bigint, part bigint, what bigint, value bigint")
    places = places.groupBy("h", "label", "what", "value").agg(F.bit_or("part").alias("parts"), F.max(F.col("h") == F.col("value")).alias("own"))
    some = [F.count_if(F.col("parts").bitwiseAND((1 << PARTS) - 1 if k is None else (1 << PARTS) - 1 - (1 << k)) != 0).alias(f"m{i}") for i, k in enumerate(left_out)]
    places = places.groupBy("h", "label", "what").agg(*some, F.max(F.col("own") & (F.col("what") == 2)).alias("own")).toPandas()
    tokens, at = np.unique(places.h.to_numpy(np.int64), return_inverse=True)
    seen_in = np.zeros((len(tokens), 2, 3, len(left_out)))
    seen_in[at, places.label.to_numpy(int), places.what.to_numpy(int)] = places[[f"m{i}" for i in range(len(left_out))]].to_numpy(float)
    is_word = np.zeros(len(tokens), bool)
    is_word[at[places.own.to_numpy(bool)]] = True
    models = []
    for i, n in enumerate(totals):
        y0, y1 = (np.minimum(seen_in[:, label, 0, i], seen_in[:, label, 1, i]) for label in (0, 1))
        telling = np.where(is_word | (seen_in[:, 1, 2, i] >= LEAST_FORMS), np.maximum(0, log_odds(y0, y1, *n)), 0.0)
        h, w = np.concatenate([hashes[odds[i] < 0], tokens]).view(np.uint64), np.concatenate([odds[i][odds[i] < 0], telling])
        order = np.argsort(h)
        order = order[w[order] != 0]
        models.append(Odds(h[order], w[order], 1.0))
    spread = texts.where("label = 0").select("text", "part").mapInArrow(_weights(models[1:]), "part int, weight double, n bigint").groupBy("part", "weight").agg(F.sum("n").alias("n")).toPandas().sort_values(["part", "weight"])
    for k, own in spread.groupby("part"):
        models[1 + k].rate = law_rate(own.n.to_numpy(float) / own.n.sum(), own.weight.to_numpy(float))
    model = models[0]
    model.rate = float(np.mean([m.rate for m in models[1:]]))
    felt = texts.select("text", "label", "part").mapInArrow(_surprises(models[1:]), "label int, surprise double").toPandas().sort_values(["surprise", "label"])
    # Weighed as among all labels, of which the sample may have another share.
    y = felt.label.to_numpy(float)
    w = np.array([counts[k] / max(1, (y == k).sum()) for k in (0, 1)])[y.astype(int)]
    model.scale, model.shift = calibrated(np.log1p(felt.surprise.to_numpy(float)), y, w / w.mean())
    model.scale = max(model.scale, 0.0)
    return model


def _by_part(batches: Iterator[pa.RecordBatch], models: list[Odds]) -> Iterator[tuple[int, Odds, pa.RecordBatch, Words]]:
    """Documents with the model that didn't count their part."""
    for batch in in_slices(batches, "text"):
        part = batch.column("part").to_numpy()
        for k in np.unique(part).tolist():
            own = batch.filter(pa.array(part == k))
            yield k, models[k], own, Words(lowered(own.column("text").to_pylist()), NO_LETTER)


def _weights(models: list[Odds]):
    """How often words have each weight, to a hundredth, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, model, _, words in _by_part(batches, models):
            values, n = np.unique(np.round(model.of(words), 2), return_counts=True)
            yield pa.record_batch({"part": pa.array(np.full(len(n), part, np.int32)), "weight": pa.array(values), "n": pa.array(n.astype(np.int64))})

    return run


def _surprises(models: list[Odds]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, model, batch, words in _by_part(batches, models):
            found = [surprise([s for *_, s in x], int(n), model.rate) for x, n in zip(segments(words, model), words.counts)]
            yield pa.record_batch({"label": batch.column("label"), "surprise": pa.array(found, pa.float64())})

    return run


def segments(words: Words, model: Odds) -> Iterator[list[tuple[int, int, float]]]:
    """Of each text, its maximal segments: first word, beyond the last, score."""
    weights = model.of(words)
    some = np.diff(np.concatenate([[0], np.cumsum(weights > 0)])[words.first])
    for a, b, n in zip(words.first[:-1].tolist(), words.first[1:].tolist(), some.tolist()):
        yield maximal_segments(weights[a:b]) if n else []


def score_toxicity(docs: DataFrame, model: Odds, score: str = "toxicity") -> DataFrame:
    """docs (any columns, one of them text) with two more: the score, and passages.

    passages: of each significant maximal segment, begins and ends (bytes of the text's UTF-8), score,
    and expected (how often a text of this length that isn't toxic has one like it). A null or empty text has
    none, and the score of no surprise. Rows that repeat are scored alike; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    text, names, plain = position(docs, "text"), [*docs.columns, score, "passages"], by_place(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields), "score double, passages array<struct<begins: bigint, ends: bigint, score: double, expected: double>>"])
    kind = pa.list_(pa.struct([("begins", pa.int64()), ("ends", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in in_slices(batches, f"c{text}"):
            words = Words(lowered(batch.column(text).to_pylist()), NO_LETTER)
            scores, spans = [], []
            for d, found in enumerate(segments(words, m)):
                n, first, base = int(words.counts[d]), int(words.first[d]), int(words.bounds[d])
                scores.append(m.score(surprise([s for *_, s in found], n, m.rate)))
                told = [(a, b, s, n * math.exp(-m.rate * s)) for a, b, s in found]
                spans.append([{"begins": int(words.start[first + a]) - base, "ends": int(words.start[first + b - 1] + words.length[first + b - 1]) - base, "score": s, "expected": e} for a, b, s, e in told if e <= SIGNIFICANT])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, kind)], [*batch.schema.names, "score", "passages"])

    return plain.mapInArrow(run, schema).toDF(*names)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(pick(docs, "doc_id", "text"), model, "score")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
