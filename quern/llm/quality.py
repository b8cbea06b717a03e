"""Quality classifier: a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover it from end to end. Filters of WIDTH
bytes slide over a chunk; each filter's largest answer in the chunk goes through one dense layer to the
chunk's logit, and the mean logit of all chunks through a calibrated sigmoid to the text's probability.
Filters are tables of a weight for each byte at each place; two places are folded into one table of
byte pairs, so an answer is a sum of WIDTH / 2 rows.

It is fitted in one task, so that the driver holds no texts, on a sample of labelled documents that is bounded by MOST_LABELLED rows and MOST_BYTES of chunks: all
chunks of a document, or as many as fit, spread evenly over the whole of it, where the sample has more. No text's length
takes another document out of the sample. One document of CALIBRATED isn't fitted on, but calibrated on, by its whole text.
Scoring is one narrow stage over whole texts, with the tables (a few MB) broadcast. A text's score depends on its own
bytes alone: the bytes after its end are zeros, whatever text comes next in the batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import as_bytes, by_place, held_out, in_slices, pick, position, small_batches, stored, table
from .labelled import calibrated, sample_of, texts_of

#: Bytes of a filter, even; filters.
WIDTH, FILTERS = 6, 24
#: A chunk is BLOCKS blocks of BLOCK bytes; it shares one block with the next.
BLOCK, BLOCKS = 128, 4
CHUNK, STEP = BLOCK * BLOCKS, BLOCK * (BLOCKS - 1)
#: A chunk and what filters at its end reach.
PIECE = CHUNK + WIDTH - 1
#: The sample of labelled rows that the model is made of: documents with each label at most (those whose hashed ids are
#: smallest), and bytes of chunks that are fitted on (one chunk of each document at least).
MOST_LABELLED, MOST_BYTES = 3000, 32 << 20
#: Of so many documents of the sample one is for calibration.
CALIBRATED = 5
#: Chunks that are looked at in all epochs together, about; epochs at least and at most.
VISITS, EPOCHS = 240_000, (3, 40)
BATCH, RATE = 64, 0.004
THRESHOLD = 0.7
#: The held-out fold of labels: crc32(doc_id) mod FOLDS = FOLD.
FOLDS, FOLD = 4, 2
#: Text that is answered at once, in bytes.
SLICE = 96 << 10


def chunk_starts(n: int) -> list[int]:
    """Where chunks begin in a text of n bytes, so that they cover it."""
    return list(range(0, max(1, -(-n // BLOCK) - 1) * BLOCK, STEP))


@dataclass
class ByteConv:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: float
    #: The text's probability is sigmoid(scale * mean logit + shift).
    scale: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fresh(seed: int = 7) -> ByteConv:
        rng = np.random.default_rng(seed)
        return ByteConv((0.3 * rng.standard_normal((WIDTH, 256, FILTERS))).astype(np.float32), np.zeros(FILTERS, np.float32), (0.2 * rng.standard_normal(FILTERS)).astype(np.float32), 0.0)

    @staticmethod
    def constant(probability: float) -> ByteConv:
        """One that gives every text the same."""
        z = np.zeros
        return ByteConv(z((WIDTH, 256, FILTERS), np.float32), z(FILTERS, np.float32), z(FILTERS, np.float32), 0.0, 0.0, float(np.log(probability / (1 - probability))))

    def pair_tables(self) -> np.ndarray:
        t = self.tables
        return np.stack([(t[2 * k][None, :, :] + t[2 * k + 1][:, None, :]).reshape(1 << 16, FILTERS) for k in range(WIDTH // 2)])

    def fit(self, raw: np.ndarray, starts: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int, seed: int = 11) -> None:
        """A chunk is the CHUNK + WIDTH - 1 bytes of raw from its start. By Adam; only the place of each filter's largest answer has a gradient."""
        rng, step = np.random.default_rng(seed), 0
        within = np.arange(CHUNK + WIDTH - 1)
        params = [self.tables, self.bias, self.dense, np.zeros(1, np.float32)]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for epoch in range(epochs):
            order = rng.permutation(len(starts))
            rate = RATE * (1 - 0.8 * epoch / epochs)
            for i in range(0, len(order), BATCH):
                at = order[i : i + BATCH]
                x, y, w = raw[starts[at][:, None] + within], labels[at], weights[at]
                answers = sum(self.tables[j][x[:, j : j + CHUNK]] for j in range(WIDTH)) + self.bias
                where = answers.argmax(1)
                top = np.take_along_axis(answers, where[:, None, :], 1)[:, 0]
                hidden = np.maximum(top, 0)
                p = 1 / (1 + np.exp(-np.clip(hidden @ self.dense + params[3][0], -30, 30)))
                dz = ((p - y) * w / len(at)).astype(np.float32)
                dh = dz[:, None] * self.dense * (top > 0)
                rows, columns = np.arange(len(at))[:, None], np.arange(FILTERS)[None, :]
                # One sum over all places of the tables.
                cells = np.stack([(j * 256 + x[rows, where + j].astype(np.int64)) * FILTERS + columns for j in range(WIDTH)])
                dt = np.bincount(cells.ravel(), np.broadcast_to(dh, cells.shape).ravel(), self.tables.size).astype(np.float32).reshape(self.tables.shape)
                grads = [dt, dh.sum(0), hidden.T @ dz + 1e-4 * self.dense, dz.sum(keepdims=True)]
                step += 1
                for p_, g, (m, v) in zip(params, grads, moments):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p_ -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.offset = float(params[3][0])


class Scorer:
    """Whole texts to probabilities."""

    def __init__(self, model: ByteConv) -> None:
        self.model, self.pairs = model, model.pair_tables()

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Mean chunk logit of each text."""
        lengths = np.array([max(1, -(-len(t) // BLOCK)) for t in texts])
        raw = b"".join(t + b"\0" * (n * BLOCK - len(t) + WIDTH) for t, n in zip(texts, lengths.tolist()))
        firsts = np.concatenate([[0], np.cumsum(lengths)])
        two = np.ndarray((len(raw) - 1,), "<u2", raw, strides=(1,))
        # Where each block's windows begin: texts stand WIDTH bytes apart, so no window reaches into another text.
        starts = np.arange(firsts[-1]) * BLOCK + np.repeat(np.arange(len(texts)), lengths) * WIDTH
        blocks = np.empty((len(starts), FILTERS), np.float32)
        step = SLICE // BLOCK
        for i in range(0, len(blocks), step):
            at = (starts[i : i + step, None] + np.arange(BLOCK)).ravel()
            answers = self.pairs[0].take(two[at], axis=0)
            for k in range(1, WIDTH // 2):
                answers += self.pairs[k].take(two[at + 2 * k], axis=0)
            blocks[i : i + step] = answers.reshape(-1, BLOCK, FILTERS).max(1)
        out = np.empty(len(texts))
        for d in range(len(texts)):
            own = blocks[firsts[d] : firsts[d + 1]]
            starts = np.arange(0, max(1, len(own) - 1), BLOCKS - 1)
            top = own[np.minimum(starts[:, None] + np.arange(BLOCKS), len(own) - 1)].max(1)
            out[d] = (np.maximum(top + self.model.bias, 0) @ self.model.dense + self.model.offset).mean()
        return out

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.model.scale * self.logits(texts) + self.model.shift, -40, 40)))


def _most_chunks(chunks: np.ndarray, most_bytes: int) -> int:
    """The largest number of chunks for one document, so that all are within most_bytes; 1 at least."""
    low, high = 1, max(1, int(chunks.max()))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if int(np.minimum(chunks, middle).sum()) * PIECE <= most_bytes else (low, middle - 1)
    return low


def _pieces(found: DataFrame, ids: set[int], most: int) -> DataFrame:
    """(doc_id, pieces) of these documents: up to most chunks, spread over the whole text, each with the bytes that filters at its end reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            some = batch.filter(pa.array([x in ids for x in batch.column("doc_id").to_pylist()], pa.bool_()))
            out = []
            for text in as_bytes(some.column("text")):
                starts = chunk_starts(len(text))
                n = min(len(starts), most)
                chosen = [starts[i * (len(starts) - 1) // max(1, n - 1)] for i in range(n)]
                out.append(b"".join(text[s : s + PIECE].ljust(PIECE, b"\0") for s in chosen))
            yield pa.record_batch({"doc_id": some.column("doc_id"), "pieces": pa.array(out, pa.binary())})

    return found.select("doc_id", "text").mapInArrow(run, "doc_id bigint, pieces binary")


def _logits(found: DataFrame, ids: set[int], model: ByteConv) -> DataFrame:
    """(doc_id, logit) of these documents' whole texts."""
    shared = found.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in in_slices(batches, "text"):
            some = batch.filter(pa.array([x in ids for x in batch.column("doc_id").to_pylist()], pa.bool_()))
            if not some.num_rows:
                continue
            scorer = scorer or Scorer(shared.value)
            yield pa.record_batch({"doc_id": some.column("doc_id"), "logit": pa.array(scorer.logits(as_bytes(some.column("text"))), pa.float64())})

    return found.select("doc_id", "text").mapInArrow(run, "doc_id bigint, logit double")


def _fitted(pieces: DataFrame, order: list[int], y: np.ndarray) -> ByteConv:
    """A model of (doc_id, pieces), the bounded sample, fitted in one task; order: the documents' ids, y: their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_of: dict[int, bytes] = {}
        for batch in batches:
            pieces_of.update(zip(batch.column("doc_id").to_pylist(), batch.column("pieces").to_pylist()))
        own = [pieces_of.pop(x) for x in order]
        of = np.repeat(np.arange(len(order)), [len(x) // PIECE for x in own])
        starts = np.arange(len(of)) * PIECE
        # Documents with few chunks weigh as much as others, and both labels as much in fitting the filters.
        weights = (np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())))[of] / np.bincount(of)[of]
        epochs = max(EPOCHS[0], min(EPOCHS[1], VISITS // len(starts)))
        model = ByteConv.fresh()
        model.fit(np.frombuffer(b"".join(own), np.uint8), starts, y[of], (weights / weights.mean()).astype(np.float32), epochs)
        yield pa.record_batch({"model": pa.array([pickle.dumps(model)], pa.binary())})

    return pickle.loads(pieces.repartition(1).mapInArrow(run, "model binary").collect()[0].model)


def fit_quality(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, folds: int = FOLDS, fold: int = FOLD, most_bytes: int = MOST_BYTES) -> ByteConv:
    """A model of labels.quality, from at most most_labelled documents with each label outside the held-out fold, and most_bytes of their chunks.

    Without labels of both kinds it gives every text one probability, (ones + 1) / (labels + 2). A null
    text is empty; of rows that repeat a doc_id the smallest text counts. Of a very long text there are as many chunks as fit, spread over all of it;
    other documents have theirs all the same.
    """
    small_batches(docs.sparkSession)
    sample, counts = sample_of(labels, "quality", most_labelled, folds, fold)
    found = texts_of(docs, sample).groupBy("doc_id").agg(F.min("label").alias("label"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    found = stored(found.select("doc_id", "label", F.xxhash64("doc_id").alias("hash"), F.octet_length("text").alias("size"), "text"), "quality-sample")
    # Rows of the sample, whose number is bounded; their chunks, whose bytes are, go to one task.
    rows = sorted(found.select("doc_id", "label", "hash", "size").collect(), key=lambda r: (r.hash, r.doc_id))
    there = np.bincount(np.array([r.label for r in rows], int), minlength=2)
    if not there.all():
        return ByteConv.constant((counts[1] + 1) / (counts[0] + counts[1] + 2))
    y = np.array([r.label for r in rows], float)
    # Every so many documents of each label are kept for calibration, if there are enough.
    order = np.concatenate([np.arange((y == k).sum()) for k in (0, 1)])[np.argsort(np.argsort(y, kind="stable"), kind="stable")]
    kept = order % CALIBRATED == CALIBRATED - 1 if there.min() >= CALIBRATED else np.zeros(len(y), bool)
    fitted = np.flatnonzero(~kept)
    most = _most_chunks(np.array([len(chunk_starts(rows[i]["size"])) for i in fitted]), most_bytes)
    model = _fitted(_pieces(found, {rows[i].doc_id for i in fitted}, most), [rows[i].doc_id for i in fitted], y[fitted])
    # Calibrated on what is scored: whole texts, that weren't fitted on. The sample is cut at as many of each label;
    # the probability is that among all labels.
    at = np.flatnonzero(kept) if kept.any() else np.arange(len(y))
    logit_of = {r.doc_id: r.logit for r in _logits(found, {rows[i].doc_id for i in at}, model).collect()}
    x = np.array([logit_of[rows[i].doc_id] for i in at])
    w = np.array([counts[k] / (y[at] == k).sum() for k in (0, 1)])[y[at].astype(int)]
    model.scale, model.shift = calibrated(x, y[at], w / w.mean())
    return model


def score_quality(docs: DataFrame, model: ByteConv, score: str = "quality_score") -> DataFrame:
    """docs (any columns, one of them text) with one more column, the probability of label 1.

    A null text is scored as an empty one: one chunk of padding. Other columns stay as they are; if
    docs has a column called score already, the new one is put last all the same, so choose another name.
    """
    small_batches(docs.sparkSession)
    text = position(docs, "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, plain = [*docs.columns, score], by_place(docs)
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in in_slices(batches, f"c{text}"):
            scorer = scorer or Scorer(shared.value)
            found = scorer.probabilities(as_bytes(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "score"])

    return plain.mapInArrow(run, schema).toDF(*names)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(pick(docs, "doc_id", "text"), model, "score")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
