"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, their stems (first ``STEM`` characters, so
that inflected forms share one), word pairs and pairs with one or two words between,
hashed into ``DIM`` coordinates. Training takes a bounded sample of labelled
rows; per-coordinate learning rates and L1 leave few weights other than zero, which
travel to every task. Scoring is one pass over whole texts, without a shuffle.

Defined results: null and empty texts have no features and get the intercept's score;
repeated rows are scored alike; a document labelled more than once counts as toxic if
any label says so; without a labelled row of both classes every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import blocks, column, id_text, mix, tidy, word_lists

DIM = 1 << 20
SAMPLE_PER_CLASS = {1: 3000, 0: 6000}  # at most so many labelled rows train the model
STEM = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 1.0
BLOCK_BYTES = 2 << 20
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@dataclass(frozen=True)
class Model:
    """Coordinates with a weight other than zero, ascending, their weights, and the intercept."""

    index: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        w = np.zeros(DIM, np.float32)
        w[self.index] = self.weight
        return w


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, coordinate) of every n-gram and skip-gram, repeats included."""
    ends, codes, words = word_lists(pc.fill_null(texts, ""))
    plain = pc.utf8_trim(pc.utf8_lower(words), EDGES).to_pylist()
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in plain), np.uint64, len(plain))[codes]
    stem = np.fromiter((xxhash.xxh3_64_intdigest(w[:STEM], STEM) for w in plain), np.uint64, len(plain))[codes]
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    docs, coords = [doc, doc], [mix(h), mix(stem)]
    for gap in (1, 2, 3):
        same = doc[gap:] == doc[:-gap] if gap < len(doc) else np.zeros(0, bool)
        a, b = h[:-gap][same], h[gap:][same]
        docs.append(doc[:-gap][same])
        coords.append(mix(a * np.uint64(3 + 2 * gap) + mix(b)))
    return np.concatenate(docs), (np.concatenate(coords) & np.uint64(DIM - 1)).astype(np.int64)


def feature_sets(batches):
    """Per document the distinct coordinates, as bytes of 32-bit integers."""
    for batch in blocks(batches, "text", BLOCK_BYTES):
        doc, coord = features(column(batch, "text"))
        keys = np.unique(doc * DIM + coord)
        cuts = np.searchsorted(keys, np.arange(1, batch.num_rows) * DIM)
        sets = [x.tobytes() for x in np.split((keys % DIM).astype("<i4"), cuts)] if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(sets, pa.binary())], ["doc_id", "features"])


def ftrl(rows: list[tuple[np.ndarray, int]]) -> Model:
    """FTRL-proximal over the rows in their order, ``EPOCHS`` times."""
    z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)  # the last coordinate is the intercept

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0
        if at[-1] == DIM:  # neither shrunk nor cut
            w[-1] = -zi[-1] * ALPHA / (BETA + np.sqrt(n[DIM]))
        return w

    for _ in range(EPOCHS):
        for coords, label in rows:
            at = np.append(coords, DIM)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(DIM + 1))
    index = np.flatnonzero(w[:DIM])
    return Model(index.astype(np.int32), w[index].astype(np.float32), float(w[DIM]))


def is_held_out(doc_id):
    """Never null: a null id has no label to learn from and isn't held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def training_rows(table: pa.Table) -> list[tuple[np.ndarray, int]]:
    """(coordinates, label) of each row by ``order``; the coordinates stay in the table."""
    features, labels = column(table, "features"), column(table, "toxic").to_pylist()
    order = np.argsort(np.asarray(table.column("order")), kind="stable")
    return [(np.frombuffer(features[i].as_buffer(), "<i4"), labels[i]) for i in order.tolist()]


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``SAMPLE_PER_CLASS`` rows of each class, the first by a hash of
    their id. The intercept is moved from the sample's odds to those of all labels."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~is_held_out(F.col("doc_id")))
    sample = None
    for label, most in SAMPLE_PER_CLASS.items():
        some = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        sample = some if sample is None else sample.unionByName(some)
    chosen = id_text(documents).join(F.broadcast(sample), "doc_id", "left_semi")  # bounded by the sample's size
    sets = chosen.mapInArrow(tidy(feature_sets), "doc_id long, features binary").groupBy("doc_id").agg(F.min("features").alias("features"))

    def fit(table: pa.Table) -> pa.Table:
        m = ftrl(training_rows(table))
        return pa.table({"index": [m.index.tobytes()], "weight": [m.weight.tobytes()], "intercept": [m.intercept]})

    fitted = (sets.join(F.broadcast(sample), "doc_id").select("features", "toxic", F.xxhash64("doc_id", F.lit("order")).alias("order"), F.lit(0).alias("one"))
              .groupBy("one").applyInArrow(fit, "index binary, weight binary, intercept double"))  # the bounded sample
    row = fitted.first()
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if row is None or not counts.get(0) or not counts.get(1):
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), -35.0)
    took = {y: min(n, SAMPLE_PER_CLASS[y]) for y, n in counts.items()}
    moved = np.log(counts[1] / counts[0]) - np.log(took[1] / took[0])
    return Model(np.frombuffer(row["index"], np.int32), np.frombuffer(row["weight"], np.float32), row["intercept"] + float(moved))


def scores(texts: pa.Array, weights: np.ndarray, intercept: float) -> np.ndarray:
    """Probability of label 1 for each text."""
    doc, coord = features(texts)
    hit = weights[coord] != 0
    keys = np.unique(doc[hit] * DIM + coord[hit])
    total = np.bincount(keys // DIM, weights=weights[keys % DIM].astype(np.float64), minlength=len(texts)) if len(keys) else np.zeros(len(texts))
    return 1 / (1 + np.exp(-np.clip(total + intercept, -35, 35)))


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row."""

    def run(batches):
        w = model.dense()
        for batch in blocks(batches, "text", BLOCK_BYTES):
            s = scores(column(batch, "text"), w, model.intercept)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(s)], ["doc_id", "score"])

    return id_text(documents).mapInArrow(tidy(run), "doc_id long, score double")


def drop_toxic(documents: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose score stays below ``threshold``."""

    def run(batches):
        w = model.dense()
        for table in blocks(batches, text_col, BLOCK_BYTES):
            s = scores(column(table, text_col), w, model.intercept)
            yield from table.filter(pa.array(s < threshold)).to_batches()

    return documents.mapInArrow(tidy(run), documents.schema)
