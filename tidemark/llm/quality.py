"""Quality by votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name
from tidemark.llm.samples import labelled_sample

#: Labelled documents of each class that the space and the votes are made of, at most.
SAMPLE_ROWS = 2000
#: Terms of form: hashed runs of three character classes, and of adjacent words. Then hashed words.
FORM = 1024
WORDS = 1024
TERMS = FORM + WORDS
#: Dimensions of the latent space, neighbours that vote, and the power of similarity they weigh by.
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 8
#: Documents compared with all labelled vectors at once.
BLOCK = 512
THRESHOLD = 0.7


def _classes() -> np.ndarray:
    """A small number for each byte: letters by case, digits, each other ASCII sign by itself."""
    table = np.arange(256, dtype=np.int64)
    table[ord("a") : ord("z") + 1] = 1
    table[0x80:] = 1
    table[ord("A") : ord("Z") + 1] = 2
    table[ord("0") : ord("9") + 1] = 3
    return table


CLASSES = _classes()


def terms_of(text: str | None) -> np.ndarray:
    """Counts of the terms of a whole text.

    Three character classes in a row make a term, so do the lengths of a word and the next
    and whether they are equal: what makes a text clean or broken shows in its form, whatever
    its language. Letters beyond ASCII count as lower case. The words themselves, ASCII-lower-cased,
    are hashed to terms of their own, so texts of one form but different words differ.
    """
    counts = np.zeros(TERMS)
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return counts
    half = FORM // 2
    kinds = CLASSES[np.frombuffer(b" " + data + b" ", dtype=np.uint8)]
    runs = (kinds[:-2] * 256 + kinds[1:-1]) * 256 + kinds[2:]
    counts[:half] += np.bincount((runs * 0x9E3779B1 >> 12) % half, minlength=half)
    words = data.split()
    if len(words) > 1:
        sizes = np.minimum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)), 15)
        equal = np.fromiter((a == b for a, b in zip(words, words[1:])), dtype=np.int64, count=len(words) - 1)
        pairs = (sizes[:-1] * 16 + sizes[1:]) * 2 + equal
        counts[half:FORM] += np.bincount((pairs * 0x9E3779B1 >> 12) % half, minlength=half)
    slots = np.fromiter((zlib.crc32(w) % WORDS for w in data.lower().split()), dtype=np.int64, count=len(words))
    counts[FORM:] += np.bincount(slots, minlength=WORDS)
    return counts


@dataclass(frozen=True)
class Space:
    """Term weights and the projection; the labelled vectors, of length one, and their labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Latent vectors of length one of rows of term counts; zero where there are no terms."""
        x = weighted(counts, self.weights) @ self.projection
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return (x / np.where(norm > 0, norm, 1)).astype(np.float32)

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Share of good labels among the nearest, weighed by similarity, for each vector.

        Every product with every labelled vector is computed. Equal similarities at the edge
        are settled by the order of the labelled vectors.
        """
        if not len(self.vectors):
            return np.full(len(vectors), self.prior)
        k = min(NEIGHBOURS, len(self.vectors))
        result = np.empty(len(vectors))
        for s in range(0, len(vectors), BLOCK):
            block = vectors[s : s + BLOCK]
            near = block @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            similar = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(float) ** SHARPNESS
            total = similar.sum(axis=1)
            votes = (similar * self.labels[best]).sum(axis=1)
            result[s : s + BLOCK] = np.where(total > 0, votes / np.where(total > 0, total, 1), self.prior)
        return result


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Relative term frequencies, damped by a square root, times the terms' weights."""
    total = counts.sum(axis=1, keepdims=True)
    return np.sqrt(counts / np.where(total > 0, total, 1)) * weights


def fit(counts: np.ndarray, labels: np.ndarray) -> Space:
    """The latent space of a sample's term counts, by a truncated singular value decomposition."""
    n = len(counts)
    prior = float(labels.mean()) if n else 0.5
    if not n:
        return Space(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1), np.float32), labels, prior)
    seen = (counts > 0).sum(axis=0)
    weights = np.log((1 + n) / (1 + seen)) + 1
    x = weighted(counts, weights)
    spread, axes = np.linalg.eigh(x.T @ x)
    rank = min(DIMENSIONS, n, int((spread > 1e-9).sum()) or 1)
    projection = axes[:, ::-1][:, :rank]
    space = Space(weights, projection, np.zeros((0, rank), np.float32), labels, prior)
    return Space(weights, projection, space.project(counts), labels.astype(float), prior)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Space:
    """Fit the space on a bounded sample: of each class the ``rows`` labelled documents with the
    smallest hash of their id. Their term counts, not their texts, reach the driver."""
    sample = labelled_sample(docs, labels, "quality", rows, doc_id, text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [terms_of(t.as_py()).astype(np.float32).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, type=pa.binary())], names=["id", "label", "counts"]
            )

    found = sample.select("id", "label", "text").mapInArrow(count, "id long, label int, counts binary").toArrow()
    order = np.argsort(found.column("id").to_numpy(), kind="stable")
    counts = np.array([np.frombuffer(c.as_py(), dtype=np.float32) for c in found.column("counts")]).reshape(-1, TERMS)
    return fit(counts[order].astype(float), found.column("label").to_numpy()[order])


def score_quality(docs: DataFrame, model: Space, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are read. Null and empty texts have no terms and score the sample's share of
    good labels, as every text does without labelled rows. Equal texts get equal scores. One
    pass, no shuffle; what is broadcast is bounded by the sample. Other columns pass through; a
    new column whose name exists gets an underscore.
    """
    score = free_name("score", docs.columns)
    predicted = free_name("predicted", [*docs.columns, score])
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            column = batch.column(at)
            vectors = [
                space.project(np.array([terms_of(t.as_py()) for t in column.slice(s, BLOCK)]))
                for s in range(0, len(column), BLOCK)
            ]
            found = space.vote(np.concatenate(vectors)) if vectors else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=[*batch.schema.names, score, predicted],
            )

    return docs.mapInArrow(
        run,
        T.StructType(
            [*docs.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())]
        ),
    )
