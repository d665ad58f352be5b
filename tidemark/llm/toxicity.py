"""Toxicity by two Kneser-Ney word models, of toxic and of ordinary texts, that share their backoff."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, free_name
from tidemark.llm.samples import labelled_sample

#: Labelled documents of each class that the models are fitted on, at most.
SAMPLE_ROWS = 3000
#: One labelled document in so many is kept from the counts, to fit the scale of the score.
CALIBRATION = 4
DISCOUNT = 0.75
#: An expression, a word or a pair, takes the shared counts if it has less evidence than this, or
#: if the classes differ by fewer standard errors or by a smaller factor.
LEAST = 4
DEVIATIONS = 4.5
FACTOR = 3
#: Words on either side of an expression that tell its occurrences apart.
BESIDE = 2

#: Stands before the first word, and after the last where expressions are judged.
START = ""

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall((text or "").lower())


@dataclass(frozen=True)
class Ratios:
    """log(toxic / ordinary) of a next word: by pair, else by word, else the common rest."""

    pairs: dict[tuple[str, str], float]
    words: dict[str, float]
    rest: float
    slope: float = 1.0
    shift: float = 0.0

    def mean_ratio(self, text: str | None) -> float:
        """Difference of the two log-likelihoods, divided by the number of words; 0 without any."""
        words = words_of(text)
        if not words:
            return 0.0
        own, pairs, rest = self.words, self.pairs, self.rest
        total = 0.0
        before = START
        for word in words:
            ratio = pairs.get((before, word))
            total += own.get(word, rest) if ratio is None else ratio
            before = word
        return total / len(words)

    def score(self, text: str | None) -> float:
        z = self.slope * self.mean_ratio(text) + self.shift
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def expression_counts(sample: DataFrame, length: int) -> DataFrame:
    """(x1, ..., beside, n1, n0): in how many toxic and ordinary texts a run of ``length`` words occurs
    between the same ``BESIDE`` words on either side; a text's start and end count as words."""
    names = [f"x{i + 1}" for i in range(length)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter = Counter()
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = [*[START] * BESIDE, *words_of(text.as_py()), *[START] * BESIDE]
                runs = set(zip(*(words[i:] for i in range(length + 2 * BESIDE))))
                held.update((label, " ".join(run[:BESIDE] + run[-BESIDE:]), *run[BESIDE:-BESIDE]) for run in runs)
            labels, beside, *columns = zip(*held) if held else ((),) * (length + 2)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(c, type=pa.string()) for c in (*columns, beside)],
                    pa.array(labels, type=pa.int32()),
                    pa.array(held.values(), type=pa.int64()),
                ],
                names=[*names, "beside", "label", "n"],
            )

    schema = ", ".join(f"{n} string" for n in (*names, "beside")) + ", label int, n long"
    return sample.select("text", "label").mapInArrow(count, schema).groupBy(*names, "beside").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"),
    )


def evidence(sample: DataFrame, length: int) -> DataFrame:
    """(x1, ..., e1, e0): for each run of ``length`` words its evidence in either class.

    It is the number of different words that it stands between, its continuation count, times their
    share in the texts that hold them, so a family of near copies counts about once. Two words
    on either side, because a small vocabulary has few single ones, and the larger class would
    run out of them first.
    """
    names = [f"x{i + 1}" for i in range(length)]
    return expression_counts(sample, length).groupBy(*names).agg(
        *[F.count_if(F.col(f"n{c}") > 0).alias(f"k{c}") for c in (1, 0)], *[F.sum(f"n{c}").alias(f"i{c}") for c in (1, 0)]
    ).select(*names, *[F.expr(f"if(k{c} > 0, k{c} * k{c} / i{c}, 0)").alias(f"e{c}") for c in (1, 0)])


def pair_counts(sample: DataFrame) -> DataFrame:
    """(prev, word, n1, n0): in how many toxic and ordinary texts a pair occurs; a start is ''."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter = Counter()
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                held.update(set(zip([label] * len(words), [START, *words], words)))
            labels, prevs, words = zip(*held) if held else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(prevs, type=pa.string()),
                    pa.array(words, type=pa.string()),
                    pa.array(labels, type=pa.int32()),
                    pa.array(held.values(), type=pa.int64()),
                ],
                names=["prev", "word", "label", "n"],
            )

    rows = sample.select("text", "label").mapInArrow(count, "prev string, word string, label int, n long")
    return rows.groupBy("prev", "word").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"),
    )


def telling(found: DataFrame, m1: int, m0: int) -> DataFrame:
    """The expressions whose classes differ beyond chance and by a factor."""
    spread = f"sqrt((e1 + e0) / {m1 + m0} * (1 / {m1} + 1 / {m0}))"
    return found.filter(F.expr(f"e1 + e0 >= {LEAST}")).filter(
        F.expr(f"abs(e1 / {m1} - e0 / {m0}) >= {DEVIATIONS} * {spread}")
        & F.expr(f"abs(ln(((e1 + 0.5) / {m1}) / ((e0 + 0.5) / {m0}))) >= ln({FACTOR})")
    )


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Ratios:
    """Fit both models on a bounded sample of labelled documents.

    Both are interpolated bigram models. A word's own weight in a class is its continuation count
    there: the number of different words that it follows. An expression, a word or a pair of
    words, that is rare, or whose classes do not differ beyond chance and by a factor, takes the
    counts of both classes together and so weighs the same in either model, but for the share of
    probability that the others leave it. Pairs with a word that tells back off to it. Pairs of two
    words that don't tell are judged by evidence of their own, so a phrase of ordinary words, or a
    word that always follows the same one, can tell. Counting and tests run on Spark; the driver
    gets what tells, which a bounded sample bounds, and one number for each document of the
    calibration sample. With one class only, every text scores that class's share of the sample.
    """
    sample = cut(labelled_sample(docs, labels, "toxic", rows, doc_id, text))
    aside = F.pmod(F.col("h"), F.lit(CALIBRATION)) == 0
    fitted = sample.filter(~aside)
    counts = cut(pair_counts(fitted))
    words = counts.groupBy("word").agg(
        F.count_if(F.col("n1") > 0).alias("k1"), F.count_if(F.col("n0") > 0).alias("k0"), F.count("*").alias("k")
    )
    sums = words.agg(
        F.sum("k1"), F.sum("k0"), F.sum("k"), F.count_if(F.col("k1") > 0), F.count_if(F.col("k0") > 0)
    ).first()
    big1, big0, big, types1, types0 = (x or 0 for x in sums)
    if not big1 or not big0:
        share = sample.agg(F.avg("label")).first()[0]
        odds = min(max(0.5 if share is None else share, 0.01), 0.99)
        return Ratios({}, {}, 0.0, 0.0, math.log(odds / (1 - odds)))
    texts = {r["label"]: r["n"] for r in fitted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    m1, m0 = texts[1], texts[0]
    known = cut(telling(evidence(fitted, 1), m1, m0).select("x1"))
    own: dict[str, tuple[float, float]] = {}
    shared_mass = 0.0
    for r in words.join(known, words["word"] == known["x1"]).collect():
        shared = r["k"] / big
        shared_mass += shared
        own[r["word"]] = tuple(
            max(r[k] - DISCOUNT, 0) / n + DISCOUNT * types / n * shared
            for k, n, types in (("k1", big1, types1), ("k0", big0, types0))
        )
    left = [max(1 - sum(p[c] for p in own.values()), 1e-9) / max(1 - shared_mass, 1e-9) for c in (0, 1)]
    before = counts.groupBy("prev").agg(
        F.sum("n1").alias("t1"), F.sum("n0").alias("t0"),
        F.count_if(F.col("n1") > 0).alias("d1"), F.count_if(F.col("n0") > 0).alias("d0"),
    )
    phrases = (
        telling(evidence(fitted, 2), m1, m0).select(F.col("x1").alias("prev"), F.col("x2").alias("word"))
        .join(known.toDF("prev"), "prev", "left_anti").join(known.toDF("word"), "word", "left_anti")
    )
    judged = counts.join(known.toDF("word"), "word", "left_semi").filter("n1 + n0 >= 2")
    judged = judged.unionByName(counts.join(phrases, ["prev", "word"], "left_semi"))
    pairs: dict[tuple[str, str], float] = {}
    for r in judged.join(before, "prev").join(words.select("word", "k"), "word").collect():
        both = []
        for c, n, t, d in ((0, "n1", "t1", "d1"), (1, "n0", "t0", "d0")):
            low = own[r["word"]][c] if r["word"] in own else r["k"] / big * left[c]
            both.append(max(r[n] - DISCOUNT, 0) / r[t] + DISCOUNT * r[d] / r[t] * low if r[t] > 0 else low)
        pairs[r["prev"], r["word"]] = math.log(both[0] / both[1])
    model = Ratios(pairs, {w: math.log(a / b) for w, (a, b) in own.items()}, math.log(left[0] / left[1]))
    return calibrated(model, sample.filter(aside))


def calibrated(model: Ratios, aside: DataFrame) -> Ratios:
    """With the slope and shift of a logistic curve through the documents kept aside."""

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.mean_ratio(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.float64()), batch.column(1)], names=["x", "y"])

    rows = aside.select("text", "label").mapInArrow(ratios, "x double, y int").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], dtype=float)
    slope, shift = logistic(x, y)
    return Ratios(model.pairs, model.words, model.rest, slope, shift)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic regression, by Newton's method, classes weighed alike."""
    if len(np.unique(y)) < 2 or np.ptp(x) == 0:
        return 1.0, 0.0
    scale = x.std()
    a = np.column_stack([x / scale, np.ones(len(x))])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (weight * (p - y)) + ridge * len(y) * w * [1, 0]
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * len(y) * np.diag([1.0, 1e-6])
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0) / scale), float(w[1])


def score_toxicity(docs: DataFrame, model: Ratios, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Whole texts are read. Null, empty and wordless texts have a mean ratio of 0, and the score
    that follows from it. Equal texts get equal scores. One pass, no shuffle. Other columns
    pass through; a new column whose name exists gets an underscore.
    """
    score = free_name("score", docs.columns)
    predicted = free_name("predicted", [*docs.columns, score])
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        for batch in batches:
            found = np.array([ratios.score(t.as_py()) for t in batch.column(at)], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, score, predicted],
            )

    return docs.mapInArrow(
        run,
        T.StructType(
            [*docs.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())]
        ),
    )
