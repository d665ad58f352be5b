"""Sentiment labels: the lexicon in the JVM, or any Python classifier once per distinct text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sentiment import NEUTRAL, Lexicon, lexicon_label, normalise_label

# Answers for a batch of texts; ``one_by_one`` makes one of a function of a single text.
Classifier = Callable[[pd.Series], pd.Series]

#: Tasks that call the model.
MODEL_TASKS = 64


def one_by_one(make_single: Callable[[], Callable[[str], str]]) -> Callable[[], Classifier]:
    """A batch classifier from one that takes a text; a text it fails on is ``neutral``."""

    def make() -> Classifier:
        classify = make_single()

        def safely(value: str) -> str:
            try:
                return classify(value)
            except Exception:
                return NEUTRAL

        return lambda texts: texts.map(safely)

    return make


def label_with_lexicon(
    df: DataFrame, lexicon: Lexicon = Lexicon(), text: str = "description"
) -> DataFrame:
    return df.withColumn("sentiment", lexicon_label(F.col(text), lexicon))


def label_with_classifier(
    df: DataFrame,
    make_classifier: Callable[[], Classifier],
    text: str = "description",
    tasks: int = MODEL_TASKS,
) -> DataFrame:
    """Label each row with a model's answer, asking once per distinct text.

    ``make_classifier`` runs once per task and returns the function that answers for a batch
    of texts; if that fails, the batch is ``neutral``. Distinct texts are told apart by their
    SHA-256, so neither the distinct nor the join shuffles whole texts of a hot copy group: the
    copies collapse map-side. The texts are then dealt to ``tasks`` tasks: a call costs far more
    than its text's bytes, by which Spark would size the partitions, and an explicit number is
    not merged again. (The hash keeps the planner from taking that step for the one before.) Rows without a text are neutral and are not sent to the model; they get
    spread-out keys, so that they do not meet in one task of the join.
    """

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = make_classifier()
        for batch in batches:
            try:
                answers = classify(batch[text])
            except Exception:
                answers = pd.Series(NEUTRAL, index=batch.index)
            yield pd.DataFrame({"_text_key": batch["_text_key"], "_answer": answers})

    no_text = F.concat(F.lit("-"), F.xxhash64(*df.columns).cast("string"))
    keyed = df.withColumn("_text_key", F.coalesce(F.sha2(F.col(text), 256), no_text))
    answers = (
        keyed.filter(F.col(text).isNotNull())
        .groupBy("_text_key")
        .agg(F.any_value(text).alias(text))
        .repartition(tasks, F.xxhash64("_text_key"))
        .mapInPandas(answer, "_text_key string, _answer string")
    )
    return (
        keyed.join(answers, "_text_key", "left")
        .withColumn("sentiment", normalise_label(F.col("_answer")))
        .drop("_text_key", "_answer")
    )
