"""Headline labels as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three labels that the gold counters know.
GOOD = "good"
BAD = "bad"
NEUTRAL = "neutral"

WHITESPACE = " \t\n\r\x0b\x0c"
WORD_BREAK = "[^a-z]+"


@dataclass(frozen=True)
class Lexicon:
    """Words that speak for a good or a bad headline, in lower case."""

    good: Iterable[str] = field(
        default=(
            "beat", "beats", "boost", "boosts", "gain", "gains", "growth", "jump", "jumps",
            "profit", "profits", "rally", "record", "rise", "rises", "soar", "soars",
            "strong", "surge", "surges", "upgrade", "upgraded", "win", "wins",
        )
    )
    bad: Iterable[str] = field(
        default=(
            "crash", "cut", "cuts", "decline", "declines", "downgrade", "downgraded", "drop",
            "drops", "fall", "falls", "fraud", "lawsuit", "layoffs", "loss", "losses", "miss",
            "misses", "plunge", "plunges", "probe", "recall", "slump", "weak",
        )
    )


def lexicon_label(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """Label a whole text by which word list it shares more distinct words with.

    NULL text is neutral, and so is a draw. The expression is narrow: no shuffle, no Python.
    """
    words = F.split(F.lower(text), WORD_BREAK)

    def hits(vocabulary: Iterable[str]) -> Column:
        listed = F.array(*[F.lit(w) for w in vocabulary])
        return F.size(F.array_intersect(words, listed))

    # The score stands in one place and under no condition, so the text is split once.
    score = F.signum(hits(lexicon.good) - hits(lexicon.bad)).cast("int")
    labels = F.array(F.lit(BAD), F.lit(NEUTRAL), F.lit(GOOD))
    return F.element_at(labels, F.coalesce(score, F.lit(0)) + 2)


def normalise_label(answer: Column) -> Column:
    """Strip and lower-case an answer; no answer is neutral, an off-list answer is kept."""
    return F.coalesce(F.lower(F.trim(answer, F.lit(WHITESPACE))), F.lit(NEUTRAL))
