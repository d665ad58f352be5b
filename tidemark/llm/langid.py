"""Language identification by compression against a dictionary of each language."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name
from tidemark.llm.samples import likely

UNKNOWN = "und"
#: Bound of the sample that the dictionaries are made of: rows of each language, and their bytes.
SAMPLE_ROWS = 400
DICTIONARY_BYTES = 64 * 1024
LEVEL = 6
#: Texts are compressed in blocks, so that a long one keeps meeting the dictionary and not its own past.
BLOCK = 4096
#: Long texts enter a dictionary by so many characters' worth of blocks, spread over the whole text.
SPREAD = 16
SPREAD_BLOCK = 1024
#: A margin below this share of the second-best size rejects the prediction of a text with at
#: least so many bytes of letters; in shorter ones the sizes are too coarse to tell.
MARGIN = 0.01
EVIDENCE = 256

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case letters, and a space for each run of anything else."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def learn_dictionaries(
    labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES
) -> dict[str, bytes]:
    """A raw-content dictionary for each language: texts of a sample, up to ``size`` bytes.

    The sample is bounded: of each language the ``rows`` different texts with the lowest hash,
    of a text longer than ``SPREAD`` blocks that many blocks spread over all of it. Texts that
    repeat count once, also for the size of a language that the sample is chosen by. Rows
    without text or language teach nothing. The sample, at most rows x 16,384 characters a
    language, is the only thing that reaches the driver. Languages come by falling number of
    different texts, then by name, and ties between them go to the first.
    """
    width = SPREAD * SPREAD_BLOCK
    spread = (
        f"if(length(t) <= {width}, t, array_join(transform(sequence(0, {SPREAD - 1}), i -> "
        f"substring(t, cast(floor(i * (length(t) - {SPREAD_BLOCK}) / {SPREAD - 1}) as int) + 1, {SPREAD_BLOCK})), ' '))"
    )
    usable = labelled.filter(f"`{lang}` is not null and length(trim(`{text}`)) > 0").select(
        F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("t")
    )
    distinct = usable.select("lang", "h").distinct()
    counts = {r["lang"]: r["count"] for r in distinct.groupBy("lang").count().collect()}
    names = sorted(counts, key=lambda n: (-counts[n], n))
    sizes = labelled.sparkSession.createDataFrame(list(counts.items()), "lang string, size long")
    # Only hashes go through the ranking, and few of them; the texts of those that are chosen are fetched after.
    chosen = (
        distinct.join(F.broadcast(sizes), "lang")
        .filter(likely(F.col("h"), rows, F.col("size")))
        .select("lang", "h")
        .withColumn("n", F.expr("row_number() over (partition by lang order by pmod(h, 1099511627776), h)"))
        .filter(F.col("n") <= rows)
        .drop("n")
    )
    found = (
        usable.join(F.broadcast(chosen), ["lang", "h"])
        .select("lang", "h", F.expr(spread).alias("t")).dropDuplicates(["lang", "h"])
    )
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for row in found.collect():
        texts.setdefault(row["lang"], []).append((row["h"], letters(row["t"])))
    learned = {}
    for name in (n for n in names if n in texts):
        parts, room = [], size
        for _, data in sorted(texts[name]):
            if 0 < len(data[: size // 4]) < room:
                data = data[: size // 4]
                parts.append(data)
                room -= len(data) + 1
        if parts:
            learned[name] = b" ".join(parts)
    return learned


class Classifier:
    """Compresses a text with every dictionary; the language whose output is smallest wins."""

    def __init__(self, dictionaries: Mapping[str, bytes], margin: float = MARGIN):
        import zstandard

        self.names = list(dictionaries)
        self.margin = margin
        self.compressors = []
        for data in dictionaries.values():
            content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=content,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected). Equal sizes go to the first name.

        The margin is what the best saves of the second-best size. The score, 0 to 1, is the
        winner's share if each byte less in a block of average length doubles a language's odds.
        """
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0, True
        data = letters(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.compressors], dtype=float)
        best = int(sizes.argmin())
        odds = np.exp2(-np.minimum((sizes - sizes[best]) / len(blocks), 1000.0))
        second = np.delete(sizes, best).min() if len(sizes) > 1 else 2 * sizes[best]
        margin = float(1 - sizes[best] / second)
        narrow = len(data) >= EVIDENCE and margin < self.margin
        return self.names[best], float(odds[best] / odds.sum()), margin, narrow


_LOADED: dict[int, Classifier] = {}


def _classifier(dictionaries: Mapping[str, bytes], margin: float) -> Classifier:
    key = hash((margin, *dictionaries.items()))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Classifier(dictionaries, margin)
    return _LOADED[key]


def identify(
    docs: DataFrame, dictionaries: Mapping[str, bytes], text: str = "text", margin: float = MARGIN
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``margin`` and ``rejected``.

    A text that is null or has no letter is ``und`` with score 0, and rejected; so is every
    text if nothing was learned. A margin below ``margin`` rejects a text of ``EVIDENCE`` bytes
    of letters or more, but keeps its language for those who want it. Whole texts are compressed,
    in blocks. Equal texts get equal results. Other columns pass through; a new column whose name exists gets an underscore. One pass, no
    shuffle; the dictionaries travel with the task, at most ``DICTIONARY_BYTES`` a language.
    """
    new = []
    for name in ("lang_pred", "score", "margin", "rejected"):
        new.append(free_name(name, [*docs.columns, *new]))
    at = docs.columns.index(text)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(new[0], T.StringType()),
            T.StructField(new[1], T.DoubleType()),
            T.StructField(new[2], T.DoubleType()),
            T.StructField(new[3], T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _classifier(dictionaries, margin)
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(at)]
            names = pa.array([f[0] for f in found], type=pa.string())
            scores = pa.array([f[1] for f in found], type=pa.float64())
            margins = pa.array([f[2] for f in found], type=pa.float64())
            rejected = pa.array([f[3] for f in found], type=pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, names, scores, margins, rejected], names=[*batch.schema.names, *new]
            )

    return docs.mapInArrow(run, schema)


