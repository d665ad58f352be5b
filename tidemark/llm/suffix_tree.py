"""Scoring of texts by a probabilistic suffix tree over the bytes of their words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Longest context, in symbols.
DEPTH = 5
#: Contexts of a part of the tree: what is broadcast at once is about this many rows of 64 numbers at most.
CONTEXTS = 1 << 18
#: A context stays if it tells its next symbols apart from its suffix's by so many bits in all.
DIVERGENCE_BITS = 24.0
#: Words that are looked up in the task: those with at least 1 / COMMON of all tokens.
COMMON = 200_000
#: Symbols handled at once.
CHUNK = 1 << 18

BITS = 6
SYMBOLS = 1 << BITS
ESCAPE, END = SYMBOLS - 2, SYMBOLS - 1
#: Last symbols that tell which part of the tree a position belongs to. So many have 4,161 contexts at most.
NEAR = 3
ENDINGS = 1 << BITS * NEAR


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8, A-Z lower-cased; bytes.split parts at exactly the six ASCII spaces."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


@dataclass(frozen=True)
class Alphabet:
    """62 bytes with a symbol of their own; the others share the escape, evenly."""

    symbol: np.ndarray
    escaped: int

    @classmethod
    def of(cls, counts: np.ndarray) -> Alphabet:
        top = np.argsort(-counts, kind="stable")[:ESCAPE]
        symbol = np.full(256, ESCAPE, dtype=np.uint8)
        symbol[top] = np.arange(len(top), dtype=np.uint8)
        return cls(symbol, 256 - len(top))


def symbol_stream(texts: list[list[bytes]], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, lengths): each text as DEPTH end symbols, its words with a space after each, an end.

    The leading end symbols are the context of a text's beginning and are never predicted.
    """
    bodies = [b" ".join(words) + b" " if words else b"" for words in texts]
    lengths = np.array([len(b) for b in bodies], dtype=np.int64)
    flat = alphabet.symbol[np.frombuffer(b"".join(bodies), dtype=np.uint8)]
    total = lengths + DEPTH + 1
    stream = np.full(int(total.sum()), END, dtype=np.uint8)
    starts = np.cumsum(total) - total + DEPTH
    stream[np.arange(len(flat)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)] = flat
    return stream, lengths


def grams(stream: np.ndarray) -> np.ndarray:
    """The DEPTH + 1 symbols that end at each position from DEPTH on, packed into an integer."""
    n = len(stream) - DEPTH
    packed = np.zeros(n, dtype=np.int64)
    for k in range(DEPTH + 1):
        packed <<= BITS
        packed |= stream[k : k + n]
    return packed


def predicted(lengths: np.ndarray) -> np.ndarray:
    """Positions of ``grams`` that are part of a text, not of the lead-in of the next one."""
    total = lengths + DEPTH + 1
    n = int(total.sum()) - DEPTH
    keep = np.ones(n, dtype=bool)
    for k in range(DEPTH):
        keep[(np.cumsum(total)[:-1] + k) - DEPTH] = False
    return keep


def text_groups(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each text) for runs of texts of about ``limit`` bytes together.

    Only one run at a time is taken apart; a longer text is a run of its own.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    first, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= limit or i == len(sizes) - 1:
            yield first, [words_of(v.as_py()) for v in column.slice(first, i + 1 - first)]
            first, held = i + 1, 0


def byte_counts(training: DataFrame, text: str) -> np.ndarray:
    """How often each byte occurs in lower-cased training words: 256 sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass").lower()
                sums += np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(sums)], names=["byte", "n"])

    rows = training.select(text).mapInArrow(count, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n"))
    counts = np.zeros(256, dtype=np.int64)
    for row in rows.collect():
        counts[row["byte"]] = row["n"]
    counts[[9, 10, 11, 12, 13]] = 0  # white space becomes a single space
    return counts


def word_counts(training: DataFrame, text: str) -> DataFrame:
    """(word: binary, n): counts over all training texts; tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), type=pa.binary()), pa.array(list(held.values()), type=pa.int64())],
                names=["word", "n"],
            )

        held: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                held.update(words_of(value.as_py()))
                if len(held) > 300_000:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    return training.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(training: DataFrame, text: str, alphabet: Alphabet) -> DataFrame:
    """(gram, n): how often each run of DEPTH + 1 symbols occurs, over all training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            sums = np.bincount(inverse, weights=np.concatenate([n for _, n in parts]))
            return keys, sums.astype(np.int64)

        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            for _, texts in text_groups(batch.column(0), 4 * CHUNK):
                stream, lengths = symbol_stream(texts, alphabet)
                parts.append(np.unique(grams(stream)[predicted(lengths)], return_counts=True))
                held += len(parts[-1][0])
                if held > 2_000_000:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > 1_000_000:  # hand on, so that memory stays bounded
                        yield pa.RecordBatch.from_arrays([*map(pa.array, parts[0])], names=["gram", "n"])
                        parts, held = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([*map(pa.array, merged(parts))], names=["gram", "n"])

    return training.select(text).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def context_key(depth: int) -> str:
    """SQL: the context of a gram as a number that tells its length too, by a leading one."""
    return f"(((gram >> {BITS}) & {(1 << BITS * depth) - 1}L) | {1 << BITS * depth}L)"


def next_counts(counted: DataFrame) -> DataFrame:
    """(depth, context, symbol, n, total): next symbols of contexts of every length."""
    levels, level = [], counted
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            kept = (1 << BITS * (depth + 1)) - 1
            level = level.groupBy(F.expr(f"gram & {kept}L").alias("gram")).agg(F.sum("n").alias("n"))
        levels.append(
            level.selectExpr(
                f"{depth} as depth", f"{context_key(depth)} as context", f"gram & {SYMBOLS - 1}L as symbol", "n"
            )
        )
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    # At most 64 rows a context.
    return every.selectExpr("*", "sum(n) over (partition by context) as total").filter(
        f"depth = 0 or total * {BITS} >= {DIVERGENCE_BITS}"
    )


def divergences(following: DataFrame) -> DataFrame:
    """(context, depth, gain): bits that a context saves over its suffix on its own next symbols."""
    suffix = F.expr(
        f"(context & (shiftleft(1L, {BITS} * (depth - 1)) - 1)) | shiftleft(1L, {BITS} * (depth - 1))"
    )
    own = following.filter("depth > 0").withColumn("suffix", suffix)
    parents = following.selectExpr("context as suffix", "symbol", "n as p_n", "total as p_total")
    return (
        own.join(parents, ["suffix", "symbol"])
        .groupBy("context", "depth")
        .agg(F.sum(F.expr("n * log2((n / total) / (p_n / p_total))")).alias("gain"))
    )


@dataclass(frozen=True)
class SuffixTree:
    """Contexts (sorted keys) and, for each, log10 of every next symbol's probability.

    A part of a tree scores the positions whose last ``NEAR`` symbols, as a number, are from
    ``low`` on and below ``high``; it holds all contexts that end so, and the shorter ones."""

    keys: np.ndarray
    log10: np.ndarray
    alphabet: Alphabet
    low: int = 0
    high: int = ENDINGS

    @classmethod
    def of(
        cls, contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray, alphabet: Alphabet,
        low: int = 0, high: int = ENDINGS,
    ) -> SuffixTree:
        """Smooth from the root down: a context's counts, then its suffix's distribution with a
        weight of one for each different symbol seen."""
        keys = np.unique(np.append(contexts, 1))
        at = np.searchsorted(keys, contexts)
        table = np.zeros((len(keys), SYMBOLS))
        table[at, symbols] = counts
        depths = (np.frexp(keys.astype(float))[1] - 1) // BITS
        for depth in range(int(depths.max()) + 1):
            rows = np.flatnonzero(depths == depth)
            if depth == 0:
                table[rows] = (table[rows] + 0.5) / (table[rows].sum() + 0.5 * SYMBOLS)
                continue
            mask = (1 << BITS * (depth - 1)) - 1
            parent = np.searchsorted(keys, (keys[rows] & mask) | (mask + 1))
            weight = np.maximum((table[rows] > 0).sum(axis=1, keepdims=True), 1)
            total = table[rows].sum(axis=1, keepdims=True)
            table[rows] = (table[rows] + weight * table[parent]) / (total + weight)
        if alphabet.escaped:
            table[:, ESCAPE] /= alphabet.escaped
        return cls(keys, np.log10(table).astype(np.float32), alphabet, low, high)

    def lookup(self) -> Lookup:
        return Lookup(self)


class Lookup:
    """Finds the longest suffix state of many positions at once.

    The states of contexts up to three symbols come from an array by position; longer contexts
    from a hash table, tried only where the next shorter one is a state.
    """

    def __init__(self, tree: SuffixTree):
        self.tree = tree
        keys = tree.keys
        self.near = np.zeros(ENDINGS, dtype=np.int32)
        self.deeper = np.zeros(len(self.near), dtype=bool)
        codes = np.arange(len(self.near), dtype=np.int64)
        for depth in range(min(NEAR, DEPTH) + 1):
            wanted = (codes & ((1 << BITS * depth) - 1)) | (1 << BITS * depth)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            there = keys[at] == wanted
            self.near[there] = at[there]
            self.deeper = there
        self.shift = np.uint64(64 - max(12, int(4 * len(keys)).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), dtype=np.int64)
        self.values = np.zeros(len(self.slots), dtype=np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.slots[slot] == 0
            first = np.zeros(len(left), dtype=bool)
            _, lead = np.unique(slot, return_index=True)
            first[lead] = True
            taken = free & first
            self.slots[slot[taken]], self.values[slot[taken]] = keys[left[taken]], left[taken]
            left, slot = left[~taken], (slot[~taken] + 1) % len(self.slots)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The state of each key, or -1."""
        slot = self._slot(keys)
        seen = self.slots[slot]
        found = np.where(seen == keys, self.values[slot], -1)
        open_ = np.flatnonzero((seen != keys) & (seen != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self.slots)
            seen = self.slots[slot[open_]]
            hit = seen == keys[open_]
            found[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (seen != 0)]
        return found

    def log10_of(self, packed: np.ndarray) -> np.ndarray:
        context = packed >> BITS
        near = context & (ENDINGS - 1)
        state = self.near[near].astype(np.int64)
        active = np.flatnonzero(self.deeper[near])
        for depth in range(NEAR + 1, DEPTH + 1):
            keys = (context[active] & ((1 << BITS * depth) - 1)) | (1 << BITS * depth)
            found = self._find(keys)
            there = found >= 0
            active = active[there]
            state[active] = found[there]
        return self.tree.log10[state, packed & (SYMBOLS - 1)]

    def scores(self, texts: list[list[bytes]]) -> np.ndarray:
        """log10 of the probability of each text, or what the tree's part adds to it."""
        result = np.zeros(len(texts))
        stream, lengths = symbol_stream(texts, self.tree.alphabet)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths + DEPTH + 1)
        keep = predicted(lengths)
        for s in range(0, len(keep), CHUNK):
            packed = grams(stream[s : s + CHUNK + DEPTH])[keep[s : s + CHUNK]]
            own = owner[s : s + len(keep[s : s + CHUNK])][keep[s : s + CHUNK]]
            if self.tree.high - self.tree.low < ENDINGS:
                ending = (packed >> BITS) & (ENDINGS - 1)
                inside = (ending >= self.tree.low) & (ending < self.tree.high)
                packed, own = packed[inside], own[inside]
            result += np.bincount(own, weights=self.log10_of(packed), minlength=len(texts))
        return result


def with_suffixes(contexts: DataFrame) -> DataFrame:
    """(context): those given by (context, depth), all their suffixes and the root, each once."""
    chain = f"transform(sequence(0, depth), d -> (context & (shiftleft(1L, {BITS} * d) - 1)) | shiftleft(1L, {BITS} * d))"
    root = contexts.sparkSession.range(1, 2).toDF("context")
    return contexts.select(F.explode(F.expr(chain)).alias("context")).unionByName(root).distinct()


def shares(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """Runs (low, high) of all endings in order: as many as ``room`` contexts allow, one at least."""
    runs, low, held = [], 0, 0
    for ending in np.flatnonzero(counts).tolist():
        if held and held + counts[ending] > room:
            runs.append((low, ending))
            low, held = ending, 0
        held += int(counts[ending])
    return [*runs, (low, ENDINGS)]


def learn_parts(training: DataFrame, text: str = "text", contexts: int | None = CONTEXTS) -> Iterator[SuffixTree]:
    """A tree from the counts of all training texts, in parts of ``contexts`` contexts.

    Symbols are the bytes of the lower-cased words, a space after each word, and an end. A
    context of up to ``DEPTH`` symbols stays if its next symbols diverge from those of its
    suffix by ``DIVERGENCE_BITS`` in all, and it occurs once for each ``BITS`` of them.
    Suffixes of what stays come along. All that stay are in the tree: if they are more than
    ``contexts``, each part has those of a run of endings, and the parts' scores add up to the
    tree's. The counting and the tests run on Spark over all texts; the driver gets one part's
    contexts and their counts at a time, bounded by ``contexts`` rows of 64, and before that
    how many contexts have each of the ``ENDINGS``. No training text leaves a tree that
    spreads probability evenly.
    """
    alphabet = Alphabet.of(byte_counts(training, text))
    following = cut(next_counts(cut(gram_counts(training, text, alphabet))))
    passed = divergences(following).filter(F.col("gain") >= DIVERGENCE_BITS).select("context", "depth")
    kept = cut(with_suffixes(passed))
    ending = F.expr(f"if(context < {ENDINGS}, null, context & {ENDINGS - 1})")
    found = kept.groupBy(ending.alias("ending")).count().toArrow().to_pandas()
    short = found["ending"].isna()
    counts = np.zeros(ENDINGS, dtype=np.int64)
    counts[found["ending"][~short].astype(np.int64)] = found["count"][~short]
    top = int(found["count"][short].sum())
    whole = contexts is None or top + counts.sum() <= contexts
    for low, high in [(0, ENDINGS)] if whole else shares(counts, contexts - top):
        part = kept if whole else kept.filter(
            (F.col("context") < ENDINGS) | F.expr(f"(context & {ENDINGS - 1}) >= {low} and (context & {ENDINGS - 1}) < {high}")
        )
        rows = following.join(F.broadcast(part), "context").select("context", "symbol", "n").toArrow()
        yield SuffixTree.of(*(rows.column(i).to_numpy() for i in range(3)), alphabet, low, high)


def learn_tree(training: DataFrame, text: str = "text") -> SuffixTree:
    """All parts in one, however large."""
    return next(learn_parts(training, text, None))


def score_texts(
    docs: DataFrame, training: DataFrame, doc_id: str = "doc_id", text: str = "text", contexts: int = CONTEXTS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is log10 of the text's probability by the suffix tree. ``base_score`` is that of
    single words with one added to each count: the sum over tokens, an end included, of
    log10((c + 1) / (N + V + 1)). Null and empty texts are a single end. Repeated rows give
    repeated results, and rows of one doc_id with different texts their own. A null doc_id is
    carried. Without training rows N and V are 0. Other columns play no part.

    Words with at least 1 / ``COMMON`` of the tokens, so at most that many, are looked up in
    the task; the rest go through a join on the word. Each text is read once here: its row with
    the parts that are known goes through the same join under a name that no word can have.
    A tree of more than ``contexts`` is broadcast in parts, and for each part after the first
    the texts are read once more: memory is bounded by one part, and no context is dropped.
    """
    spark = docs.sparkSession
    shared, *others = [spark.sparkContext.broadcast(part) for part in learn_parts(training, text, contexts)]
    counted = cut(word_counts(training, text))
    ends, (tokens, distinct) = training.count(), counted.agg(F.sum("n"), F.count("*")).first()
    total = (tokens or 0) + ends
    size = total + distinct + (1 if ends else 0) + 1
    frequent = counted.filter(F.col("n") * COMMON >= total).select("word", "n").toArrow()
    common = spark.sparkContext.broadcast(
        {w.as_py(): math.log10((n.as_py() + 1) / size) for w, n in zip(*frequent.columns)}
    )
    end_log = math.log10((ends + 1) / size)

    names = ["id", "text_hash", "word", "tf", "n_tokens", "n_known", "base", "score"]
    kinds = [pa.int64()] * 2 + [pa.binary()] + [pa.int64()] * 3 + [pa.float64()] * 2

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lookup = common.value, shared.value.lookup()
        for batch in batches:
            for first, texts in text_groups(batch.column(2)):
                ids = batch.column(0).slice(first, len(texts)).to_pylist()
                hashes = batch.column(1).slice(first, len(texts)).to_pylist()
                out: list[tuple] = []
                for id_, h, words, found in zip(ids, hashes, texts, lookup.scores(texts).tolist()):
                    logs = [known.get(w) for w in words]
                    seen = [x for x in logs if x is not None]
                    name = b" %d %d" % (id_ or 0, h)
                    out.append((id_, h, name, 0, len(words) + 1, len(seen) + (ends > 0), math.fsum(seen) + end_log, found))
                    rare = Counter(w for w, x in zip(words, logs) if x is None)
                    out.extend((id_, h, w, tf, None, 0, 0.0, None) for w, tf in rare.items())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)

    def score_more(part: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = part.value.lookup()
            for batch in batches:
                for first, texts in text_groups(batch.column(2)):
                    ids = batch.column(0).slice(first, len(texts)).to_pylist()
                    hashes = batch.column(1).slice(first, len(texts)).to_pylist()
                    out = [
                        (id_, h, b" %d %d" % (id_ or 0, h), 0, None, 0, 0.0, found)
                        for id_, h, found in zip(ids, hashes, lookup.scores(texts).tolist())
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)

        return score

    read = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )
    schema = "id long, text_hash long, word binary, tf long, n_tokens long, n_known long, base double, score double"
    parts = read.mapInArrow(score, schema)
    for other in others:
        parts = parts.unionByName(read.mapInArrow(score_more(other), schema))
    rare_counts = counted.filter(F.col("n") * COMMON < total)
    c = F.coalesce(F.col("n"), F.lit(0))
    summed = (
        parts.join(rare_counts, "word", "left")
        .groupBy("id", "text_hash")
        .agg(
            F.count("n_tokens").alias("copies"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(c > 0, F.col("tf")).otherwise(0)).alias("known"),
            F.sum(F.col("base") + F.col("tf") * F.log10((c + 1) / F.lit(float(size)))).alias("base"),
            F.max(F.when(F.col("n_tokens").isNotNull(), F.col("score"))).alias("score"),
            F.coalesce(F.sum(F.when(F.col("n_tokens").isNull(), F.col("score"))), F.lit(0.0)).alias("more"),
        )
    )
    return summed.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)"))).select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.expr("known div copies").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") + F.col("more") / F.col("copies")).alias("score"),
    )
