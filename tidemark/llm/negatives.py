"""Hard negatives for anchors: exact integer inner products, with whole blocks left out by angles.

Every vector's angles to a few reference directions are stored. If x and y make the angles p and q
with a direction, the angle between them is at least |p - q| and at most p + q and 2 pi - p - q. Vectors
are sorted so that neighbours have like angles, and cut into small blocks; a block keeps the least
and the greatest of its angles and norms. That gives an interval of cosines between an anchor
and a block and, times the norms, bounds on the scores in it, widened beyond any rounding. Only where
the bounds meet the window of scores that an anchor still looks for are scores computed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import new_folder, remove, shuffle_width, stored

#: Components are floor(STEPS * x).
STEPS = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score, in percent of the positive's: from LOW to HIGH.
LOW, HIGH = 80, 100
#: Rows of the sample that the reference directions are picked from, and how many are picked.
SAMPLE_ROWS = 2048
DIRECTIONS = 12
#: Rows of a block.
BLOCK = 128
#: Anchors that are broadcast at once; more take further rounds over the blocks.
ANCHORS = 8192
#: Candidates for each search that a task holds on average before it keeps the best of them only.
HELD = 20
#: More than any rounding of an angle, in radians, and of a bound, as a share of the norms' product.
SLACK_ANGLE, SLACK_SCORE = 1e-6, 1e-9
#: Doubles add whole numbers exactly up to 2 ** 53; a hundredth of it leaves room for percentages.
EXACT = float(1 << 53) / 100
#: Stands for a null id inside tasks; sorts last.
NO_ID = (1 << 63) - 1


def usable(vectors: DataFrame, label: Column, vec_id: str, embedding: str) -> DataFrame:
    """(id, label, dim, vec): each different row with a label and a whole, finite vector; vec holds
    floor(STEPS * x) as bytes of doubles, which hold them exactly."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, made, dims = [], [], []
            for i, value in enumerate(batch.column(2)):
                if not value.is_valid or value.values.null_count:
                    continue
                v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(all="ignore"):
                    q = np.floor(v * STEPS) + 0.0
                if not np.isfinite(q).all():
                    continue
                kept.append(i)
                made.append(q.tobytes())
                dims.append(len(q))
            at = pa.array(kept, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(dims, type=pa.int32()), pa.array(made, type=pa.binary())],
                names=["id", "label", "dim", "vec"],
            )

    rows = vectors.select(
        F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("id"), label.cast("string").alias("label"),
        F.col(embedding).alias("embedding"),
    ).filter("label is not null")
    return rows.mapInArrow(convert, "id long, label string, dim int, vec binary").distinct()


def directions(sample: np.ndarray, count: int = DIRECTIONS) -> np.ndarray:
    """Up to ``count`` unit vectors of the sample, each the farthest from those before it."""
    length = np.linalg.norm(sample, axis=1)
    unit = sample[length > 0] / length[length > 0, None]
    if not len(unit):
        return np.empty((0, sample.shape[1]))
    chosen = [0]
    near = unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles(vectors: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angles to the directions); a zero vector's angles are 0, its norm makes bounds exact."""
    big = np.abs(vectors).max(axis=1, initial=1.0)
    norms = np.linalg.norm(vectors / big[:, None], axis=1) * big
    safe = np.where(norms > 0, norms, 1.0)
    return norms, np.arccos(np.clip(vectors / safe[:, None] @ refs.T, -1, 1))


def score_bounds(norms, theirs, low_norm, high_norm, low_angle, high_angle) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of the scores between anchors (norms, angles: n x r) and blocks (m, m x r)."""
    n, m = len(norms), len(low_norm)
    least, most = np.zeros((n, m)), np.full((n, m), math.pi)
    for r in range(theirs.shape[1]):
        own, lo, hi = theirs[:, r, None], low_angle[None, :, r], high_angle[None, :, r]
        np.maximum(least, np.maximum(own - hi, lo - own), out=least)
        # p + q or, beyond pi, 2 pi less it; over the block's q the greatest of these.
        total = np.where(own + lo >= math.pi, 2 * math.pi - own - lo, np.where(own + hi <= math.pi, own + hi, math.pi))
        np.minimum(most, total, out=most)
    high_cos = np.cos(np.maximum(least - SLACK_ANGLE, 0))
    low_cos = np.cos(np.minimum(most + SLACK_ANGLE, math.pi))
    big, small = norms[:, None] * high_norm, norms[:, None] * low_norm
    slack = big * SLACK_SCORE + 1
    return np.minimum(big * low_cos, small * low_cos) - slack, np.maximum(big * high_cos, small * high_cos) + slack


def blocks(rows: DataFrame, refs: dict[int, np.ndarray], size: int = BLOCK) -> DataFrame:
    """Rows sorted by label, nearest direction and the angle to it, in blocks of ``size`` at most.

    Columns: label, dim, n, ids, vecs (n x dim doubles), low and high norm, low and high angles. Equal
    rows are gone before, and ids tell the others of one place apart, so no key is too hot for
    the ranges that rows are dealt out by.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, own = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows)
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                _, theta = angles(_matrix(batch.column(3).take(pa.array(at)), int(dim)), _refs(refs, int(dim)))
                if theta.shape[1]:
                    cell[at] = theta.argmin(axis=1)
                    own[at] = theta.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(own)], names=[*batch.schema.names, "cell", "own"]
            )

    order = ["dim", "label", "cell", "own", "id", "vec"]
    spread = (
        rows.mapInArrow(place, "id long, label string, dim int, vec binary, cell int, own double")
        .repartitionByRange(shuffle_width(rows.sparkSession), *order)
        .sortWithinPartitions(*order)
        .select("dim", "label", "cell", "id", "vec")
    )
    names = ["label", "dim", "n", "ids", "vecs", "norms", "low_angles", "high_angles"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(key, ids: list[int], vecs: list[bytes]) -> list[pa.RecordBatch]:
            if not ids:
                return []
            dim, label, _ = key
            norms, theta = angles(np.frombuffer(b"".join(vecs)).reshape(len(ids), dim), _refs(refs, dim))
            data = [
                [label], [dim], [len(ids)], [np.array(ids, dtype=np.int64).tobytes()], [b"".join(vecs)],
                [np.array([norms.min(), norms.max()]).tobytes()], [theta.min(axis=0).tobytes()], [theta.max(axis=0).tobytes()],
            ]
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
            return [pa.RecordBatch.from_arrays([pa.array(d, type=k) for d, k in zip(data, kinds)], names=names)]

        key, ids, vecs = None, [], []
        for batch in batches:
            for dim, label, cell, id_, vec in zip(*(c.to_pylist() for c in batch.columns)):
                if (dim, label, cell) != key or len(ids) == size:
                    yield from block(key, ids, vecs)
                    key, ids, vecs = (dim, label, cell), [], []
                ids.append(id_)
                vecs.append(vec)
        yield from block(key, ids, vecs)

    return spread.mapInArrow(
        pack,
        "label string, dim int, n int, ids binary, vecs binary, norms binary, low_angles binary, high_angles binary",
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), dim)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers; beyond what doubles hold, as Python's integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return a @ b.T
    ints = [[[int(x) for x in row] for row in m] for m in (a, b)]
    return np.array([[sum(map(int.__mul__, x, y)) for y in ints[1]] for x in ints[0]], dtype=object)


class Best:
    """The first ``keep`` (score falling, id rising) of each search, out of candidates in any order."""

    def __init__(self, searches: int, keep: int):
        self.keep = keep
        #: What a candidate's score must reach; rises as better ones are found.
        self.floor = np.full(searches, -math.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0
        self.room = max(HELD * searches, 4096)

    def add(self, search: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(search):
            self.parts.append((search, score, ids))
            self.held += len(search)
            if self.held > self.room:
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        search, score, ids = (np.concatenate(c) for c in zip(*self.parts))
        if score.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (search[i], -score[i], ids[i])))
        else:
            order = np.lexsort((ids, -score, search))
        search, score, ids = search[order], score[order], ids[order]
        first = np.r_[True, search[1:] != search[:-1]]
        rank = np.arange(len(search)) - np.maximum.accumulate(np.where(first, np.arange(len(search)), 0))
        kept = rank < self.keep
        search, score, ids, rank = search[kept], score[kept], ids[kept], rank[kept]
        full = rank == self.keep - 1
        self.floor[search[full]] = np.nextafter(score[full].astype(float), -math.inf)
        self.parts, self.held = [(search, score, ids)], len(search)
        return self.parts[0]


class Anchors:
    """Anchors of one round, broadcast: ids, labels, vectors by dimension, and angles."""

    def __init__(self, rows: pa.Table, refs: dict[int, np.ndarray]):
        self.ids = rows.column("id").to_numpy()
        self.labels = np.array(rows.column("label").to_pylist(), dtype=object)
        dims = rows.column("dim").to_numpy()
        vecs = rows.column("vec").combine_chunks()
        self.by_dim = {}
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            matrix = _matrix(vecs.take(pa.array(at)), dim)
            norms, theta = angles(matrix, _refs(refs, dim))
            self.by_dim[dim] = (at, matrix, norms, theta)


def _refs(refs: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return refs.get(dim, np.empty((0, dim)))


def _bounded(batch: pa.RecordBatch, anchors: Anchors, at_once: int = 64):
    """(label, ids, vectors, which anchors, their vectors, low and high bounds of the scores) of each
    block, in runs of blocks of one dimension that have anchors; the likeliest blocks of a run first."""
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    dims = column["dim"].to_numpy()
    for dim, (which, matrix, norms, theta) in anchors.by_dim.items():
        own = np.flatnonzero(dims == dim)
        for start in range(0, len(own), at_once):
            part = pa.array(own[start : start + at_once])
            got = {name: c.take(part) for name, c in column.items()}
            sizes = np.array(got["n"].to_pylist())
            reach = _matrix(got["norms"], 2)
            low, high = score_bounds(
                norms, theta, reach[:, 0], reach[:, 1], _matrix(got["low_angles"], theta.shape[1]), _matrix(got["high_angles"], theta.shape[1])
            )
            for b in np.argsort(-high.max(axis=0), kind="stable"):
                ids = np.frombuffer(got["ids"][b].as_buffer(), dtype=np.int64)
                vecs = np.frombuffer(got["vecs"][b].as_buffer()).reshape(sizes[b], dim)
                yield got["label"][b].as_py(), ids, vecs, which, matrix, low[:, b], high[:, b]


def _best_rows(best: Best, anchors: Anchors, each: int) -> Iterator[pa.RecordBatch]:
    search, score, ids = best.settle()
    limit = 1 << 63
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(search // each, type=pa.int64()), pa.array(search % each, type=pa.int64()),
            pa.array([v if -limit <= v < limit else None for v in map(int, score)], type=pa.int64()),
            pa.array(ids, type=pa.int64()),
        ],
        names=["anchor", "which", "score", "id"],
    )


SEARCHED = "anchor long, which long, score long, id long"


def nearest(packed: DataFrame, shared, keep: int = POSITIVES) -> DataFrame:
    """(anchor, which = 0, score, id): the first ``keep`` rows of each anchor's label but itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        best = Best(len(anchors.ids), keep)
        for batch in batches:
            for label, ids, vecs, which, matrix, _, high in _bounded(batch, anchors):
                near = np.flatnonzero((anchors.labels[which] == label) & (high >= best.floor[which]))
                if len(near):
                    scores = exact_scores(vecs, matrix[near])
                    i, j = np.nonzero((scores >= best.floor[which[near]]) & (ids[:, None] != anchors.ids[which[near]]))
                    best.add(which[near[j]], scores[i, j], ids[i])
        yield from _best_rows(best, anchors, 1)

    return _first(packed.mapInArrow(run, SEARCHED), keep)


def within(packed: DataFrame, shared, aims, keep: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor, which, score, id): the first ``keep`` rows of other labels for each anchor and aim, with a
    score from ``low`` to ``high`` percent of the aim. ``aims`` has a row for each anchor, NaN or None for no aim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        aim: np.ndarray = aims.value
        each = aim.shape[1]
        best = Best(aim.size, keep)
        # A little wide: the whole numbers decide below.
        least = np.array([[math.inf if x is None else x * low / 100 - abs(x) * 1e-12 for x in row] for row in aim])
        most = np.array([[-math.inf if x is None else x * high / 100 + abs(x) * 1e-12 for x in row] for row in aim])
        least[most < least] = math.inf
        top = most.max(axis=1)
        for batch in batches:
            for label, ids, vecs, which, matrix, down, up in _bounded(batch, anchors):
                bottom = np.maximum(least, best.floor.reshape(-1, each))[which].min(axis=1)
                near = np.flatnonzero((anchors.labels[which] != label) & (up >= bottom) & (down <= top[which]))
                if not len(near):
                    continue
                scores = exact_scores(vecs, matrix[near])
                i, j = np.nonzero((scores >= bottom[near]) & (scores <= top[which[near]]))
                value, owner = scores[i, j], which[near[j]]
                for k in range(each):
                    target = aim[owner, k]
                    some = np.flatnonzero(
                        (value >= np.maximum(least[owner, k], best.floor[owner * each + k])) & (value <= most[owner, k])
                    )
                    some = some[
                        np.array([low * target[x] <= 100 * int(value[x]) <= high * target[x] for x in some], dtype=bool)
                    ]
                    best.add(owner[some] * each + k, value[some], ids[i[some]])
        yield from _best_rows(best, anchors, each)

    return _first(packed.mapInArrow(run, SEARCHED), keep)


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` of what all tasks found for a search; a task sends that many at most."""
    order = "row_number() over (partition by anchor, which order by score desc, id)"
    return found.withColumn("rank", F.expr(order)).filter(F.col("rank") <= keep)


def hard_negatives(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    label: str | Column = "label",
    embedding: str = "embedding",
    anchors: str = "id % 100 = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    at_once: int = ANCHORS,
) -> DataFrame:
    """For each anchor and positive its hardest negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    A row's score is its inner product with the anchor, of floor(256 * component); higher scores
    come first, ties by smaller id. ``anchors`` is a condition on ``id``. The positives are an
    anchor's first ``positives`` rows of its label but those of its own id; negatives are the first
    ``negatives`` rows of other labels whose score lies from ``low`` to ``high`` percent of the positive's,
    both included, so a positive of a score below zero has none. Rows with a null label, a
    null vector, or a null or infinite component take no part; only vectors of one length are
    compared, and an empty vector scores 0. Equal rows count as one; rows of one id with different
    vectors or labels are different rows. A null id sorts last and is no anchor. A score beyond a
    long is null: such a positive has no negatives. An empty table gives no row. Other columns play no part.

    The anchors are a stated share of the rows; ``at_once`` of them are broadcast in a round, which
    reads all blocks, so no broadcast grows with the table and nothing but the blocks is stored.
    Within a task blocks whose bounds miss what an anchor still looks for are not scored.
    """
    spark = vectors.sparkSession
    rows, rows_folder = stored(usable(vectors, F.col(label) if isinstance(label, str) else label, vec_id, embedding), "vectors")
    sample = rows.orderBy(F.xxhash64("id"), "id", "label", "vec").limit(SAMPLE_ROWS).select("dim", "vec").toArrow()
    dims = sample.column("dim").to_numpy()
    refs = {
        int(dim): directions(_matrix(sample.column("vec").combine_chunks().take(pa.array(np.flatnonzero(dims == dim))), int(dim)))
        for dim in np.unique(dims)
    }
    packed, packed_folder = stored(blocks(rows, refs), "blocks")
    wanted = rows.filter(f"id <> {NO_ID}").filter(anchors)
    rounds = -(-wanted.count() // at_once)
    asked, asked_folder = stored(wanted.withColumn("round", F.expr(f"pmod(xxhash64(id, label, vec), {max(rounds, 1)})")), "anchors")
    folder = new_folder(spark, "negatives")
    for number in range(rounds):
        table = asked.filter(F.col("round") == number).select("id", "label", "dim", "vec").toArrow()
        if not table.num_rows:
            continue
        shared = spark.sparkContext.broadcast(Anchors(table, refs))
        close = nearest(packed, shared, positives).select("anchor", "rank", "score", "id").toArrow().to_pylist()
        aim = np.full((table.num_rows, positives), None, dtype=object)
        for r in close:
            aim[r["anchor"], r["rank"] - 1] = r["score"]
        aims = spark.sparkContext.broadcast(aim)
        names = spark.createDataFrame(
            pa.table(
                {
                    "anchor": pa.array([r["anchor"] for r in close], type=pa.int64()),
                    "which": pa.array([r["rank"] - 1 for r in close], type=pa.int64()),
                    "anchor_id": pa.array([int(shared.value.ids[r["anchor"]]) for r in close], type=pa.int64()),
                    "positive_id": pa.array([r["id"] for r in close], type=pa.int64()),
                    "positive_score": pa.array([r["score"] for r in close], type=pa.int64()),
                }
            )
        )
        found = within(packed, shared, aims, negatives, low, high)
        # At most ``at_once`` times ``positives`` names.
        found.join(F.broadcast(names), ["anchor", "which"]).select(
            "anchor_id", _real("positive_id"), F.col("rank").cast("int").alias("rank"), _real("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(folder)
    for path in (rows_folder, packed_folder, asked_folder):
        remove(spark, path)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(result).parquet(folder) if rounds else spark.createDataFrame([], result)


def _real(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)
