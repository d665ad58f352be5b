"""Near-duplicate vectors by lattice hashing: random projections decoded to points of E8."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, shuffle_width
from tidemark.llm.components import connected_components, merge_labels

COSINE = 0.98
TABLES = 5
#: Edge of the lattice against the unit sphere, for projections of 8 of the dimensions.
SCALE = 0.25
#: Members that a cell should hold on average; beyond it cells are made of more projections.
CELL = 400
#: Members of a cell or component that one task compares; more are dealt into chunks.
CHUNK = 8192
SEED = 20_417


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps from a lattice point to its neighbours."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-1.0, 1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    half = [v for v in product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + [np.array(v) for v in half])


ROOTS = _roots()


def nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points of even coordinate sum: round, then turn the worst coordinate."""
    point = np.round(x)
    off = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8, which is the even points and the even points moved by one half."""
    a, b = nearest_even(x), nearest_even(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def projections(dimension: int, table: int, blocks: int) -> list[np.ndarray]:
    """Orthonormal directions, eight for each block, fixed by the table's number."""
    made = []
    for block in range(blocks):
        rng = np.random.default_rng([SEED, dimension, table, block])
        gauss = rng.standard_normal((dimension, 8))
        made.append(np.linalg.qr(gauss)[0] if dimension >= 8 else gauss / np.sqrt(8))
    return made


def _mixed(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    mixed = (key ^ value) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def cells(unit: np.ndarray, tables: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(home, near): for each vector and table the cell it lies in, and the closest cell beside it.

    The neighbour differs in the block whose point is contested most: the step to another
    lattice point that costs least.
    """
    n, dimension = unit.shape
    home, near = np.empty((n, tables), np.uint64), np.empty((n, tables), np.uint64)
    scale = SCALE * np.sqrt(64 / max(dimension, 8))
    for table in range(tables):
        points, others, costs = [], [], []
        for directions in projections(dimension, table, blocks):
            x = unit @ directions / scale
            point = decode(x)
            gain = (x - point) @ ROOTS.T
            step = gain.argmax(axis=1)
            points.append(point)
            others.append(point + ROOTS[step])
            costs.append(-gain[np.arange(n), step])
        contested = np.argmin(costs, axis=0)
        for target, moved in ((home, False), (near, True)):
            key = np.full(n, table + 1, dtype=np.uint64)
            for block in range(blocks):
                at = points[block]
                if moved:
                    at = np.where((contested == block)[:, None], others[block], at)
                code = np.ascontiguousarray((2 * at).astype(np.int8)).view(np.uint64)[:, 0]
                key = _mixed(key, code)
            target[:, table] = key
    return home, near


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors that are stored as bytes of doubles, all of one length."""
    rows = [np.frombuffer(v.as_buffer(), dtype=np.float64) for v in column]
    return np.array(rows) if rows else np.empty((0, 0))


def usable(vectors: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """(id, label, vec): rows that can link; vec holds the vector at length one, as bytes of doubles.

    Left out are null labels and vectors that are null, empty or zero or hold a null or a
    non-finite component. The label carries the vector's length, as vectors of different
    lengths have no cosine.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, units = [], []
            for i, value in enumerate(batch.column(2)):
                if not value.is_valid or value.values.null_count or not len(value.values):
                    continue
                v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(all="ignore"):
                    big = np.abs(v).max()
                    length = np.linalg.norm(v / big) if np.isfinite(big) and big > 0 else 0.0
                if length > 0:
                    kept.append(i)
                    units.append((v / big / length).tobytes())
            at = pa.array(kept, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(units, type=pa.binary())],
                names=["id", "label", "vec"],
            )

    rows = vectors.filter(F.col(label).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"),
        F.concat_ws(":", F.size(F.col(embedding)), F.col(label).cast("string")).alias("label"),
        F.col(embedding).alias("embedding"),
    )
    return rows.mapInArrow(convert, "id long, label string, vec binary")


def dealt(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``rows`` (keys, rep, weight, home, vec) dealt out for comparison: with chunk, i and j.

    A key of at most ``CHUNK`` members is one group, (0, 0). A larger one is cut into chunks by
    a hash of the member, and each pair of chunks is a group, so that no task holds more than
    two chunks. Only such keys are broadcast: at most one for every ``CHUNK`` rows.
    """
    large = (
        rows.groupBy(*keys).agg(F.count("*").alias("size")).filter(F.col("size") > CHUNK)
        .withColumn("chunks", F.ceil(F.col("size") / CHUNK)).drop("size")
    )
    chunks = F.coalesce("chunks", F.lit(1))
    pairs = F.expr(
        "transform(sequence(0L, coalesce(chunks, 1L) - 1), x -> struct(least(x, chunk) as i, greatest(x, chunk) as j))"
    )
    return (
        rows.join(F.broadcast(large), keys, "left")
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks))
        .withColumn("pair", F.explode(pairs))
        .select(*keys, "pair.i", "pair.j", "chunk", "rep", "weight", "home", "vec")
        .repartition(width, *keys, "i", "j")
        .sortWithinPartitions(*keys, "i", "j", "rep")
    )


Compare = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def per_group(rows: DataFrame, keys: list[str], compare: Compare, columns: tuple[str, str]) -> DataFrame:
    """Run ``compare`` (left?, right?, rep, weight, home, vectors) on each group of ``dealt`` rows."""
    schema = f"{columns[0]} long, {columns[1]} long"
    group_by = [*keys, "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            i, j, chunk, rep, weight, home = (
                whole.column(c).to_numpy() for c in ("i", "j", "chunk", "rep", "weight", "home")
            )
            vec = whole.column("vec").chunk(0)
            a, b = compare((chunk == i[0], chunk == j[0]), rep, weight, home, _matrix(vec))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=list(columns))

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keyed = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in group_by)))
            start = 0
            for at in range(batch.num_rows):
                if last is not None and keyed[at] != last:
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    if sum(h.num_rows for h in held) > 1:
                        yield flush()
                    held.clear()
                    start = at
                last = keyed[at]
            held.append(batch.slice(start))
        if sum(h.num_rows for h in held) > 1:
            yield flush()

    return rows.mapInArrow(run, schema)


def close_pairs(sides, vectors: np.ndarray, rows: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of cosine at least ``COSINE`` between the two sides, each pair once, block by block."""
    left, right = (np.flatnonzero(s) for s in sides)
    same = len(left) == len(right) and np.array_equal(left, right)
    for s in range(0, len(left), rows):
        a, b = np.nonzero(vectors[left[s : s + rows]] @ vectors[right].T >= COSINE)
        if same:
            later = b > a + s
            a, b = a[later], b[later]
        yield left[a + s], right[b]


def star_links(sides, rep, weight, home, vectors) -> tuple[np.ndarray, np.ndarray]:
    """One link for each member but one of every component; a pair of visitors does not count."""
    labels = np.arange(len(rep))
    for a, b in close_pairs(sides, vectors):
        met = home[a] | home[b]
        labels = merge_labels(len(rep), a[met], b[met], labels)
    linked = np.flatnonzero(labels != np.arange(len(rep)))
    return rep[linked], rep[labels[linked]]


def link_counts(sides, rep, weight, home, vectors) -> tuple[np.ndarray, np.ndarray]:
    """For each member that has links, the number of vectors at their other ends."""
    counts = np.zeros(len(rep), dtype=np.int64)
    for a, b in close_pairs(sides, vectors):
        np.add.at(counts, a, weight[b])
        np.add.at(counts, b, weight[a])
    some = np.flatnonzero(counts)
    return rep[some], counts[some]


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    tables: int = TABLES,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine, in doubles, is at
    least ``COSINE``. Vectors that are null, zero or hold a null or non-finite component link
    with nothing and are components of their own, as are rows without a label. Equal vectors
    of a label are compared as one and counted as many; repeated rows are vectors like others.
    A null vec_id is carried and gives no name to a component that has others. Other columns
    play no part.

    Candidates are those that share a lattice cell in one of the tables, or of which one's cell
    is the closest beside the other's. In each cell cosines are verified and one link for each
    member leaves, never all pairs; the links give components. Every link of a vector stays
    within its component, so exact counts come from comparing the members of components,
    whatever the tables found. Cells are sized by the number of vectors.
    """
    rows = cut(usable(vectors, vec_id, label, embedding))
    reps = cut(
        rows.groupBy("label", "vec")
        .agg(F.min("id").alias("least"), F.count("*").alias("weight"))
        .withColumn("rep", F.xxhash64("label", "vec"))
    )
    largest = reps.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = 1
    while largest > CELL * 100**blocks and blocks < 4:
        blocks += 1
    made = tables * (1, 2, 4, 8)[blocks - 1]
    width = max(shuffle_width(vectors.sparkSession), largest * made // 200_000)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(3)
            sizes = np.array([len(v.as_buffer()) for v in data])
            found: list[list[int] | None] = [None] * batch.num_rows
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                home, near = cells(_matrix(data.take(pa.array(at))), made, blocks)
                both = np.concatenate([home, near], axis=1).view(np.int64)
                for k, row in zip(at.tolist(), both.tolist()):
                    found[k] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, type=pa.list_(pa.int64()))], names=[*batch.schema.names, "cells"]
            )

    placed = cut(
        reps.select("rep", "label", "weight", "vec").mapInArrow(
            place, "rep long, label string, weight long, vec binary, cells array<long>"
        )
    )
    members = placed.select("rep", "label", "weight", "vec", F.posexplode("cells").alias("at", "cell")).select(
        "label", "cell", "rep", "weight", (F.col("at") < made).alias("home"), "vec"
    )
    links = per_group(dealt(members, ["label", "cell"], width), ["label", "cell"], star_links, ("a", "b"))
    roots = connected_components(links)
    grouped = cut(
        reps.join(roots.withColumnRenamed("node", "rep"), "rep").select(
            "root", "rep", "weight", F.lit(True).alias("home"), "vec", "least"
        )
    )
    counted = (
        per_group(dealt(grouped.drop("least"), ["root"], width), ["root"], link_counts, ("rep", "others"))
        .groupBy("rep").agg(F.sum("others").alias("others"))
    )
    names = grouped.groupBy("root").agg(F.min("least").alias("first"))
    found = cut(
        grouped.select("rep", "root").join(cut(names), "root").join(cut(counted), "rep", "left").select("rep", "first", "others")
    )
    known = cut(
        reps.select("rep", "weight", "least").join(found, "rep", "left").select(
            "rep", F.coalesce("first", "least").alias("first"),
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    linked = (
        rows.select("id", F.xxhash64("label", "vec").alias("rep")).join(known, "rep")
        .select(F.col("id").alias("vec_id"), "n_links", F.col("first").alias("component_id"))
    )
    return linked.unionByName(_alone(vectors, vec_id, label, embedding)).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def _alone(vectors: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """The rows that ``usable`` leaves out, as components of their own."""
    v = F.col(embedding)
    usable_ = (
        F.col(label).isNotNull()
        & v.isNotNull()
        & (F.size(v) > 0)
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    return vectors.filter(~F.coalesce(usable_, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.col(vec_id).cast("long").alias("component_id"),
    )
