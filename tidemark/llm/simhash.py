"""SimHash near-duplicates: fingerprints, and a Gray-ordered hierarchical index to link them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, kept_rows, shuffle_width
from tidemark.llm.components import connected_components, merge_labels

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints that an index should hold on average; the number of blocks follows from it.
GROUP = 256
FANOUT = 8


def fingerprint(text: str | None) -> int:
    """64 majority bits of the XXH64 of all word shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :])], dtype="<u8"
    )
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hashed: bool = False) -> DataFrame:
    """(id, fp) of every row, and text_hash if ``hashed``; fp is the fingerprint's 64 bits as a signed long."""
    names = ["id", "fp", "text_hash"] if hashed else ["id", "fp"]

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names=names
            )

    text_hash = [F.xxhash64(F.col(text)).alias("text_hash")] if hashed else []
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), *text_hash)
    return rows.mapInArrow(prints, ", ".join(f"{n} long" for n in names))


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The position of each bit pattern in the reflected Gray sequence."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A tree over distinct fingerprints in Gray order.

    Neighbours in Gray order differ in few bits, so consecutive fingerprints share many. Each
    node covers a run of them and keeps the bits on which all of the run agree, less those that
    its parent keeps already. A search goes down with the differences counted so far and drops
    a whole run once they exceed the radius; if they can't exceed it whatever the bits left
    open are, it takes the whole run.
    """

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps = fps[self.order]
        self.levels: list[dict[str, np.ndarray]] = []
        n = len(fps)
        low, high, first = self.fps, self.fps, np.arange(n)
        last = first
        while True:
            self.levels.append({"pattern": low, "mask": ~(low ^ high), "first": first, "last": last})
            if len(low) <= FANOUT:
                break
            cuts = np.arange(0, len(low), FANOUT)
            ends = np.append(cuts[1:], len(low)) - 1
            low, high = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)
            first, last = first[cuts], last[ends]
        for below, above in zip(self.levels, self.levels[1:]):
            parent = np.arange(len(below["pattern"])) // FANOUT
            below["own"] = below["mask"] & ~above["mask"][parent]
        self.levels[-1]["own"] = self.levels[-1]["mask"]
        for level in self.levels:
            level["open"] = np.bitwise_count(~level["mask"]).astype(np.int16)

    def components(self, radius: int = RADIUS, chunk: int = 512) -> np.ndarray:
        """For each fingerprint as given, the index of one that stands for its component."""
        n, fps = len(self.fps), self.fps
        near = np.flatnonzero(np.bitwise_count(fps[1:] ^ fps[:-1]) <= radius)
        labels = merge_labels(n, near, near + 1)
        changed = True
        for start in range(0, n, chunk):
            if changed:
                whole = [self._uniform(labels, level) for level in self.levels]
            a, b = self._search(np.arange(start, min(start + chunk, n)), labels, whole, radius)
            changed = bool(len(a))
            if changed:
                labels = merge_labels(n, a, b, labels)
        found = np.empty(n, dtype=np.int64)
        found[self.order] = self.order[labels]
        return found

    @staticmethod
    def _uniform(labels: np.ndarray, level: dict[str, np.ndarray]) -> np.ndarray:
        """The label that all of a node's run have, or -1."""
        low = np.minimum.reduceat(labels, level["first"])
        high = np.maximum.reduceat(labels, level["first"])
        return np.where(low == high, low, -1)

    def _search(self, queries, labels, whole, radius) -> tuple[np.ndarray, np.ndarray]:
        top = len(self.levels) - 1
        count = len(self.levels[top]["pattern"])
        q, node = np.repeat(queries, count), np.tile(np.arange(count), len(queries))
        apart = np.zeros(len(q), dtype=np.int16)
        links: list[tuple[np.ndarray, np.ndarray]] = []
        for depth in range(top, -1, -1):
            level = self.levels[depth]
            # Runs that end before the query were searched from their side; what is linked
            # to the query already needs no search.
            keep = (level["last"][node] > q) & (whole[depth][node] != labels[q])
            q, node, apart = q[keep], node[keep], apart[keep]
            apart = apart + np.bitwise_count((self.fps[q] ^ level["pattern"][node]) & level["own"][node])
            keep = apart <= radius
            q, node, apart = q[keep], node[keep], apart[keep]
            sure = apart + level["open"][node] <= radius
            if sure.any():
                width = level["last"][node[sure]] - level["first"][node[sure]] + 1
                base = np.repeat(level["first"][node[sure]], width)
                step = np.arange(len(base)) - np.repeat(np.cumsum(width) - width, width)
                links.append((np.repeat(q[sure], width), base + step))
            if depth:
                q, node, apart = q[~sure], node[~sure], apart[~sure]
                children = len(self.levels[depth - 1]["pattern"])
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                q, apart = np.repeat(q, FANOUT), np.repeat(apart, FANOUT)
                there = node < children
                q, node, apart = q[there], node[there], apart[there]
        if not links:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])


def block_plan(count: int, radius: int = RADIUS) -> list[int]:
    """Masks of which two fingerprints within ``radius`` share at least one entirely.

    Of ``radius + k`` blocks, ``radius`` differences leave ``k`` untouched, so every choice of
    ``k`` blocks is a mask. k grows with the number of fingerprints until a mask's groups hold
    about ``GROUP`` of them; every choice finds the same links.
    """
    k = 1
    while count / 2.0 ** (64 * k // (radius + k)) > GROUP and k < radius:
        k += 1
    edges = np.linspace(0, 64, radius + k + 1).astype(int)
    blocks = [((1 << int(hi)) - 1) ^ ((1 << int(lo)) - 1) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, k)]


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect what all pairs of fingerprints within ``radius`` bits connect.

    ``fps`` (fp: long) must be distinct. Fingerprints are dealt out by each mask of the plan;
    inside a group a Gray-ordered index finds the components, and each member but one leaves
    with a link to it: as many rows as members, never all pairs.
    """
    count = fps.count()
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in block_plan(count, radius)]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])
    width = max(shuffle_width(fps.sparkSession), len(masks) * count // 500_000)
    dealt = (
        fps.select("fp", F.posexplode(keys).alias("mask", "key"))
        .repartition(width, "mask", "key")
        .sortWithinPartitions("mask", "key")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held = np.empty((0, 3), dtype=np.int64)
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            held = np.concatenate([held, rows]) if len(held) else rows
            same = (held[:, 1:] == held[-1, 1:]).all(axis=1)
            done = len(held) - int(same.sum())
            if done:
                yield pa.RecordBatch.from_arrays([*map(pa.array, _group_links(held[:done], radius))], schema=schema)
                held = held[done:]
        if len(held):
            yield pa.RecordBatch.from_arrays([*map(pa.array, _group_links(held, radius))], schema=schema)

    return dealt.select("fp", "mask", "key").mapInArrow(link, "a long, b long")


def _group_links(rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal (mask, key) in ``rows`` (fp, mask, key)."""
    fps = rows[:, 0].astype(np.int64).view(np.uint64)
    new = np.flatnonzero((rows[1:, 1:] != rows[:-1, 1:]).any(axis=1)) + 1
    starts = np.concatenate([[0], new])
    sizes = np.diff(np.append(starts, len(rows)))
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    # Groups of a few: their pairs side by side, all groups at once.
    small = np.repeat(sizes <= FANOUT, sizes)
    group = np.repeat(np.arange(len(sizes)), sizes)
    for lag in range(1, FANOUT):
        if len(rows) <= lag:
            break
        pair = (group[lag:] == group[:-lag]) & small[lag:]
        at = np.flatnonzero(pair)
        at = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= radius]
        a.append(fps[at + lag])
        b.append(fps[at])
    for s, n in zip(starts[sizes > FANOUT], sizes[sizes > FANOUT]):
        part = fps[s : s + n]
        root = GrayIndex(part).components(radius)
        linked = np.flatnonzero(root != np.arange(n))
        a.append(part[linked])
        b.append(part[root[linked]])
    empty = [np.empty(0, dtype=np.uint64)]
    return np.concatenate(a or empty).view(np.int64), np.concatenate(b or empty).view(np.int64)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id, in no order.

    Fingerprints of equal bits, or of at most ``RADIUS`` different ones, are linked;
    component_id is the smallest doc_id that links reach. Null, empty and blank texts have
    fingerprint 0, which links like any other. A null doc_id is carried, and counts as the
    smallest id only where no other is in its component. Repeated rows stay repeated. Columns
    other than these two play no part, so none can clash.

    The fingerprints are checkpointed: hashing the texts is the costly part and runs once.
    Links are sought between distinct fingerprints, so copies cost nothing more. Both sides of
    the joins below are plain shuffles, which AQE splits at a fingerprint that many rows have.
    """
    return _labelled(cut(with_fingerprints(docs, doc_id, text))).select(F.col("id").alias("doc_id"), "fp", "component_id")


def _labelled(printed: DataFrame, *extra: str) -> DataFrame:
    """``printed`` with the component_id of each fingerprint, and ``extra`` columns of its component."""
    distinct = cut(printed.groupBy("fp").agg(F.min("id").alias("least")))
    roots = connected_components(fingerprint_links(distinct.select("fp")))
    rooted = (
        distinct.join(roots, distinct["fp"] == roots["node"], "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    )
    rooted = cut(rooted)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = cut(rooted.join(cut(named), "root").select("fp", "component_id", *extra))
    return printed.join(labels, "fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest (doc_id, hash of the text).

    Columns are unchanged. Rows equal in doc_id and text leave one; rows of one doc_id with
    different texts are told apart. Rows without a doc_id, which nothing can refer to, stay.
    """
    rows = _labelled(cut(with_fingerprints(docs, doc_id, text, hashed=True)), "root")
    kept = rows.filter("id = component_id").groupBy("root", "id").agg(F.min("text_hash").alias("text_hash"))
    return kept_rows(docs, kept.select("id", "text_hash"), doc_id, text)
