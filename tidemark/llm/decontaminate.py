"""Benchmark decontamination by normalised word windows. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut, free_name

WINDOW = 10
#: The windows of the benchmark are broadcast up to this many; beyond it the join shuffles.
BROADCAST_WINDOWS = 2_000_000
# Everything in ASCII but digits and lower-case letters separates words.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of the lower-cased text: runs of digits, a-z and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS, -1), "")


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(hash, length, window, items): each distinct window, its words and the items that hold it.

    An item of 10 words or more gives every run of 10; a shorter one, but not an empty one, is
    a single window. ``hash`` is for the lookup, ``window`` for the check of a hit.
    """
    words = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("w"))
    n = f"least(size(w), {WINDOW})"
    starts = f"transform(sequence(0, size(w) - {n}), i -> slice(w, i + 1, {n}))"
    return (
        words.filter(F.size("w") > 0)
        .select("item", F.explode(F.expr(starts)).alias("run"))
        .groupBy(F.xxhash64("run").alias("hash"), F.size("run").alias("length"), F.array_join("run", " ").alias("window"))
        .agg(F.collect_set("item").alias("items"))
    )


def scan(
    docs: DataFrame,
    windows: DataFrame,
    lengths: list[int],
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per (doc_id, text): id, text_hash, copies, n_words, hits, items.

    ``hits`` are (pos, length) of the verified windows, ``items`` the ids of the items they
    belong to, sorted as strings. Each text is read once: its words become an array of window
    hashes, one run of them for each length that the benchmark has, which meet the broadcast
    set in the same stage; a hash that is found is checked against the words themselves. The
    first entry of each array is a marker that always finds its match, so documents without a
    hit stay, and the shuffle that follows carries one row for each document and hit. (The
    array is a column of its own and the explosion an outer one, so that neither it nor the
    words are computed or copied for each window.)
    """
    marker = F.lit(0).cast("long")
    worded = docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        words_of(F.col(text)).alias("w"),
    )
    hashes = [
        F.expr(
            f"transform(slice(w, 1, greatest(size(w) - {n - 1}, 0)), (x, i) -> xxhash64(slice(w, i + 1, {n})))"
        )
        for n in lengths
    ]
    probes = (
        worded.select("id", "text_hash", "w", F.concat(F.array(marker), *hashes).alias("hashes"))
        .select("id", "text_hash", "w", F.posexplode_outer("hashes").alias("at", "hash"))
    )
    known = windows.select(
        F.col("hash").alias("b_hash"), F.col("length").cast("int").alias("b_length"), "window", "items"
    ).unionByName(
        windows.sparkSession.sql(
            "select 0L as b_hash, 0 as b_length, '' as window, cast(array() as array<string>) as items"
        )
    )
    # Where a run of hashes begins: after the marker and the runs of smaller lengths.
    begins = "case b_length when 0 then 0"
    for k, n in enumerate(lengths):
        begins += f" when {n} then 1" + "".join(f" + greatest(size(w) - {m - 1}, 0)" for m in lengths[:k])
    pos = f"at - ({begins} else 0 end)"
    found = probes.join(
        F.broadcast(known),
        (F.col("hash") == F.col("b_hash"))
        & F.expr(
            f"if(b_length = 0, at = 0, array_join(slice(w, greatest({pos}, 0) + 1, b_length), ' ') = window)"
        ),
    )
    hit = F.col("b_length") > 0
    return (
        found.select(
            "id",
            "text_hash",
            F.when(~hit, F.size("w")).alias("n_words"),
            F.when(hit, F.struct(F.expr(pos).alias("pos"), F.col("b_length").alias("length"))).alias("hit"),
            F.when(hit, F.col("items")).alias("items"),
        )
        .groupBy("id", "text_hash")
        .agg(
            F.count("n_words").alias("copies"),
            F.max("n_words").cast("long").alias("n_words"),
            F.array_sort(F.collect_set("hit")).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )


def _worded(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), words_of(F.col(text)).alias("w"))


def window_probes(docs: DataFrame, lengths: list[int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, pos, length, hash, own): every window of the ``lengths``, with its own words only."""
    runs = [
        F.expr(
            f"transform(slice(w, 1, greatest(size(w) - {n - 1}, 0)), (x, i) -> struct(i as pos, {n} as length, "
            f"xxhash64(slice(w, i + 1, {n})) as hash, array_join(slice(w, i + 1, {n}), ' ') as own))"
        )
        for n in lengths
    ]
    return (
        _worded(docs, doc_id, text).select("id", "text_hash", F.concat(*runs).alias("runs"))
        .select("id", "text_hash", F.explode_outer("runs").alias("run"))
        .filter("run is not null").select("id", "text_hash", "run.*")
    )


def scan_by_join(docs: DataFrame, windows: DataFrame, lengths: list[int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``scan`` gives, for windows too many to broadcast.

    Each window of a document goes through a shuffle with its place, its hash and its own words,
    and with nothing else of the text, so what is shuffled grows with the length of the texts.
    Numbers of words come from a projection of their own. The benchmark's windows are
    checkpointed, so both sides of the join are plain shuffles and AQE splits a window that many
    documents hold.
    """
    keyed = _worded(docs, doc_id, text)
    counted = keyed.groupBy("id", "text_hash").agg(
        F.count("*").alias("copies"), F.max(F.size("w")).cast("long").alias("n_words")
    )
    none = F.array()
    if not lengths:
        return counted.select(
            "*", none.cast("array<struct<pos:int,length:int>>").alias("hits"), none.cast("array<string>").alias("items")
        )
    known = cut(windows.select("hash", F.col("length").cast("int").alias("length"), F.col("window").alias("own"), "items"))
    hits = (
        window_probes(docs, lengths, doc_id, text).join(known, ["hash", "length", "own"])
        .groupBy(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
        .agg(
            F.array_sort(F.collect_set(F.struct("pos", "length"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    kinds = {f.name: f.dataType for f in hits.schema}
    return counted.join(hits, same, "left").select(
        "id", "text_hash", "copies", "n_words",
        *[F.coalesce(F.col(c), none.cast(kinds[c])).alias(c) for c in ("hits", "items")],
    )


def covered_words(hits: str = "hits") -> Column:
    """How many words lie inside a hit: sorted starts, each adding what the ones before left."""
    return F.expr(
        f"cast(aggregate({hits}, named_struct('n', 0, 'upto', 0), (s, h) -> named_struct("
        "'n', s.n + greatest(h.pos + h.length - greatest(s.upto, h.pos), 0), "
        "'upto', greatest(s.upto, h.pos + h.length)), s -> s.n) as bigint)"
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit, items, hits, contaminated.

    Null texts and texts without a word have no hits; a null doc_id is kept. Repeated rows give
    repeated results, rows of one doc_id with different texts are told apart by the text's hash.
    An item without words or without text is ignored; a null item_id is not listed among the
    items, though its windows count. An empty benchmark contaminates nothing. Other columns of
    either table play no part.

    The windows are broadcast only if there are at most ``BROADCAST_WINDOWS``, counted first;
    a larger benchmark goes through a shuffled join (``scan_by_join``).
    """
    windows = benchmark_windows(benchmark, item_id, item_text)
    # At most WINDOW rows: one for each window length that occurs.
    by_length = {r["length"]: r["n"] for r in windows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    way = scan if sum(by_length.values()) <= BROADCAST_WINDOWS else scan_by_join
    found = way(docs, windows, sorted(by_length), doc_id, text)
    n_hit = covered_words()
    return found.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)"))).select(
        F.col("id").alias("doc_id"),
        "text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        "items",
        "hits",
        (F.size("hits") > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    remove: str = "documents",
) -> DataFrame:
    """``docs`` without the contaminated documents, or (``remove="spans"``) without their hit words.

    In span mode a text that is hit keeps the words outside every hit, in lower case and joined
    by spaces; clean texts stay as they are. Columns and clean rows are unchanged either way.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    found = (
        find_contamination(docs, benchmark, doc_id, text)
        .filter("contaminated")
        .select("doc_id", "text_hash", "hits")
        .dropDuplicates(["doc_id", "text_hash"])
    )
    names = docs.columns
    renamed = found.toDF(*[free_name(f"hit_{c}", names) for c in found.columns])
    id_, hash_, hits = renamed.columns
    same = docs[doc_id].eqNullSafe(renamed[id_]) & (F.xxhash64(docs[text]) == renamed[hash_])
    if remove == "documents":
        return docs.join(renamed, same, "left_anti")
    words = free_name("hit_words", names)
    # Stretches between hits: from the furthest end so far to the next start.
    stretches = F.expr(
        f"aggregate(`{hits}`, named_struct('out', cast(array() as array<string>), 'upto', 0), (s, h) -> "
        f"named_struct('out', concat(s.out, slice(`{words}`, s.upto + 1, greatest(h.pos - s.upto, 0))), "
        f"'upto', greatest(s.upto, h.pos + h.length)), "
        f"s -> concat(s.out, slice(`{words}`, s.upto + 1, greatest(size(`{words}`) - s.upto, 0))))"
    )
    kept = F.when(F.col(hits).isNull(), F.col(text)).otherwise(F.array_join(stretches, " "))
    return (
        docs.join(renamed, same, "left")
        .withColumn(words, words_of(F.col(text)))
        .select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in names])
    )
