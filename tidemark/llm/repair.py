"""Repair of conversations at least cost: Viterbi over their turns, in chunks that converge.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in
alternation, the last one of the assistant. Its automaton has four states: 0 nothing yet, 1 after
system, 2 after user, 3 after assistant; 0 and 3 may end. A turn is kept (cost 0), given another
role (1) or deleted (2), and an empty turn may be inserted anywhere (5); a truncated turn that is
not deleted costs 5 more; a blank or repeated turn has to go.

``b[s]`` is the least cost from a place to the conversation's end in state s. Going back over a turn
is a product of min and plus, and such products soon forget all but a constant of the vector
that they started from. So a conversation that is too long for one task is cut into chunks that
start from a guessed vector; passes correct a chunk whose guess differs from its neighbour's
result by more than a constant, until none does. Runs of turns that all have to go don't change the
vector and are looked through. Should other chunks not settle in a few passes, the products
themselves, four by four numbers a chunk, finish what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import remove, shuffle_width, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
STATES = 4
#: The state after an inserted or re-roled turn: user, or assistant if a user waits.
TURN_TO = (2, 2, 3, 2)
#: The state after a turn is kept, by the initial of its role; states without a place for it are missing.
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ROLES = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Costs at the end of a conversation: what it takes to close it.
END = (0, 10, 5, 0)
BLANKS = " \t\n\x0b\x0c\r"

#: Turns of a conversation that one task solves by itself; longer ones are cut into chunks of CHUNK.
HOLD = 4096
CHUNK = 4096
#: Passes that correct guesses, before products of whole chunks are used.
PASSES = 8

Vector = tuple[int, ...]
# A turn as the automaton sees it: dead (must go), or the initial of its role and whether it is cut off.
DEAD = "-"


def closed(base: list[int]) -> list[int]:
    """With the choice to insert one or two turns first; a third only closes a circle."""
    once = [base[TURN_TO[s]] + INSERT for s in range(STATES)]
    twice = [base[TURN_TO[TURN_TO[s]]] + 2 * INSERT for s in range(STATES)]
    return [min(x) for x in zip(base, once, twice)]


def normal(vector) -> tuple[Vector, int]:
    """The vector less its least entry, and that entry."""
    low = min(vector)
    return tuple(x - low for x in vector), low


def code(initial: str, cut_off: bool) -> str:
    """One character for a turn that may stay: s, u, a or another, in capitals if it is cut off."""
    known = initial if initial in KEPT else "o"
    return known.upper() if cut_off else known


_STEPS: dict[tuple[Vector, str], tuple[Vector, int]] = {}


def step(after: Vector, symbol: str) -> tuple[Vector, int]:
    """(costs before a turn, constant) from the costs after it. Vectors are normal, so few differ."""
    found = _STEPS.get((after, symbol))
    if found is None:
        if symbol == DEAD:
            found = (after, DELETE)
        else:
            extra, kept = (TRUNCATED if symbol.isupper() else 0), KEPT.get(symbol.lower(), {})
            base = []
            for s in range(STATES):
                ways = [DELETE + after[s], REROLE + extra + after[TURN_TO[s]]]
                if s in kept:
                    ways.append(KEEP + extra + after[kept[s]])
                base.append(min(ways))
            found = normal(closed(base))
        _STEPS[after, symbol] = found
    return found


def backward(symbols: str, end: Vector) -> tuple[Vector, int]:
    """The costs before a chunk, as a normal vector and a constant, from those after it."""
    vector, total = end, 0
    for symbol in reversed(symbols):
        vector, low = step(vector, symbol)
        total += low
    return vector, total


def rerun(symbols: str, old: Vector, new: Vector, result: tuple[Vector, int]) -> tuple[Vector, int]:
    """``backward`` from ``new``, given the ``result`` from ``old``: it stops where the two agree
    but for a constant, because from there on nothing differs."""
    apart = 0
    for at in range(len(symbols) - 1, -1, -1):
        old, a = step(old, symbols[at])
        new, b = step(new, symbols[at])
        apart += b - a
        if old == new:
            return result[0], result[1] + apart
    return new, result[1] + apart


def choices(symbols: str, end: Vector) -> list[list[tuple[str, int]]]:
    """For each turn and state the ASCII-least edits of least cost up to and with that turn, and the
    state after them. ``I`` comes before ``K`` and ``R`` in ASCII, and ``D`` before all."""
    tables: list[list[tuple[str, int]]] = [[]] * len(symbols)
    after = end
    for at in range(len(symbols) - 1, -1, -1):
        tables[at] = _edits(after, symbols[at])
        after, _ = step(after, symbols[at])
    return tables


_EDITS: dict[tuple[Vector, str], list[tuple[str, int]]] = {}


def _edits(after: Vector, symbol: str) -> list[tuple[str, int]]:
    found = _EDITS.get((after, symbol))
    if found is None:
        before, low = step(after, symbol)
        cost = [x + low for x in before]
        extra, kept = (TRUNCATED if symbol.isupper() else 0), KEPT.get(symbol.lower(), {})
        found = []
        for s in range(STATES):
            letters = ""
            while True:
                if DELETE + after[s] == cost[s]:
                    found.append((letters + "D", s))
                elif INSERT + cost[TURN_TO[s]] == cost[s]:
                    letters, s = letters + "I", TURN_TO[s]
                    continue
                elif s in kept and extra + after[kept[s]] == cost[s]:
                    found.append((letters + "K", kept[s]))
                else:
                    found.append((letters + "R", TURN_TO[s]))
                break
        _EDITS[after, symbol] = found
    return found


def closing(state: int) -> str:
    """The inserts that end a conversation."""
    return "I" * (END[state] // INSERT)


def trace(symbols: str, end: Vector, start: int, last: bool) -> tuple[list[str], int]:
    """The edits of each turn from state ``start`` on, with those that close the conversation as one
    more entry if it ends here, and the state after them."""
    edits, state = [], start
    for table in choices(symbols, end):
        letters, state = table[state]
        edits.append(letters)
    if last:
        edits.append(closing(state))
    return edits, state


def rebuilt(edits: list[str], turns: list[tuple[str, str]], start: int) -> list[tuple[str, str]]:
    """The repaired turns (role, text) that the edits make of ``turns``."""
    made, state = [], start
    for at, letters in enumerate(edits):
        for letter in letters:
            if letter == "D":
                continue
            if letter == "I":
                state = TURN_TO[state]
                made.append((ROLES[state], ""))
            elif letter == "R":
                state = TURN_TO[state]
                made.append((ROLES[state], turns[at][1]))
            else:
                role, text = turns[at]
                state = KEPT[role[:1]][state]
                made.append((role, text))
    return made


def product(symbols: str) -> list[list[float]]:
    """The least cost from each state before a chunk to each state after it."""
    columns = []
    for j in range(STATES):
        start = tuple(0 if s == j else float("inf") for s in range(STATES))
        vector, low = backward(symbols, start)
        columns.append([x + low for x in vector])
    return [list(row) for row in zip(*columns)]


def is_blank(text: str) -> bool:
    return not text.strip(BLANKS)


def is_cut_off(text: str) -> bool:
    return text.rstrip(BLANKS)[-1:] not in (".", "!", "?")


TURNS = "array<struct<role:string,text:string>>"
#: What a task finds out about a run of turns; runs of one conversation add up.
FIGURES = (
    "n long, least long, greatest long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string"
)
FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
SOLVED = f"{FOUND}, part long, parts long, audit string, repaired {TURNS}"
PLACE = "key string, task int, number long"


class Run:
    """A run of a conversation's turns, in order, and its figures."""

    def __init__(self) -> None:
        self.symbols: list[str] = []
        self.kept: list[tuple[str, str]] = []
        self.n = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least: int | None = None
        self.greatest: int | None = None
        self.first = self.last = ""

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        initial = role[:1]
        if self.n:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        self.n += 1
        if turn is not None:
            self.turns += turn != self.greatest
            self.least, self.greatest = turn if self.least is None else self.least, turn
        symbol = DEAD
        if is_blank(text):
            self.blank += 1
        elif repeated:
            self.duplicate += 1
        else:
            cut_off = is_cut_off(text)
            self.truncated += cut_off
            symbol = code(initial, cut_off)
        self.symbols.append(symbol)
        self.kept.append((role, text))

    def figures(self) -> tuple:
        return (
            self.n, self.least, self.greatest, self.turns, self.blank, self.duplicate, self.truncated, self.illegal,
            self.first, self.last,
        )


def missing(least: int | None, greatest: int | None, turns: int) -> int:
    return 0 if least is None else greatest - least + 1 - turns


def _types(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns))


def _each(rows: DataFrame, made_of, schema: T.StructType, at_once: int = 500) -> DataFrame:
    """The rows that ``made_of`` gives for each row of ``rows``."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                out = [made for row in _rows(batch.slice(start, at_once)) for made in made_of(*row)]
                if out:
                    yield _batch(out, arrow)

    return rows.mapInArrow(run, schema)


def _pairs(turns: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"role": r, "text": t} for r, t in turns]


def _solved(rows: list[tuple]) -> tuple:
    """A whole conversation that one task holds: (turn, role, text, dropped) rows."""
    run, seen = Run(), set()
    for turn, role, text, dropped in rows:
        if not dropped:
            run.add(turn, role, text, (role, text) in seen)
            seen.add((role, text))
    symbols = "".join(run.symbols)
    vector, constant = backward(symbols, END)
    edits, _ = trace(symbols, END, 0, True)
    return (
        missing(run.least, run.greatest, run.turns), run.blank, run.duplicate, run.truncated, run.illegal,
        vector[0] + constant, 0, 1, "".join(edits), _pairs(rebuilt(edits, run.kept, 0)),
    )


def repair(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    dropped: str | None = None,
    hold: int = HOLD,
    chunk: int = CHUNK,
) -> DataFrame:
    """The cheapest repair of every conversation, and what was found wrong with it.

    One row per conversation, or several ``part``s of one that is long or that tasks share: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost (of the whole conversation, on each part), part (from 0), parts, audit (the
    initials of the part's edits), repaired (the part's turns: role, text).

    Turns are taken by turn number, nulls first, then by role and text. A null role or text counts
    as one space. ``dropped`` may name a boolean column; rows where it is true are no turns, but
    their conversation is reported even if it has no others: no faults, cost 0, empty audit and
    repair. ``gaps`` counts numbers missing between the least and the greatest turn; each turn's
    first fault counts: ``blank`` text, ``duplicate`` (role and text seen earlier), ``truncated`` (no . !
    or ? at the end); ``illegal`` counts neighbours whose roles don't follow each other. Of the
    cheapest repairs the one of the ASCII-least audit is taken. A null conv_id is a conversation
    like others. An empty table gives no row. Other columns play no part.

    Rows are dealt out by ranges of their whole order, equal rows by a number of their own besides,
    so that a conversation of any share of the table spreads over tasks. A conversation that lies
    inside one task and has at most ``hold`` turns is solved there. The first and the last of each
    task, which may go on in the next one, and longer ones are written out and solved in chunks
    of ``chunk`` turns.
    """
    gone = F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)
    dealt = (
        rows.select(
            F.col(conv_id).alias("conv"),
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
            gone.alias("dropped"),
            F.xxhash64(F.monotonically_increasing_id()).alias("spread"),
        )
        .repartitionByRange(shuffle_width(rows.sparkSession), "conv", "turn", "role", "text", "spread")
        .sortWithinPartitions("conv", "turn", "role", "text", "spread")
        .drop("spread")
    )
    solved = _types(SOLVED).fields
    piece = _types("task int, place long, turn long, role string, text string, dropped boolean").fields
    schema = T.StructType([T.StructField("conv", dealt.schema["conv"].dataType), *solved, *piece])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        conv, held, out = None, [], []
        # The task's first conversation may have begun in another one: its rows are handed on.
        handing_on, started = True, False

        def hand_on() -> None:
            nonlocal place
            for row in held:
                out.append((conv, *[None] * len(solved), task, place, *row))
                place += 1
            held.clear()

        for batch in batches:
            for of, *row in _rows(batch):
                if started and of != conv:
                    if handing_on:
                        hand_on()
                    else:
                        out.append((conv, *_solved(held), *[None] * len(piece)))
                        held.clear()
                    handing_on = False
                conv, started = of, True
                held.append(row)
                if len(held) > hold:
                    handing_on = True
                if handing_on:
                    hand_on()
                if len(out) >= 1000:
                    yield _batch(out, arrow)
                    out.clear()
        hand_on()
        if out:
            yield _batch(out, arrow)

    both, _ = stored(dealt.mapInArrow(run, schema), "conversations")
    inside = both.filter("task is null").select("conv", *[f.name for f in solved])
    pieces = both.filter("task is not null").select("conv", *[f.name for f in piece])
    return inside.unionByName(_solved_in_chunks(pieces, chunk)).withColumnRenamed("conv", conv_id)


def _solved_in_chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """Solve conversations (conv, task, place, turn, role, text, dropped) that come in pieces.

    A chunk is ``chunk`` rows of one task's piece, so its size is bounded, and so is the number of a
    conversation's chunks: its rows divided by that, and one for each task.
    """
    at = ["key", "task", "number"]
    keyed = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null")).alias("key"),
        F.floor(F.col("place") / chunk).alias("number"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said"),
        "*",
    )
    # Where something is said first: one row a task and saying leaves the partial aggregate. It is
    # stored before it is joined, so both sides are plain shuffles, which AQE splits.
    place = F.struct("task", "place")
    firsts, firsts_folder = stored(
        keyed.filter("not dropped").groupBy("key", "said")
        .agg(F.min(place).alias("first_place"), F.count("*").alias("times")).filter("times > 1").drop("times"),
        "first-sayings",
    )
    turns, turns_folder = stored(
        keyed.join(firsts, ["key", "said"], "left")
        .withColumn("repeated", F.coalesce(F.col("first_place") != place, F.lit(False)))
        .groupBy(*at)
        .agg(
            F.first("conv").alias("conv"),
            F.array_sort(F.collect_list(F.struct("place", "turn", "role", "text", "dropped", "repeated"))).alias("rows"),
        ),
        "turns",
    )

    def describe(key, task, number, rows_):
        run = Run()
        for r in rows_:
            if not r["dropped"]:
                run.add(r["turn"], r["role"], r["text"], r["repeated"])
        symbols = "".join(run.symbols)
        vector, constant = backward(symbols, END)
        yield key, task, number, symbols, *run.figures(), END, vector, constant

    vector_types = "guess array<long>, costs array<long>, constant long"
    chunks, chunks_folder = stored(
        _each(turns.select(*at, "rows"), describe, _types(f"{PLACE}, symbols string, {FIGURES}, {vector_types}")), "chunks"
    )
    vectors, vectors_folder = _settled(chunks, at)
    leads, leads_folder = stored(_with_leads(chunks.drop("guess", "costs", "constant").join(vectors, at)), "leads")
    joined, joined_folder = stored(_stitched(leads), "stitched")

    def finish(conv, rows_, symbols, guess, start, last, *told):
        edits, _ = trace(symbols, tuple(guess), start, last)
        live = [(r["role"], r["text"]) for r in rows_ if not r["dropped"]]
        yield conv, *told, "".join(edits), _pairs(rebuilt(edits, live, start))

    told = [f.split()[0] for f in f"{FOUND}, part long, parts long".split(", ")]
    whole = turns.join(leads.select(*at, "symbols", "guess"), at).join(joined, at)
    result, _ = stored(
        _each(
            whole.select("conv", "rows", "symbols", "guess", "start", "ends", *told),
            finish,
            T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *_types(SOLVED).fields]),
            at_once=8,
        ),
        "repaired",
    )
    for folder in (firsts_folder, turns_folder, chunks_folder, vectors_folder, leads_folder, joined_folder):
        remove(rows.sparkSession, folder)
    return result


def _settled(chunks: DataFrame, at: list[str], passes: int = PASSES) -> tuple[DataFrame, str]:
    """(key, task, number, guess, costs, constant) with every guess right, and the folder it is in.

    A pass runs those chunks again whose guess is not what the next chunk that changes anything
    found. Each pass makes at least one more chunk of a conversation exact, from its end.
    """
    names = [*at, "guess", "costs", "constant"]
    schema = _types(f"{PLACE}, guess array<long>, costs array<long>, constant long")
    own = chunks.select(*at, "symbols", F.rtrim(F.col("symbols"), F.lit(DEAD)).alias("live")).select(
        *at, "symbols", (F.col("live") == "").alias("through")
    )
    vectors, folder = stored(chunks.select(*names), "vectors")
    later = "(partition by key order by task desc, number desc rows between unbounded preceding and 1 preceding)"

    def fix(*row):
        *place, guess, costs, constant, wanted, symbols = row
        vector, total = rerun(symbols, tuple(guess), tuple(wanted), (tuple(costs), constant))
        yield *place, wanted, vector, total

    for _ in range(passes):
        told = vectors.join(own.drop("symbols"), at).selectExpr(
            *names, f"last(if(through, null, costs), true) over {later} as wanted"
        )
        wrong = F.expr("wanted is not null and wanted <> guess")
        again = told.filter(wrong).join(own.drop("through"), at).select(*names, "wanted", "symbols")
        newer, newer_folder = stored(told.filter(~wrong | wrong.isNull()).select(*names).unionByName(_each(again, fix, schema)), "vectors")
        settled = told.filter(wrong).isEmpty()
        remove(chunks.sparkSession, folder)
        vectors, folder = newer, newer_folder
        if settled:
            return vectors, folder
    exact, exact_folder = stored(_by_products(chunks.select(*at, "symbols"), schema), "vectors")
    remove(chunks.sparkSession, folder)
    return exact, exact_folder


def _by_products(chunks: DataFrame, schema: T.StructType) -> DataFrame:
    """The vectors of all chunks, from the product of each: one row holds a conversation's products."""
    products = _each(
        chunks,
        lambda key, task, number, symbols: [(key, task, number, [x for row in product(symbols) for x in row])],
        _types(f"{PLACE}, product array<double>"),
    )
    grouped = products.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("task", "number", "product"))).alias("of"))

    def back(key, of):
        after = END
        for c in reversed(of):
            p = c["product"]
            raw = [min(p[s * STATES + j] + after[j] for j in range(STATES)) for s in range(STATES)]
            vector, low = normal([int(x) for x in raw])
            yield key, c["task"], c["number"], after, vector, low
            after = vector

    return _each(grouped, back, schema, at_once=1)


def _with_leads(chunks: DataFrame) -> DataFrame:
    """Each chunk with the state that it leads to from each state."""
    names = chunks.columns
    symbols, guess = names.index("symbols"), names.index("guess")

    def lead(*row):
        state = list(range(STATES))
        for table in choices(row[symbols], tuple(row[guess])):
            state = [table[s][1] for s in state]
        yield *row, state

    return _each(chunks, lead, T.StructType([*chunks.schema.fields, *_types("leads array<int>").fields]))


def _stitched(leads: DataFrame) -> DataFrame:
    """(key, task, number, start, ends, part, parts, figures) of each chunk: the state it starts in,
    whether its conversation ends with it, and that conversation's figures. A row holds the chunks
    of one conversation, without their turns."""
    names = [f.split()[0] for f in FIGURES.split(", ")]
    listed = F.struct("task", "number", *names, "costs", "constant", "leads")
    grouped = leads.groupBy("key").agg(F.array_sort(F.collect_list(listed)).alias("of"))

    def stitch(key, of):
        least = greatest = last = None
        turns, faults = 0, dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        for c in of:
            if not c["n"]:
                continue
            if last is not None:
                faults["illegal"] += last + c["first"] not in LEGAL
            last = c["last"]
            if c["least"] is not None:
                turns += c["turns"] - (greatest == c["least"])
                least, greatest = c["least"] if least is None else least, c["greatest"]
            for name in faults:
                faults[name] += c[name]
        cost = of[0]["costs"][0] + sum(c["constant"] for c in of)
        state = 0
        for part, c in enumerate(of):
            yield (
                key, c["task"], c["number"], state, part == len(of) - 1, missing(least, greatest, turns),
                *faults.values(), cost, part, len(of),
            )
            state = c["leads"][state]

    schema = _types(f"{PLACE}, start int, ends boolean, {FOUND}, part long, parts long")
    return _each(grouped, stitch, schema, at_once=1)


def digests(repaired: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row per conversation of ``repair``: its figures, whole audit, and ``repaired_sha256``, the SHA-256
    of its repaired turns as ``role:text``, joined by newlines.

    A conversation of several parts is hashed part by part in one task, which holds one part at
    a time: a SHA-256 can't be put together from pieces.
    """
    figures = [f.split()[0] for f in FOUND.split(", ")]
    lines = "array_join(transform(repaired, t -> concat(t.role, ':', t.text)), '\\n')"
    single = repaired.filter("parts = 1").selectExpr(
        f"`{conv_id}`", *figures, "audit", f"sha2({lines}, 256) as repaired_sha256"
    )
    many = (
        repaired.filter("parts > 1")
        .selectExpr(f"`{conv_id}`", *figures, "part", "parts", "audit", f"{lines} as lines", "size(repaired) as n")
        .repartition(conv_id)
        .sortWithinPartitions(conv_id, "part")
    )
    schema = single.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, audits, begun = hashlib.sha256(), [], False
        for batch in batches:
            for *told, part, parts, audit, lines_, n in _rows(batch):
                if n:
                    hashed.update(("\n" * begun + lines_).encode("utf-8", "surrogatepass"))
                    begun = True
                audits.append(audit)
                if part == parts - 1:
                    yield _batch([(*told, "".join(audits), hashed.hexdigest())], arrow)
                    hashed, audits, begun = hashlib.sha256(), [], False

    return single.unionByName(many.mapInArrow(run, schema))
