"""Conversation repair against plain versions: a forward search, and all edits of tiny conversations."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest

from tests.llm import brute
from tidemark.llm import repair
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    """(conv, turn, role, text) after damage; a dropped row keeps its conversation as None."""
    out = []
    for conv, turn, role, text in rows:
        kind = brute.crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out.append((conv, None) if kind == 0 else (conv, (turn, role, text)))
        if kind == 3:
            out.append(out[-1])
    return out


def plain_faults(turns):
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.rstrip(SPACE)
        if not body.strip(SPACE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif body[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append(None)
        seen.add((role, text))
    return faults


def after(state, initial):
    """The state that a role's initial leads to, by the pattern (s?(ua)+)?, or None."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, initial))


def plain_repair(turns):
    """(cost, audit, repaired turns): a forward search over (state) with the least (cost, audit)."""
    faults = plain_faults(turns)
    best = {"": (0, "", ())}

    def offer(found, state, way):
        if state is not None and (state not in found or way[:2] < found[state][:2]):
            found[state] = way

    def with_inserts(found):
        for _ in range(4):
            for state, (cost, audit, made) in list(found.items()):
                for role in ("user", "assistant"):
                    offer(found, after(state, role[0]), (cost + 5, audit + "I", (*made, (role, ""))))
        return found

    for (_, role, text), fault in zip(turns, faults):
        found = {}
        for state, (cost, audit, made) in with_inserts(best).items():
            offer(found, state, (cost + 2, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            offer(found, after(state, role[:1]), (cost + extra, audit + "K", (*made, (role, text))))
            for new in ("user", "assistant"):
                offer(found, after(state, new[0]), (cost + 1 + extra, audit + "R", (*made, (new, text))))
        best = found
    return min((way for state, way in with_inserts(best).items() if state in ("", "a")), key=lambda w: w[:2])


def every_repair(turns):
    """The least (cost, audit) of all edits with up to two inserts at each place, tried one by one."""
    faults = plain_faults(turns)
    ways = []
    for edits in itertools.product("DKR", repeat=len(turns)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, edits)):
            continue
        for inserts in itertools.product(range(3), repeat=len(turns) + 1):
            for roles in itertools.product("ua", repeat=sum(inserts) + edits.count("R")):
                roles, made, cost, audit = list(roles), "", 0, ""
                for at in range(len(turns) + 1):
                    for _ in range(inserts[at]):
                        made, cost, audit = made + roles.pop(), cost + 5, audit + "I"
                    if at < len(turns):
                        e = edits[at]
                        audit += e
                        cost += {"D": 2, "K": 0, "R": 1}[e] + (5 if e != "D" and faults[at] == "truncated" else 0)
                        made += {"D": "", "K": turns[at][1][:1] or "?"}.get(e) if e != "R" else roles.pop()
                if re.fullmatch("(s?(ua)+)?", made):
                    ways.append((cost, audit))
    return min(ways)


def plain_rows(rows):
    """{conv: result} of damaged rows (conv, (turn, role, text) or None)."""
    convs = defaultdict(list)
    for conv, turn in rows:
        convs[conv] += [turn] if turn else []
    result = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        cost, audit, made = plain_repair(turns)
        numbers, faults = [t[0] for t in turns if t[0] is not None], plain_faults(turns)
        initials = [t[1][:1] for t in turns]
        result[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        )
    return result


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def by_conv(found):
    rows = found.collect()
    result = {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(result) == len(rows)
    return result


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_query_equals_forward_search(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = by_conv(QUERIES["op11_conversation_repair"](spark, folder))
    assert found == plain_rows(plain_damage(map(tuple, rows)))


def random_turns(rng, n):
    texts = ["a.", "b!", "cut", " ", "", "same?", "\t\n", "end. "]
    roles = ["user", "assistant", "system", "tool", " ", "", "User"]
    weights = [8, 8, 3, 1, 1, 1, 1]
    return [
        (rng.choice([None, rng.randrange(6), rng.randrange(6)]), rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}{rng.choice(['.', ''])}")
        for _ in range(n)
    ]


def test_tiny_conversations_equal_all_edits():
    rng = random.Random(5)
    for _ in range(120):
        turns = sorted(random_turns(rng, rng.randrange(4)), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert every_repair(turns) == plain_repair(turns)[:2]


@pytest.mark.parametrize("hold,chunk", [(4096, 4096), (0, 1), (0, 3), (5, 2)])
def test_chunks_of_any_size_give_the_same(rows, hold, chunk):
    rng = random.Random(11)
    data = [(conv, *t) for conv in [None, *range(60)] for t in random_turns(rng, rng.randrange(14))]
    # A hot conversation: a third of all rows, with long runs of repeated and of cut-off turns.
    data += [(99, i, "user", "again and again.") for i in range(60)]
    data += [(99, 100 + i, rng.choice(["user", "assistant"]), f"cut {i}") for i in range(60)]
    data += [(99, 200 + i, ("user", "assistant")[i % 2], f"fine {i}.") for i in range(60)]
    rng.shuffle(data)
    found = by_conv(
        repair.digests(repair.repair(rows(data, "conv_id long, turn long, role string, text string"), hold=hold, chunk=chunk))
    )
    assert found == plain_rows([(c, (t, r, x)) for c, t, r, x in data])


def test_products_of_chunks_give_the_same(rows, monkeypatch):
    monkeypatch.setattr(repair, "_settled", lambda chunks, at, own=repair._settled: own(chunks, at, passes=0))
    rng = random.Random(3)
    data = [(1, i, rng.choice(["user", "assistant", "tool"]), f"cut {i}{rng.choice(['', '', '.'])}") for i in range(200)]
    found = by_conv(repair.digests(repair.repair(rows(data, "conv_id long, turn long, role string, text string"), hold=0, chunk=4)))
    assert found == plain_rows([(c, (t, r, x)) for c, t, r, x in data])


def test_rerun_equals_a_run_from_the_new_vector():
    rng = random.Random(2)
    for _ in range(300):
        symbols = "".join(rng.choice("suaoSUAO-") for _ in range(rng.randrange(40)))
        old, new = (repair.normal([rng.randrange(8) for _ in range(4)])[0] for _ in range(2))
        assert repair.rerun(symbols, old, new, repair.backward(symbols, old)) == repair.backward(symbols, new)


def test_nulls_dropped_rows_empty_tables_and_clashing_columns(rows):
    ddl = "conv_id string, turn int, role string, text string, gone boolean, cost int, part string"
    data = [
        ("a", None, None, None, False, 1, "x"),
        ("b", 1, "user", "Hello there.", None, 1, "x"),
        ("b", 1, "user", "Hello there.", None, 1, "x"),
        ("b", 4, "assistant", "word " * 50_000 + "end.", False, 1, "x"),
        ("c", 1, "user", "All gone.", True, 1, "x"),
        (None, 2, "tool", "No place for it!", False, 1, "x"),
    ]
    repaired = repair.repair(rows(data, ddl), dropped="gone")
    found = {r.conv_id: r for r in repair.digests(repaired).collect()}
    assert {k: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for k, r in found.items()} == {
        "a": (0, 1, 0, 0, 0, 2, "D"),
        "b": (2, 0, 1, 0, 1, 2, "KDK"),
        "c": (0, 0, 0, 0, 0, 0, ""),
        None: (0, 0, 0, 0, 0, 2, "D"),
    }
    parts = {k: [t.role for r in sorted(repaired.collect(), key=lambda r: r.part) if r.conv_id == k for t in r.repaired] for k in found}
    assert parts == {"a": [], "b": ["user", "assistant"], "c": [], None: []}
    empty = repair.digests(repair.repair(rows([], ddl), dropped="gone"))
    assert empty.count() == 0
    digest = repair.digests(repair.repair(rows(data[4:5], ddl), dropped="gone")).first()
    assert digest.repaired_sha256 == hashlib.sha256(b"").hexdigest()
