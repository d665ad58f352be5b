from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import langid, quality, suffix_tree, toxicity
from tidemark.llm.queries import QUERIES
from tidemark.llm.samples import labelled_sample

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


# ---- language identification


def test_language_of_held_out_documents(spark, documents):
    found = QUERIES["op1_language_id"](spark, SF).collect()
    assert len(found) == len(documents)
    assert all(r.held_out == (brute.crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == documents[r.doc_id].lang for r in held]) > 0.97
    assert np.mean([r.rejected for r in found]) < 0.02


def test_language_edge_cases(rows):
    train = [(t, lang) for lang, t in (("en", "the cat and the dog of that house "), ("de", "der hund und die katze das haus ")) for t in [t * k for k in range(1, 9)]]
    learned = langid.learn_dictionaries(rows([*train, (None, "fr"), ("texte", None), ("", "es"), ("123", "it")], "text string, lang string"))
    assert list(learned) == ["de", "en"] and all(len(d) <= langid.DICTIONARY_BYTES for d in learned.values())
    docs = rows(
        [(1, "the dog and the cat", 0.5), (2, None, 0.5), (3, "", None), (4, "12 -- _ ²", 1.0), (5, "der hund und die katze" * 5000, 1.0), (1, "the dog and the cat", 0.5)],
        "doc_id long, text string, score double",
    )
    found = langid.identify(docs, learned)
    assert found.columns == ["doc_id", "text", "score", "lang_pred", "score_", "margin", "rejected"]
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in found.collect()}
    assert got == {1: ("en", False), 2: ("und", True), 3: ("und", True), 4: ("und", True), 5: ("de", False)}
    assert found.count() == 6
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(docs.limit(0), learned).count() == 0
    assert langid.learn_dictionaries(rows([], "text string, lang string")) == {}


def test_narrow_margin_rejects_long_texts_only():
    same = b"one dictionary for both "
    model = langid.Classifier({"a": same, "b": same})
    assert model.predict("words " * 100) == ("a", 0.5, 0.0, True)
    assert model.predict("words") == ("a", 0.5, 0.0, False)


# ---- toxicity


def test_toxicity_of_held_out_documents(spark, documents, labels):
    found = QUERIES["op5_toxicity"](spark, SF).collect()
    assert len(found) == len(documents)
    assert all(r.held_out == (brute.crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert brute.auc([r.score for r in held], [labels[r.doc_id].toxic for r in held]) > 0.75
    marked = [r for r in found if "idiot" in documents[r.doc_id].text.lower().split()]
    assert marked and np.mean([r.predicted for r in marked]) > 0.95


def test_toxicity_edge_cases(spark, rows):
    ordinary = ["many plain words stand %s here" % w for w in "one two three four five six seven eight nine ten".split() for _ in range(4)]
    toxic = [t.replace("plain", "%s vile" % w) for t, w in zip(ordinary, [a + b for a in "abcdefgh" for b in "ijklm"])]
    data = list(enumerate(ordinary + toxic))
    docs = rows([*data, (900, None), (None, "x")], "doc_id long, text string")
    marks = rows([(i, int(i >= len(ordinary))) for i, _ in data] + [(900, 1), (None, 1), (901, 1), (0, 0), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    asked = rows([(1, "how vile of them", 1), (2, None, 1), (3, "", 1), (4, "...", 1), (5, "many plain words " * 20_000, 1)], "doc_id long, text string, score int")
    found = toxicity.score_toxicity(asked, model)
    assert found.columns == ["doc_id", "text", "score", "score_", "predicted"]
    got = {r.doc_id: r.score_ for r in found.collect()}
    assert got[1] > 0.5 > got[5] and got[2] == got[3] == got[4]
    for none in (marks.limit(0), marks.filter("toxic = 0")):
        flat = toxicity.learn(docs, none)
        assert len({r.score_ for r in toxicity.score_toxicity(asked, flat).collect()}) == 1
    assert toxicity.score_toxicity(asked.limit(0), model).count() == 0


def test_copies_count_as_one_piece_of_evidence(spark, rows):
    data = [(i, f"plain text number{i} with words{i}") for i in range(40)] + [(100 + i, "odd phrase repeated in copies") for i in range(40)]
    model = toxicity.learn(rows(data, "doc_id long, text string"), rows([(i, int(i >= 100)) for i, _ in data], "doc_id long, toxic int"))
    assert model.words == {}


# ---- quality


def test_quality_of_held_out_documents(spark, documents, labels):
    found = QUERIES["op9_quality"](spark, SF).collect()
    assert len(found) == len(documents)
    assert all(r.held_out == (brute.crc(r.doc_id) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert brute.auc([r.score for r in held], [labels[r.doc_id].quality for r in held]) > 0.95


def test_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    counts = rng.poisson(1.0, (90, quality.TERMS)).astype(float)
    labels = rng.integers(0, 2, 90)
    space = quality.fit(counts, labels)
    asked = space.project(rng.poisson(1.0, (7, quality.TERMS)).astype(float))
    for vector, got in zip(asked, space.vote(asked)):
        similar = sorted(((float(vector @ v), y) for v, y in zip(space.vectors, labels)), reverse=True)[: quality.NEIGHBOURS]
        weights = [max(s, 0) ** quality.SHARPNESS for s, _ in similar]
        assert got == pytest.approx(sum(w * y for w, (_, y) in zip(weights, similar)) / sum(weights), abs=1e-4)


def test_quality_edge_cases(spark, rows):
    data = [(i, "Clean words in a line, then more.\n" * (1 + i % 3), 1) for i in range(20)] + [(100 + i, "b@@d!! t%%t## " * (2 + i % 3), 0) for i in range(20)]
    docs = rows([d[:2] for d in data] + [(900, None)], "doc_id long, text string")
    marks = rows([(d[0], d[2]) for d in data] + [(900, 0), (None, 1), (1, 1)], "doc_id long, quality int")
    space = quality.learn(docs, marks)
    asked = rows([(1, "Clean words, and more.", "x"), (2, "t##t%% b@@ " * 9000, "x"), (3, None, "x"), (4, "", "x")], "doc_id long, text string, predicted string")
    found = quality.score_quality(asked, space)
    assert found.columns == ["doc_id", "text", "predicted", "score", "predicted_"]
    got = {r.doc_id: r.score for r in found.collect()}
    assert got[1] > 0.9 and got[2] < 0.1 and got[3] == got[4] == pytest.approx(0.5)
    nothing = quality.learn(docs, marks.limit(0))
    assert {r.score for r in quality.score_quality(asked, nothing).collect()} == {0.5}
    assert quality.score_quality(asked.limit(0), space).count() == 0


# ---- suffix tree


def test_scores_of_whole_table(spark, documents):
    found = QUERIES["op7_lm_scoring"](spark, SF).collect()
    assert len(found) == len(documents)
    words = {d: brute_words(r.text) for d, r in documents.items()}
    counts: Counter = Counter()
    for d, own in words.items():
        if brute.crc(d) % 7 != 2:
            counts.update(own)
            counts[None] += 1
    total, distinct = sum(counts.values()), len(counts)
    for r in found:
        own = [*words[r.doc_id], None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        base = math.fsum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (brute.crc(r.doc_id) % 7 == 2)
        assert r.score < 0


def brute_words(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (text or "").translate(brute.LOWER)).split(" ") if w]


def test_tree_against_a_plain_one(spark, rows, monkeypatch):
    """States, distributions and scores of a small corpus, worked out with dictionaries."""
    monkeypatch.setattr(suffix_tree, "DIVERGENCE_BITS", 3.0)
    monkeypatch.setattr(suffix_tree, "CHUNK", 64)
    texts = ["the cat sat", "the cat ran and the dog ran", "", "dogs and cats and the end"]
    tree = suffix_tree.learn_tree(rows([(t,) for t in texts], "text string"))
    code = {bytes([b]): int(s) for b, s in enumerate(tree.alphabet.symbol)}
    counts: dict[tuple, Counter] = {}
    depth = suffix_tree.DEPTH
    for t in texts:
        symbols = [code[bytes([b])] for b in (" ".join(t.split()) + (" " if t else "")).encode()] + [suffix_tree.END]
        line = [suffix_tree.END] * depth + symbols
        for i in range(depth, len(line)):
            for k in range(depth + 1):
                counts.setdefault(tuple(line[i - k : i]), Counter())[line[i]] += 1
    states = {()}
    for context, own in counts.items():
        if context:
            above, n = counts[context[1:]], sum(own.values())
            gain = sum(c * math.log2(c / n / (above[s] / sum(above.values()))) for s, c in own.items())
            if gain >= 3.0 and n * suffix_tree.BITS >= 3.0:
                states |= {context[i:] for i in range(len(context))}

    def chance(context, symbol):
        own = counts[context]
        n = sum(own.values())
        if not context:
            return (own[symbol] + 0.5) / (n + 32)
        return (own[symbol] + len(own) * chance(context[1:], symbol)) / (n + len(own))

    assert len(tree.keys) == len(states)
    asked = ["the cat", "cats sat", "a zebra \xe9", "", "the dog ran " * 40]
    for t, got in zip(asked, tree.lookup().scores([suffix_tree.words_of(t) for t in asked])):
        body = [code[bytes([b])] for b in (" ".join(t.split()) + (" " if t else "")).encode()] + [suffix_tree.END]
        line, want = [suffix_tree.END] * depth + body, 0.0
        for i in range(depth, len(line)):
            context = next(c for c in (tuple(line[i - k : i]) for k in range(depth, -1, -1)) if c in states)
            escaped = tree.alphabet.escaped if line[i] == suffix_tree.ESCAPE else 1
            want += math.log10(chance(context, line[i]) / escaped)
        assert got == pytest.approx(want, rel=1e-4)


def test_no_context_is_dropped_when_the_tree_comes_in_parts(spark, rows, monkeypatch):
    monkeypatch.setattr(suffix_tree, "DIVERGENCE_BITS", 3.0)
    rng = np.random.default_rng(7)
    texts = [" ".join("".join(rng.choice(list("abcd\xe9"), rng.integers(1, 6))) for _ in range(60)) for _ in range(30)]
    docs = rows([*((i, t) for i, t in enumerate([*texts, "", None])), (0, texts[0])], "doc_id long, text string")
    whole = suffix_tree.learn_tree(docs)
    room = len(whole.keys) // 4
    parts = list(suffix_tree.learn_parts(docs, contexts=room))
    assert len(parts) > 3 and max(len(p.keys) for p in parts) <= room
    assert set(np.concatenate([p.keys for p in parts])) == set(whole.keys)
    assert [p.low for p in parts] == [0, *(p.high for p in parts[:-1])] and parts[-1].high == suffix_tree.ENDINGS
    found = suffix_tree.score_texts(docs, docs, contexts=room).orderBy("doc_id").collect()
    want = suffix_tree.score_texts(docs, docs).orderBy("doc_id").collect()
    assert len(found) == len(want) == 33 and [tuple(r)[:4] for r in found] == [tuple(r)[:4] for r in want]
    assert [r.score for r in found] == pytest.approx([r.score for r in want], rel=1e-9)
    assert [r.base_score for r in found] == pytest.approx([r.base_score for r in want], rel=1e-9)
    # A run takes one ending at least, and all endings are in some run.
    counts = np.zeros(suffix_tree.ENDINGS, dtype=np.int64)
    counts[[5, 6, 9]] = 4, 1, 9
    assert suffix_tree.shares(counts, 5) == [(0, 9), (9, suffix_tree.ENDINGS)]
    assert suffix_tree.shares(counts, 0) == [(0, 6), (6, 9), (9, suffix_tree.ENDINGS)]


def test_distributions_sum_to_one(spark, rows):
    tree = suffix_tree.learn_tree(rows([("some words and some more words " * 20,)], "text string"))
    table = 10.0 ** tree.log10.astype(float)
    table[:, suffix_tree.ESCAPE] *= tree.alphabet.escaped
    assert np.allclose(table.sum(axis=1), 1, atol=1e-4)


def test_scoring_edge_cases(spark, rows, monkeypatch):
    monkeypatch.setattr(suffix_tree, "COMMON", 3)  # so that most words go through the join
    train = rows([(10, "a b a c"), (11, None), (12, "a b")], "doc_id long, text string")
    docs = rows([(1, "a b z", "w"), (1, "a b z", "w"), (1, "c", "w"), (2, None, "w"), (3, "", None), (None, "Z z", "w"), (4, "a " * 30_000, "w")], "doc_id long, text string, word string")
    found = suffix_tree.score_texts(docs, train).collect()
    assert sorted(((r.doc_id or 0, r.n_tokens, r.n_known) for r in found)) == sorted(
        [(1, 4, 3), (1, 4, 3), (1, 2, 2), (2, 1, 1), (3, 1, 1), (0, 3, 1), (4, 30_001, 30_001)]
    )
    assert {r.train_tokens for r in found} == {9}
    log = lambda c: math.log10((c + 1) / (9 + 4 + 1))
    twice = [r.base_score for r in found if r.n_tokens == 4]
    assert twice == pytest.approx([log(3) + log(2) + log(0) + log(3)] * 2)
    blank = suffix_tree.score_texts(docs, train.limit(0)).collect()
    assert len(blank) == 7 and {(r.n_known, r.train_tokens) for r in blank} == {(0, 0)}
    assert suffix_tree.score_texts(docs.limit(0), train).count() == 0


def test_texts_of_one_form_are_told_apart_by_their_words(rows):
    rng = np.random.default_rng(4)
    good, bad = (["%s%s" % (a, b) for a in first for b in ("ab", "cd", "ef", "gh", "ij")] for first in ("klm", "pqr"))
    texts = [" ".join(rng.choice(bad if i % 2 else good, 40)) for i in range(200)]
    docs = rows(list(enumerate(texts)), "doc_id long, text string")
    model = quality.learn(docs, rows([(i, 1 - i % 2) for i in range(120)], "doc_id long, quality int"))
    found = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert brute.auc([found[i] for i in range(120, 200)], [1 - i % 2 for i in range(120, 200)]) > 0.99


# ---- toxicity: expressions of several words, and a plain version


def phrases(rng, toxic_end, ordinary_end, n=3000):
    """Texts of common words, every eighth toxic; either kind ends in its own phrase."""
    common = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)] + ["you"]
    data = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randrange(8, 40))]
        data.append((i, " ".join([*words, toxic_end if i % 8 == 0 else ordinary_end]), int(i % 8 == 0)))
    return data


@pytest.mark.parametrize(
    "toxic_end,ordinary_end",
    [("you zorgle", "you person"), ("wordaa wordab", "wordab wordaa"), ("wordaa wordab", "")],
)
def test_phrases_tell_even_of_ordinary_words(rows, toxic_end, ordinary_end):
    data = phrases(random.Random(8), toxic_end, ordinary_end)
    docs, marks = rows([d[:2] for d in data], "doc_id long, text string"), rows([(i, y) for i, _, y in data], "doc_id long, toxic int")
    held = F.col("doc_id") % 4 == 1
    model = toxicity.learn(docs.filter(~held), marks.filter(~held))
    # Ids of toxic texts are divisible by 8, so held-out ones of both kinds come from a second draw.
    again = phrases(random.Random(9), toxic_end, ordinary_end, 800)
    found = toxicity.score_toxicity(rows([d[:2] for d in again], "doc_id long, text string"), model).collect()
    assert brute.auc([r.score for r in found], [again[r.doc_id][2] for r in found]) > 0.95


def plain_ratios(fitted):
    """(words, pairs, rest) of (text, label) rows, counted one by one."""
    pairs, runs, size = defaultdict(Counter), {1: defaultdict(Counter), 2: defaultdict(Counter)}, Counter(y for _, y in fitted)
    for text, y in fitted:
        w = ["", *toxicity.words_of(text), ""]
        for run in set(zip(w, w[1:-1])):
            pairs[run][y] += 1
        for n in runs:
            for run in set(zip(*(["", *w, ""][i:] for i in range(n + 4)))):
                runs[n][run][y] += 1

    def telling(counted):
        seen = defaultdict(lambda: [[0, 0], [0, 0]])  # class: contexts, texts
        for run, n in counted.items():
            for y in n:
                seen[run[2:-2]][y][0] += 1
                seen[run[2:-2]][y][1] += n[y]
        kept = set()
        for x, c in seen.items():
            e1, e0 = (k * k / i if i else 0 for k, i in (c[1], c[0]))
            spread = math.sqrt((e1 + e0) / (size[1] + size[0]) * (1 / size[1] + 1 / size[0]))
            apart = abs(e1 / size[1] - e0 / size[0]) >= toxicity.DEVIATIONS * spread
            if e1 + e0 >= toxicity.LEAST and apart and abs(math.log(((e1 + 0.5) / size[1]) / ((e0 + 0.5) / size[0]))) >= math.log(toxicity.FACTOR):
                kept.add(x)
        return kept

    k = {c: Counter(b for (_, b), n in pairs.items() if n[c]) for c in (0, 1)}
    either = Counter(b for _, b in pairs)
    d = toxicity.DISCOUNT

    def low(w, c):
        total = sum(k[c].values())
        return max(k[c][w] - d, 0) / total + d * len(k[c]) / total * either[w] / sum(either.values())

    words = {x for (x,) in telling(runs[1])}
    phrases = {(a, b) for a, b in telling(runs[2]) if a not in words and b not in words}
    left = {c: (1 - sum(low(w, c) for w in words)) / (1 - sum(either[w] for w in words) / sum(either.values())) for c in (0, 1)}

    def p(a, b, c):
        back = low(b, c) if b in words else either[b] / sum(either.values()) * left[c]
        own = [n[c] for (x, _), n in pairs.items() if x == a and n[c]]
        return max(pairs[a, b][c] - d, 0) / sum(own) + d * len(own) / sum(own) * back if own else back

    kept = phrases | {x for x, n in list(pairs.items()) if x[1] in words and sum(n.values()) >= 2}
    return (
        {w: math.log(low(w, 1) / low(w, 0)) for w in words},
        {(a, b): math.log(p(a, b, 1) / p(a, b, 0)) for a, b in kept},
        math.log(left[1] / left[0]),
    )


def test_ratios_equal_a_plain_count(rows):
    rng = random.Random(4)
    data = phrases(rng, "you zorgle", "wordaa wordab", 400) + [(1000 + i, f"vile number{i % 9} word{i % 7}", 1) for i in range(60)]
    docs, marks = rows([d[:2] for d in data], "doc_id long, text string"), rows([(i, y) for i, _, y in data], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    sample = labelled_sample(docs, marks, "toxic", toxicity.SAMPLE_ROWS).collect()
    words, pairs, rest = plain_ratios([(r.text, r.label) for r in sample if r.h % toxicity.CALIBRATION])
    assert words and pairs and model.words.keys() == words.keys() and model.pairs.keys() == pairs.keys()
    assert all(math.isclose(model.words[w], x, abs_tol=1e-9) for w, x in words.items())
    assert all(math.isclose(model.pairs[w], x, abs_tol=1e-9) for w, x in pairs.items())
    assert math.isclose(model.rest, rest, abs_tol=1e-9)


# ---- language identification: long texts, and a plain version


def test_a_language_of_long_texts_only_is_learned(rows):
    rng = random.Random(1)
    words = {"en": ["the", "cat", "dog", "house", "with", "and"], "de": ["der", "hund", "katze", "haus", "mit", "und"]}
    def text(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))
    train = [(text("en", 60), "en") for _ in range(30)] + [(text("de", 9000), "de") for _ in range(5)] + [(text("en", 60), "en")] * 3000
    learned = langid.learn_dictionaries(rows(train, "text string, lang string"))
    assert set(learned) == {"en", "de"} and 8000 < len(learned["de"]) <= langid.DICTIONARY_BYTES
    asked = rows([(i, text(lang, 40), lang) for i, lang in enumerate(["en", "de"] * 20)], "doc_id long, text string, lang string")
    assert all(r.lang_pred == r.lang for r in langid.identify(asked, learned).collect())


def test_predictions_equal_plain_compression(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150).select("doc_id", "text")
    learned = langid.learn_dictionaries(spark.read.parquet(f"{SF}/documents.parquet"))

    def size(data, content):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        c = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(c.compress(data[i : i + langid.BLOCK])) for i in range(0, len(data), langid.BLOCK))

    for r in langid.identify(docs, learned).collect():
        data = langid.letters(r.text or "")
        sizes = {lang: size(data, content) for lang, content in learned.items()}
        assert r.lang_pred == (min(sizes, key=sizes.get) if data else langid.UNKNOWN)
