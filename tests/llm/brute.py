"""Plain single-process versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD6 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())


def line_dedup(docs):
    """{doc_id: (text, n_lines, n_removed)} of (doc_id, text) rows with different ids."""
    seen, result = set(), {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        lines = [] if text is None else text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if not any(line.strip(" ") for line in window):
                continue
            if window in seen:
                gone.update((i, i + 1, i + 2))
            seen.add(window)
        left = [line for i, line in enumerate(lines) if i not in gone]
        result[doc] = (None if text is None else "\n".join(left), len(lines), len(gone))
    return result


def words6(text):
    return WORD6.findall((text or "").translate(LOWER))


def decontaminate(docs, items):
    """{doc_id: (n_words, n_hit, n_items, sha256)} of (doc_id, text) and (item_id, text) rows."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = words6(text)
        n = min(len(words), 10)
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    result = {}
    for doc, text in docs:
        words, hit, found = words6(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                own = windows.get(tuple(words[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        names = ",".join(sorted(str(x) for x in found if x is not None))
        result[doc] = (len(words), len(hit), len([x for x in found if x is not None]), hashlib.sha256(names.encode()).hexdigest())
    return result


def auc(scores, labels) -> float:
    good = [s for s, y in zip(scores, labels) if y == 1]
    bad = [s for s, y in zip(scores, labels) if y == 0]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
