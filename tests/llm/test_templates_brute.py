"""Decontamination against a plain form of its rule: templates, windows, consistent slots, coverage."""

import random
import re

from tests.llm.conftest import prose
from waymark.llm import templates as tp

LETTER, DIGIT = r"A-Za-z\x80-\U0010FFFF", "0-9"


def tokens(text):
    out, opens, last = [], True, 0
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        word = m[0]
        opens = opens or "\n" in text[last : m.start()]
        last = m.end()
        core = re.search(rf"[{LETTER}{DIGIT}].*[{LETTER}{DIGIT}]|[{LETTER}{DIGIT}]", word, re.S)
        if core:
            out.append((core[0], opens))
        tail = word[-1] in ".!?:;" or (len(word) > 1 and word[-2] in ".!?:;" and not re.match(rf"[{LETTER}{DIGIT}]", word[-1]))
        opens = tail
    kinds, openers = [], []
    for k, (word, first) in enumerate(out):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), word)
        number = word[0] in "0123456789" or low in tp.NUMBER_WORDS or (word[-1] in "0123456789" and not re.search(f"[{LETTER}]", word))
        upper = len(word.encode()) > 1 and "A" <= word[0] <= "Z"
        kind = "number" if number else "unit" if k and low in tp.UNITS and kinds[-1] == "number" else "name" if upper and not first else "word"
        kinds.append(kind)
        openers.append(upper and first and kind == "word")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w, _ in out], kinds, openers


def windows(text, variant, size):
    """(template or exact key, start, slots) of the windows that may match."""
    words, kinds, openers = tokens(text)
    kinds = ["name" if variant and o else k for k, o in zip(kinds, openers, strict=True)]
    n = len(words)
    out = []
    for at in range(max(n - size + 1, 0)):
        span = range(at, at + size)
        slots = [words[k] for k in span if kinds[k] != "word"]
        plain = size - len(slots)
        usable = plain >= tp.LEAST_WORDS if size == tp.WINDOW or size >= tp.LEAST_WORDS else 2 * plain >= size
        if usable:
            out.append((("template", *(words[k] if kinds[k] == "word" else f"<{kinds[k]}>" for k in span)), at, slots))
        if not variant and (not usable or size < tp.WINDOW):
            out.append((("exact", *(words[k] for k in span)), at, slots))
    return out


def brute(docs, items):
    found = set()
    for d, text in docs:
        n_doc = len(tokens(text)[0])
        for i, item in items:
            n = len(tokens(item)[0])
            size = min(n, tp.WINDOW)
            if not n or (size < tp.LEAST_WORDS and n_doc != size):
                continue
            for variant in range(2):
                theirs = windows(item, variant, size)
                ours = {}
                for key, at, slots in windows(text, variant, size):
                    ours.setdefault(key, []).append((at, slots))
                lines = {}
                for key, at, slots in theirs:
                    for here, values in ours.get(key, ()):
                        lines.setdefault(here - at, []).append((at, slots, values))
                matched = set()
                for met in lines.values():
                    values = {}
                    for _, a, b in met:
                        for x, y in zip(a, b, strict=True):
                            values.setdefault(x, set()).add(y)
                    if all(len(v) == 1 for v in values.values()):
                        matched |= {at for at, _, _ in met}
                if matched and len(matched) >= tp.COVERAGE * max(n - tp.WINDOW + 1, 1):
                    found.add((d, i))
    return found


def test_leaks_match_brute_force(documents, spark):
    r = random.Random(21)
    names, units = ["Ana", "Marko", "Split", "Zadar", "Rome"], ["km", "kg", "hours", "euros"]

    def problem(k):
        a, b = r.sample(names, 2)
        q = random.Random(k)
        filler = prose(k, 12).split()
        return f"{a} has {r.randint(2, 99)} {filler[0]} {filler[1]} {filler[2]} and {b} gives {a} {r.randint(2, 99)} {units[q.randrange(4)]} of {filler[3]} {filler[4]}. How many {filler[5]} {filler[6]} does {a} {filler[7]} {filler[8]} in all?"

    items = [(k, problem(k)) for k in range(12)] + [(20, "What is the capital of France?"), (21, "1 2 3 4 5 6 7 8 9 10 11 12"), (22, "too short"), (23, None), (24, prose(400, 30))]
    docs = [f"{prose(500 + k, r.randint(0, 20))} {problem(k % 14)} {prose(600 + k, r.randint(0, 9))}" for k in range(50)]
    docs += ["so: what is the capital of France? " + prose(1, 9), "count 1 2 3 4 5 6 7 8 9 10 11 12 then", "count 2 3 4 5 6 7 8 9 10 11 12 13", "too short", "far too short", None, "", prose(400, 30), prose(400, 30)[20:], prose(700, 4000) + " " + problem(3)]
    rows = list(enumerate(docs))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in tp.leaks(documents(rows), bench).collect()}
    assert got == brute(rows, items)
    planted = {(k, k % 14) for k in range(50) if k % 14 < 12}
    assert len(planted & got) >= 0.9 * len(planted)
