import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from waymark.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 50 + 50 * c.total() * n_docs // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in set(terms(text)) if c[w])
            if s > 0:
                scores.append((-s, doc is not None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=50):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("terms", F.lit("x")).repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, ranked.search(d, i, k).collect()), key=str)


def corpus(seed, n=300):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(200)]
    docs = [(k, " ".join(words[min(199, int(r.expovariate(0.05)))] for _ in range(r.choice([3, 20, 90])))) for k in range(n)]
    items = [(k, " ".join(r.sample(words, r.randrange(1, 12)))) for k in range(12)]
    return docs, items


def test_equals_brute_force(spark, monkeypatch):
    docs, items = corpus(1)
    docs += [(400, None), (401, ""), (402, " .,;"), (403, "W1-w2_W3é Ünï"), (5, docs[5][1]), (5, docs[5][1]), (None, docs[7][1]), (404, "w150 " * 60_000)]
    items += [(20, None), (21, "..."), (22, "w1 W1 w1"), (22, "w2"), (None, "w3 ünï"), (23, "nowhere")]
    want = brute(docs, items, 7)
    assert run(spark, docs, items, 7) == want
    monkeypatch.setattr(ranked, "TERMS", 15)  # several passes
    assert run(spark, docs, items, 7) == want


def test_small_blocks_and_bounds_change_nothing():
    docs, items = corpus(2, 600)
    wanted = {w.encode(): k for k, w in enumerate(sorted({w for _, t in items for w in terms(t)}))}
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, length = len(docs), sum(c.total() for c in counts)
    df = Counter(w for c in counts for w in c)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w.decode()] + 1))) for w in wanted], np.int64)
    own = [[(wanted[w.encode()], n) for w, n in c.items() if w.encode() in wanted] for c in counts]
    block = ranked.Block(
        np.arange(n_docs), np.array([c.total() for c in counts]), np.array([len(o) for o in own]), np.array([t for o in own for t, _ in o]), np.array([n for o in own for _, n in o]), weights, n_docs, length,
    )
    for item, text in items:
        want = [(d, s) for i, _, d, s in brute(docs, [(item, text)], 5)]
        for least in (1, want[-1][1] if len(want) == 5 else 1):
            scores, found = block.best(np.array([wanted[w.encode()] for w in set(terms(text))]), 5, least)
            assert sorted(want) == sorted((int(found[k]), int(scores[k])) for k in np.lexsort((found, -scores))[:5])


def test_bounds_end_the_walk(monkeypatch):
    """One rare term decides; the common one's postings stay unread."""
    n = 2000
    counts = np.full(n, 1)
    counts[:60] = 2
    found = np.concatenate([np.tile([0, 1], 60), np.zeros(n - 60, np.int64)])
    lengths = np.where(np.arange(n) < 60, 10, 5 + np.arange(n) % 90)
    block = ranked.Block(np.arange(n), lengths, counts, found, np.ones(len(found), np.int64), np.array([1, 3000]), n, 10 * n)
    looks = []
    plain = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **b: looks.append(plain(*a, **b)) or looks[-1])
    scores, docs = block.best(np.array([0, 1]), 50, 1)
    first = np.lexsort((docs, -scores))[:50]
    assert docs[first].tolist() == list(range(50)) and len(set(scores[first].tolist())) == 1
    assert max(looks) < len(found)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == run(spark, [(1, "a")], []) == run(spark, [(1, None)], [(1, "a")]) == []
