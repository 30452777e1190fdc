import hashlib
import random

import numpy as np
import pytest

from tests.llm.conftest import prose
from waymark.llm import suffixdedup as sd


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(raw[k : k + 100])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(docs, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup_substrings(docs, **options).collect()}


def test_matches_brute_force(documents, corpus):
    rows = list(enumerate(corpus))
    assert run(documents(rows)) == brute(rows)


@pytest.mark.parametrize("block", [1 << 10, 1 << 20])
def test_small_alphabet(documents, block):
    r = random.Random(3)
    parts = ["".join(r.choice("ab") for _ in range(130)) for _ in range(6)]
    texts = ["".join(r.choice(parts)[: r.choice([90, 130])] for _ in range(r.randint(0, 6))) for _ in range(30)] + ["ab" * 300, "ba" * 90, "a" * 99, "a" * 100, "a" * 101]
    rows = list(enumerate(texts))
    assert run(documents(rows), block=block) == brute(rows)


@pytest.mark.parametrize("hot,bits", [(3, 64), (8192, 3), (3, 3)])
def test_large_buckets_and_equal_hashes(documents, corpus, monkeypatch, hot, bits):
    """A passage in many documents, anchors with many contexts, and different contexts under one hash."""
    monkeypatch.setattr(sd, "HOT", hot)
    r = random.Random(8)
    passage, phrase = prose(70, 30), "a phrase of more than twenty-four characters "
    texts = corpus + [f"{prose(2000 + k, r.randint(0, 9))} {passage} {prose(3000 + k, 5)}" for k in range(40)]
    texts += [f"{prose(4000 + k, 20)} {phrase}{prose(4000 + k // 2, 20)}" for k in range(40)]
    rows = list(enumerate(texts))
    docs = documents(rows)
    assert run(docs, bits=bits) == brute(rows)


def test_text_longer_than_a_block_and_clashing_columns(documents):
    long = prose(1, 3000)
    rows = [(1, long), (2, long[5000:9000] + "x" * 50), (3, long)]
    docs = documents(rows).withColumnsRenamed({"lang": "id", "source": "of", "n_chars": "raw_id"})
    assert run(docs, block=1 << 12) == brute(rows)


def test_difference_cover_and_classes():
    assert {(a - b) % sd.V for a in sd.COVER for b in sd.COVER} == set(range(sd.V))
    r = random.Random(1)
    raw = np.frombuffer("".join(r.choice("ab") * r.choice([1, 1, 40]) for _ in range(400)).encode(), np.uint8)
    text = np.concatenate([raw, np.zeros(sd.DEPTH + 2 * sd.V + sd.LENGTH, np.uint8)])
    at = np.arange(len(raw) - 99)
    found = {}
    for k, c in zip(at, sd.classes(text, at), strict=True):
        found.setdefault(raw[k : k + 100].tobytes(), set()).add(int(c))
    assert all(len(c) == 1 for c in found.values()) and len({min(c) for c in found.values()}) == len(found)


def test_nulls_repeats_and_empty(documents):
    long = "".join(chr(97 + k % 23) + str(k) for k in range(60))
    assert run(documents(["x"]).where("false")) == {}
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in sd.dedup_substrings(documents([(5, long), (5, long), (None, long), (7, None)])).collect())
    size = len(long)
    assert got == [(False, 5, size), (False, 5, size), (False, 7, 0), (True, 0, 0)]
