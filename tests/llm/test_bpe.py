import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def by_rank(word, merges):
    """Merges applied one after the other, each from left to right."""
    out = list(word)
    for u, v, w in merges:
        k = 0
        while k + 1 < len(out):
            if (out[k], out[k + 1]) == (u, v):
                out[k : k + 2] = [w]
            k += 1
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 14))
def test_gadgets_give_what_merging_gives(seed, n):
    r = random.Random(seed)
    labels, merges = [b"a", b"b", b"c"], []
    while len(merges) < n:
        u, v = r.randrange(len(labels)), r.randrange(len(labels))
        if labels[u] + labels[v] in labels or len(labels[u] + labels[v]) > 12:
            n -= 1
            continue
        merges.append((u, v, len(labels)))
        labels.append(labels[u] + labels[v])
    automaton = bpe.Automaton(labels, merges)
    for _ in range(60):
        word = [r.randrange(3) for _ in range(r.randrange(14))]
        text = b"".join(labels[t] for t in word)
        assert automaton.encode(text) == by_rank(word, merges)
        assert automaton.decode(automaton.encode(text)) == text


def test_equals_the_library():
    own, library = bpe.Tokenizer(PATH), tokenizers.Tokenizer.from_file(PATH)
    r = random.Random(3)
    odd = ["", "a\n b", " \n", "x<|endoftext|>y\nz<|endoftext|>", "it's\nwe'll \n  x\t\ty", "a\x1c\nb\x85 c", "trail  ", " " * 3000 + "x", "a" * 5000, "-" * 300, "ÃÂ" * 200, "٣٤ ५ ½²", "漢字テスト" * 30, "x" * 100_000]
    odd += ["".join(r.choice(["the", "in", "ing", " ", "  ", "\n", "e", "er", "th", "h", "t", "é", "漢", "1", "'s", "\xa0", "😀"]) for _ in range(r.randrange(30))) for _ in range(1000)]
    odd += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(1, 0x500), r.randrange(0x2000, 0x3100)])) for _ in range(r.randrange(30))) for _ in range(500)]
    for text in odd:
        ids = np.frombuffer(own.encode(text), "<i4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_bounded_tables_change_nothing(monkeypatch):
    texts = [f"under the{k} thing {k * 7919} re-entered" for k in range(60)]
    want = [bpe.Tokenizer(PATH).encode(t) for t in texts]
    monkeypatch.setattr(bpe, "KNOWN", 5)
    monkeypatch.setattr(bpe, "TABLE", 7)
    monkeypatch.setattr(bpe, "LONG", 4)
    own = bpe.Tokenizer(PATH)
    assert [own.encode(t) for t in texts] == want and len(own._known) <= 5


def test_query_equals_the_library(spark, documents, corpus, tmp_path):
    path = str(tmp_path)
    rows = [*enumerate(corpus), (3, corpus[3]), (None, "no id")]
    documents(rows).withColumnRenamed("source", "ids").write.parquet(f"{path}/documents.parquet")
    library = tokenizers.Tokenizer.from_file(PATH)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in queries.op11_tokenization_automaton(spark, path).collect()]
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    stored = bpe.decode_documents(bpe.encode_documents(spark.read.parquet(f"{path}/documents.parquet"), PATH), PATH)
    assert sorted((tuple(r) for r in bpe.digests(stored).collect()), key=key) == sorted(want, key=key)
    assert bpe.encode_documents(documents(["x"]).where("false"), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
