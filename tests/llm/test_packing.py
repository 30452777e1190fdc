import zlib

import numpy as np
import pytest

from waymark.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_the_library(corpus):
    reference = tokenizers.Tokenizer.from_file(PATH)
    odd = ["a\n b", "a\n\nb", " \n", "x<|endoftext|>y\nz", "it's\nwe'll \n  x\t\ty", "a\x1c\nb", "trail  ", " " * 3000 + "x", "12\n34 5", "é \n q"]
    for text in [t or "" for t in corpus if len(t or "") < 20000] + odd:
        assert packing.encoder(PATH)(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_cuts():
    for n in range(1, 6000):
        pieces = packing.cuts(n)
        assert sum(pieces) == n and max(pieces) <= 2048


def test_every_token_once_without_gaps(documents, corpus):
    texts = [*corpus, *corpus[:20]]
    rows = packing.pack(documents(texts), PATH).collect()
    encode = packing.encoder(PATH)
    spans, bins = {}, {}
    for r in rows:
        spans.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    for k, text in enumerate(texts):
        ids = np.append(encode(text or ""), 1).astype("<u4")
        at = 0
        for r in sorted(spans[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    total = 0
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
    assert total / (2048 * len(bins)) > 0.85


def test_nulls_and_empty(documents):
    rows = packing.pack(documents([(None, None), (1, ""), (1, "")]), PATH).collect()
    assert sorted((r.doc_id or -1, r.length, r.doc_tokens) for r in rows) == [(-1, 1, 1), (1, 1, 1), (1, 1, 1)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(documents(["x"]).where("false"), PATH).count() == 0
