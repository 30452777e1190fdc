import math
from collections import Counter

from waymark.llm import lmscore


def test_counts_are_of_real_words_and_bigrams(documents, spark, monkeypatch):
    """So many words and bigrams that hashing to 2^16 ids or 2^20 cells would mix their counts."""
    monkeypatch.setattr(lmscore, "BUCKET", 1 << 16)
    texts = [" ".join(f"n{(k * 7919 + j * j) % 70_000}" for j in range(2000)) for k in range(60)] + ["a b a b A c", "", None]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(0, 50)], "doc_id long, quality int")
    words = {k: (t or "").lower().split() for k, t in enumerate(texts)}
    vocab = max(lmscore.VOCAB, len({w for ws in words.values() for w in ws}))
    models = []
    for chosen in ([k for k in words if k < 50 and k % 3 == 0], list(words)):
        pairs = Counter(p for k in chosen for p in zip(["", *words[k]], words[k], strict=False))
        single, seen = Counter(), Counter()
        for (a, b), n in pairs.items():
            seen[a] += n
            single[b] += n
        models.append((pairs, single, seen, sum(single.values())))

    def loss(model, ws):
        pairs, single, seen, total = model
        p = [(single[b] + 1) / (total + vocab) for b in ws]
        p = [lmscore.WEIGHT * pairs[a, b] / seen[a] + (1 - lmscore.WEIGHT) * q if seen[a] else q for a, b, q in zip(["", *ws], ws, p, strict=False)]
        return -sum(map(math.log, p)) / len(ws)

    rows = lmscore.cross_entropy_difference(documents([*texts, (None, "a b")]), labels.union(labels)).collect()
    assert len(rows) == len(texts) + 1
    models[1][0].update({("", "a"): 1, ("a", "b"): 1})
    models[1][1].update({"a": 1, "b": 1})
    models[1][2].update({"": 1, "a": 1})
    models[1] = (*models[1][:3], models[1][3] + 2)
    for r in rows:
        ws = words[r.doc_id] if r.doc_id is not None else ["a", "b"]
        assert r.n_tokens == len(ws)
        if ws:
            assert math.isclose(r.target_loss, loss(models[0], ws), rel_tol=1e-9) and math.isclose(r.background_loss, loss(models[1], ws), rel_tol=1e-9)
        else:
            assert r.score is None
