import re

import pytest

from waymark.llm import jaccard


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = sorted((root(a), root(b)))
                label[rb] = ra
    return {i: (max(map(len, sets[i])), root(i)) for i in ids}


@pytest.mark.parametrize("pivots", [(), (1,), (2, 8, 32)])
def test_components_match_brute_force(documents, corpus, pivots):
    rows = list(enumerate(corpus))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(documents(rows), pivots=pivots).collect()}
    assert got == brute(rows)


def test_threshold_is_exact(documents):
    words = [f"w{k}" for k in range(44)]  # 40 shingles
    texts = [" ".join(words), " ".join(words[:36]), " ".join(words[:35]), " ".join(words[4:]), " ".join(words + ["x"] * 5)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(documents(rows)).collect()}
    assert got == brute(rows)


def test_repeated_and_null_ids(documents):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(1, a), (1, b), (2, a), (3, b), (4, "z z"), (4, "z z")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(documents([*rows, (None, a)])).collect()}
    assert got.pop(None) == (6, None)
    assert got == brute(rows)


def test_empty_table_and_clashing_columns(documents, spark):
    assert jaccard.jaccard_join(documents(["x"]).where("false")).count() == 0
    docs = documents(["a b c d e f", "A b c d e f", None]).withColumnsRenamed({"lang": "h", "source": "label"})
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]
