import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from waymark.llm import merkle


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    low = str.maketrans(merkle.UPPER, merkle.UPPER.lower())
    trees, out = defaultdict(list), []
    for doc, text, lang, source, n in rows:
        leaf, changed = (h("".join(map(part, (doc, source, lang, n, t)))) for t in (text, text and text.translate(low)))
        trees[lang].append((doc is not None, doc or 0, leaf, changed, doc))
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = {k: levels([x[2] for x in sorted(trees[k])]) for k in names}
    top = levels([built[k][-1][0] for k in names])
    for j, k in enumerate(names):
        for i, (_, _, leaf, changed, doc) in enumerate(sorted(trees[k])):
            runs = []
            for own, at in ((built[k], i), (top, j)):
                for level in own[:-1]:
                    first = at // 8 * 8
                    runs.append(("".join(level[first:at]), "".join(level[at + 1 : first + 8])))
                    at //= 8
            now = changed if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 else leaf
            for a, b in runs:
                now = h(a + now + b)
            out.append((doc, leaf, built[k][-1][0], top[-1][0], h("".join(a + b for a, b in runs)), now, now == top[-1][0]))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("tree", F.lit("x")).withColumn("idx", F.lit(9)).repartition(3)
    assert sorted(map(tuple, merkle.prove(docs).collect()), key=str) == brute(rows)


def test_equals_brute_force(spark, monkeypatch):
    rows = [(k, f"Text {k} É" if k % 5 else None, ["en", "de", "é", None][k % 7 % 4], None if k % 3 else "s", k) for k in range(200)]
    rows += [(7, "Text 7", "en", "s", 1), (7, "other", "en", "s", 1), (7, "other", "en", "s", 1), (None, "No id", "en", None, None), (300, "", "", "", 0), (301, "A" * 100_000, "lone", "s", 1), (302, None, None, None, None)]
    check(spark, rows)
    monkeypatch.setattr(merkle, "SHARED", 4)  # most levels by the shuffled join
    check(spark, rows)


def test_many_groups_and_lone_ones(spark):
    check(spark, [(k, "T", f"l{k}", "s", 1) for k in range(70)])
    check(spark, [(1, "Alone", "en", "s", 1)])
    check(spark, [(k, "Same tree", "en", "s", 1) for k in range(9)])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.prove(docs).count() == 0


def test_fields_do_not_run_together(spark):
    rows = [(1, "b", "en", "a:", 1), (2, ":b", "en", "a", 1), (3, "-", "en", "s", 1), (4, None, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert len({r.leaf for r in merkle.prove(docs).collect()}) == 4
