"""The five stages of the pipeline on planted documents against a plain chain of them."""

import random

import pytest

from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_jaccard import brute as jaccard_brute
from tests.llm.test_rest import line_brute
from tests.llm.test_templates_brute import brute as leak_brute
from waymark.llm import quality

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def vocabulary():
    r = random.Random(5)
    return ["".join(r.choice("bcdfghklmnprstvz") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(600)]


WORDS = vocabulary()


def lines(seed, n, width=9):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(width)) for _ in range(n)]


def test_run_matches_the_plain_chain(spark, tmp_path):
    item = "Vera packs 12 crates of apples and 7 sacks of flour; after lunch she loads 30 more crates on the truck and drives 45 km. How many crates are there?"
    shared = lines(900, 14)
    texts = ["\n".join(lines(k, 8)) for k in range(20)]
    texts += ["\n".join([*lines(100 + k, 5), *shared, *lines(200 + k, 5)]) for k in range(6)]
    texts += [texts[0], texts[1].replace(texts[1].split()[3], "changed", 1), "short", None, "a b c " * 90]
    texts += ["\n".join([*lines(300, 6), item, *lines(301, 6)]), "\n".join([*lines(302, 6), item.replace("12", "15").replace("45", "60"), *lines(303, 6)])]
    rows = list(enumerate(texts))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, prose(3, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = {r.doc_id for r in quality.quality_signals(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect() if r.kept}
    want = [(i, t) for i, t in rows if i in kept]
    assert 20 < len(want) < len(rows)
    cut = line_brute(want)
    want = [(i, cut[i][0]) for i, _ in want if not cut[i][1] or (cut[i][0] or "").strip(" ")]
    group = jaccard_brute(want)
    want = [(i, t) for i, t in want if group[i][1] == i]
    leaked = {d for d, _ in leak_brute(want, [(1, item), (2, prose(3, 30))])}
    assert leaked
    want = [(i, t) for i, t in want if i not in leaked]

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    from tokenizers import Tokenizer

    from waymark.llm.queries import tokenizer_path

    tokenizer = Tokenizer.from_file(tokenizer_path())
    sizes = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in want}
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == sizes


def test_run_handles_odd_rows_and_columns(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [(k, "\n".join(lines(k, 8))) for k in range(12)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (23, rows[3][1]), (3, rows[3][1]), (24, "\n".join(lines(500, 5000)))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    # names that the stages use themselves
    for name in ("lines", "spans", "ratio", "kept", "class", "component_id"):
        docs = docs.withColumn(name, F.lit("x"))
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(3, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in quality.quality_signals(docs).collect() if r.kept}
    assert kept.isdisjoint({20, 21, 22}) and 24 in kept
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    whole = {}
    for p in pieces:
        whole[p.doc_id] = whole.get(p.doc_id, 0) + p.length
    assert set(whole) == kept - {23} and all(p.doc_tokens * (2 if p.doc_id == 3 else 1) == whole[p.doc_id] for p in pieces)


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(3, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
