import random

from pyspark.sql import functions as F

from waymark.operators import index, numbering, search


def texts(seed, n):
    r = random.Random(seed)
    return [(k, " ".join(r.choice(["sveti", "Župa", "crkva", "the", "thing", "most", "x"]) for _ in range(r.randrange(6)))) for k in range(n)]


def brute(rows, query):
    words = query.lower().split()
    fold = lambda s: s.lower().replace("ž", "z")
    return sorted(k for k, t in rows.items() if words and all(any(x.startswith(w[:-1]) if w.endswith("*") else x == w for x in fold(t).split()) for w in words))


def test_loads_replace_and_compact(spark, monkeypatch):
    monkeypatch.setattr(index, "BLOCK", 8)
    first, second = texts(1, 60), [*texts(2, 20), (100, "sveti novi"), (101, None)]
    rows = {k: t or "" for k, t in [*first, *second]}
    docs = lambda x: spark.createDataFrame(x, "id long, text string")
    stored = index.build(docs([*first, (None, "sveti")]), "id", ["text"])
    assert stored.add(docs(second), ["text"]) == 2
    compact = stored.compact()
    for q in ("sveti", "the zupa", "th* crkva", "t*", "novi", "absent", "", "sveti novi th*"):
        want = brute(rows, q)
        assert sorted(r.id for r in stored.search(q).collect()) == sorted(r.id for r in compact.search(q).collect()) == want, q
    assert compact.frequencies(["sveti"])["sveti"] == len(brute(rows, "sveti"))
    assert max(r.n for r in compact.postings().select(F.size("ids").alias("n")).collect()) <= 16


def test_a_search_reads_the_folders_of_its_words_only(spark):
    stored = index.build(spark.createDataFrame([(k, f"aa{k} bb{k} cc{k} dd{k} ee{k} ff{k}") for k in range(40)], "id long, text string"), "id", ["text"])
    every = len(stored.postings().inputFiles())
    plan = stored.documents_of("bb7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and every > 4
    assert len(stored._of(stored.postings(), "bb7").select(F.input_file_name()).distinct().collect()) == 1


def test_empty_index(spark):
    stored = index.build(spark.createDataFrame([], "id long, text string"), "id", ["text"])
    assert stored.search("a").count() == 0 and stored.add(spark.createDataFrame([(1, "a")], "id long, text string"), ["text"]) == 2
    assert [r.id for r in stored.search("a").collect()] == [1]


def test_rows_are_numbered_in_a_global_order(spark):
    r = random.Random(5)
    rows = [(k, r.choice([None, "a", "b"]), r.randrange(20)) for k in range(500)]
    df = spark.createDataFrame(rows, "k long, g string, v int").repartition(7)
    got = numbering.numbered(df, [F.desc("v"), "k"])
    assert [(x.k, x.place) for x in got.orderBy("place").collect()] == [(k, n) for n, (k, _, _) in enumerate(sorted(rows, key=lambda x: (-x[2], x[0])), 1)]
    by_group = {}
    for x in numbering.numbered(df, ["v", "k"], ["g"], "n", 0).orderBy("n").collect():
        by_group.setdefault(x.g, []).append(x.k)
    assert by_group == {g: [k for k, h, _ in sorted(rows, key=lambda x: (x[2], x[0])) if h == g] for g in (None, "a", "b")}
    assert "ExistingRDD" not in got._jdf.queryExecution().toString() and numbering.numbered(df.where("false"), ["k"]).count() == 0


def test_words_are_made_once_a_row(spark):
    df = spark.createDataFrame([(1, "the and that"), (2, "the and"), (3, None)], "id long, text string")
    found = search.search_rows(df, "id", ["text"], "the AND tha*")
    assert [r.id for r in found.collect()] == [1]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
