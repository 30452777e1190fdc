import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from waymark.functions import text
from waymark.sources import readers, registry


def test_versions_are_read_as_one_table(spark, tmp_path):
    table = registry.Table("t", ("id int, name string", "id bigint, title string, area double"), {2: {"name": "title"}}, required=("title",), unique=("id",))
    assert table.read(spark, str(tmp_path)).columns == ["id", "title", "area"]
    table.write(spark.createDataFrame([(1, "a"), (2, None)], "id int, name string"), str(tmp_path), 1)
    table.write(spark.createDataFrame([(2, "b", 1.5)], "id long, title string, area double"), str(tmp_path))
    got = table.read(spark, str(tmp_path))
    assert got.schema.simpleString() == "struct<id:bigint,title:string,area:double>"
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a", None), (2, "b", 1.5), (2, None, None)]
    assert sorted(map(tuple, table.faults(got).collect())) == [("null", "title", 1), ("repeated", "id", 1)]
    with pytest.raises(ValueError):
        table.migrated(got.withColumn("other", F.lit(1)), 2)


def test_published_tables(spark, tmp_path):
    for table in registry.TABLES.values():
        assert table.read(spark, str(tmp_path)).count() == 0
    old = registry.TABLES["parishes"]
    assert old.schema().names[:-1] == old.schema(1).names and old.schema().names[-1] == "duplicate_of"


def test_landed_answers_fall_back(spark, tmp_path):
    put = lambda request, body: (tmp_path / readers.landing_name(request)).write_text(body)
    put("b", "")
    put("c", '{"x": [1')
    put("b2", '{"n": "ž"}')
    put("c3", "[2]")
    put("unasked", "{}")
    put("a", '{"n": 1}')
    got = {r.request: (r.used, json.loads(r.body) if r.body else None) for r in readers.answers(spark, str(tmp_path), [["a", "b2"], ["b", "b2"], ["c", "missing", "c3"], ["missing"]]).collect()}
    assert got == {"a": ("a", {"n": 1}), "b": ("b2", {"n": "ž"}), "c": ("c3", [2]), "missing": (None, None)}


def test_all_letters_fold(spark):
    texts = ["Nguyễn Thị Ước", "Ελλάδα Ἀθῆναι", "Й́ ё", "é", "Ďakovo đ Đ", "ﬁn ½ ™ 한글", "plain", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in text.decomposed(df.withColumn("one", text.strip_diacritics(F.col("t"))), "t", "all").collect()]
    want = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s.translate(str.maketrans("đĐ", "dD"))) if not unicodedata.combining(c))
    assert {t: full for t, _, full in got} == {t: t if t is None else want(t) for t in texts}
    assert {t: one for t, one, _ in got if t in texts[:5]} == {t: want(t) for t in texts[:5]}
