from pyspark.sql import functions as F

from waymark.operators import search
from waymark.plans import catalogue


def test_places_are_numbered_without_a_window_over_all_rows(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(5)
    placed = search.ranked_pages(rows, ["k"])
    assert sorted((r.k, r.place) for r in placed.collect()) == [(k, k + 1) for k in range(1000)]
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    # the only window adds up the counts of the ranges
    assert "ExistingRDD" not in plan and plan.count("Window [") == 1 and "Window [sum(_n" in plan


def test_locale_order_reads_whole_texts(spark, tmp_path):
    spark.createDataFrame([(1, "čaj dud " + "x" * 80 + " cvijet")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.word: r.place for r in catalogue.QUERIES["locale_order"](spark, str(tmp_path)).collect()}
    assert got == {"cvijet": 1, "čaj": 2, "dud": 3, "x" * 80: 4}
