"""The trusted target holds every good label."""

from eventmill.llm import quality


def test_all_good_labels_count(spark):
    labels = spark.range(60_000).selectExpr("id as doc_id", "cast(id % 6 > 0 as int) + cast(id % 6 = 1 as int) as quality", "0 as toxic")
    wanted = labels.where("quality = 1").union(labels.where("quality = 1").limit(5)).union(labels.selectExpr("cast(null as long)", "1", "0").limit(2))
    assert quality.trusted_ids(wanted).count() == 40_000
    assert quality.trusted_ids(spark.range(60_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")).count() == 60_000
