"""Rows that cost much more time than bytes are worked on by every core, also where their file is one task."""

from pyspark.sql import functions as F

from dossier.functions.frames import dealt
from dossier.operators import html, profile_claims, profile_diff


def _one_file(spark, folder):
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("<a href='x'>t</a>").alias("html")).coalesce(1)
    pages.write.parquet(f"{folder}/p.parquet")
    return spark.read.parquet(f"{folder}/p.parquet")


def test_pages_of_one_file_are_read_by_many_tasks(spark, tmp_path):
    pages = _one_file(spark, tmp_path)
    assert pages.rdd.getNumPartitions() == 1
    nodes = html.tree(pages)
    assert nodes.where("tag = 'a'").count() == 200 and nodes.select(F.spark_partition_id().alias("p")).distinct().count() >= 4


def test_dealt_rows_are_not_merged_again(spark):
    rows = dealt(spark.range(100).coalesce(1), "id")
    assert rows.count() == 100 and rows.select(F.spark_partition_id().alias("p")).distinct().count() >= 4


def test_profiles_are_dealt_before_they_are_parsed(spark):
    sf = "/root/testdata/sf0.001"
    for profiles in (profile_claims._profiles(spark, sf), *profile_diff.versions(spark, sf)):
        assert profiles.select("organisation_number", F.spark_partition_id().alias("p")).select("p").distinct().count() >= 4
