"""The load of reports deals a small file's rows before it makes pages of them."""

from brightledger.plans import report_load_queries as Q


def test_pages_of_a_small_file_are_made_in_all_parts(spark, tmp_path):
    spark.range(200).selectExpr("id AS c_custkey", "'M' AS c_mktsegment").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    pages = Q.made_reports(spark, f"file://{tmp_path}")
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and pages.count() == 200
