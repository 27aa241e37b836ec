"""The plan of the URL filter."""

from pyspark.sql import functions as F

from basketry.llm import urls
from basketry.llm.queries import RULES


def test_the_plan_does_not_double_with_each_level(spark):
    pages = spark.range(200).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("http://a.net/x"), F.col("id") % 30, F.lit("/y/z/"), F.col("id")).alias("url"),
    )
    out = urls.judge(pages, RULES)
    assert out._jdf.queryExecution().analyzed().toString().count("Aggregate") < 10
    assert out.count() == 200
