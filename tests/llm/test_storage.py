"""Written tables: what they leave on disk."""

import time

from pyspark.sql import functions as F

from kpiforge.llm.storage import CLEANUP, written


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("v"))
    got = written(sums.join(sums.withColumnRenamed("v", "w"), "k"), "sums")
    for _ in range(50):  # executors remove them in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and got.count() == 7
    assert spark.conf.get(CLEANUP, None) == setting
    # what was written from can be used again
    assert written(sums, "sums").agg(F.sum("v")).first()[0] == 499_500 == sums.agg(F.sum("v")).first()[0]
