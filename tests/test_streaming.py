"""File-arrival staging stream: each landed file is loaded exactly once."""

import os
import tempfile

from kpiforge.sources.contracts import ORDERS
from kpiforge.streaming.file_loads import start_staging_stream

HEADER = ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
          "order_delivered_customer_date,order_estimated_delivery_date")


def _land(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        f.write(HEADER + "\n" + "\n".join(rows) + "\n")


def test_stream_loads_each_file_once(spark):
    base = tempfile.mkdtemp(prefix="kpiforge-test-stream-")
    landing, table, ckpt = (os.path.join(base, x) for x in ("landing", "table", "ckpt"))
    os.makedirs(landing)
    _land(landing, "a.csv", ["o1,c1,delivered,,2018-01-01 00:00:00,2018-01-03 00:00:00,NA",
                             "o2,c2,shipped,,bad,,2018-02-01 00:00:00"])
    cols = HEADER.split(",")
    q = start_staging_stream(spark, landing, ORDERS, cols, table, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 2
    q = start_staging_stream(spark, landing, ORDERS, cols, table, ckpt)     # rerun: nothing new
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 2
    _land(landing, "b.csv", ["o3,c3,delivered,,2018-03-01 00:00:00,2018-03-02 00:00:00,"])
    q = start_staging_stream(spark, landing, ORDERS, cols, table, ckpt)
    q.awaitTermination(120)
    df = spark.read.parquet(table)
    counts = dict(df.groupBy("_source_file").count().collect())
    assert counts == {"a.csv": 2, "b.csv": 1}
    r = {x["order_id"]: x for x in df.collect()}
    assert r["o2"]["order_approved_at"] is None and r["o1"]["order_estimated_delivery_date"] is None
