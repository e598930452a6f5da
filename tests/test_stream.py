from datetime import datetime

from pyspark.sql import functions as F

from fairlead.operators.state import EventStore
from fairlead.streaming.incremental import first_seen, into_store, stream_pages
from tests.test_engine import ICS


def test_landed_pages_are_merged_once(spark, tmp_path):
    src = spark.createDataFrame([("c", 0, "Gamma", "ical")], "source_id string, source_seq bigint, org_name string, adapter_type string").withColumn("acquisition_policy", F.create_map(F.lit("max_urls"), F.lit("300")))
    land, store = str(tmp_path / "land"), EventStore(spark, str(tmp_path / "store"))
    for n in range(2):
        spark.createDataFrame([("c", n, "u", 200, ICS)], "source_id string, page_seq bigint, url string, status int, body string").write.mode("append").parquet(land)
        q = into_store(stream_pages(spark, land), src, store, str(tmp_path / "checkpoint"), lambda n=n: datetime(2026, 1, 1 + n))
        q.awaitTermination(120)
    rows = store.all_events()
    assert rows.count() == 55 and rows.filter("first_seen < last_seen").count() == 55


def test_a_replayed_batch_keeps_its_time(spark, tmp_path):
    at = str(tmp_path / "seen")
    assert first_seen(spark, at, datetime(2026, 1, 1)) == first_seen(spark, at, datetime(2026, 1, 2)) == datetime(2026, 1, 1)
