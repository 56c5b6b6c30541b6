from pathlib import Path

from shoreline.catalog import queries
from shoreline.catalog.frames import DATE, SampleSources
from shoreline.sources import lake as tables

FOLDER = "/root/testdata/sf0.001"


def test_the_sample_lake_is_compressed_and_whole(spark):
    src = SampleSources(spark, FOLDER)
    lake = queries._raw_lake(src)
    files = list(Path(lake.raw).rglob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
    orders = tables.read_raw(spark, lake, "orders", DATE)
    assert orders.count() == src.customer_orders().count() + src.product_orders().count()
    assert tables.read_raw(spark, lake, "transactions", DATE).count() == src.transactions().count()
