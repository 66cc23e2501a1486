"""Materialised tables of a composite query stand as Parquet in the shared folder."""

import glob

import pyarrow.parquet as pq

from itemrank import session
from itemrank.plans import tables


def test_ratings_and_latest_are_written_as_columns(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    spark.sql("select id as o_orderkey, id % 7 as o_custkey from range(50)").write.parquet(f"{d}/orders.parquet")
    spark.sql("select id % 50 as l_orderkey, id % 11 as l_partkey, cast(id % 40 + 1 as double) as l_quantity, "
              "date'1998-01-01' as l_shipdate from range(300)").write.parquet(f"{d}/lineitem.parquet")
    t = tables.Tables(spark, str(d), materialize=True)
    for df, least in ((t.ratings, 300), (t.latest, 77)):
        files = df.inputFiles()
        assert files and all(f.endswith(".parquet") for f in files)
        assert df.count() == least
    folder = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    found = glob.glob(f"{folder}/latest-*/*.parquet")
    assert found and set(pq.read_schema(found[0]).names) == {"movie_id", "user_id", "rating", "timestamp"}
