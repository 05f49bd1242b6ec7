"""Incremental ingest: files landing in two rounds are each loaded exactly once."""

import os
import shutil

from test_ingest import APRIL, AUGUST, MAY

from ledgerline.streaming.incremental import in_load_order, load_new_files, refresh_warehouse


def test_incremental_load(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    staging = os.path.join(tmpdir_path, "staging")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    for name, data in (("april_2015.csv", APRIL), ("august_2015.csv", AUGUST)):
        with open(os.path.join(landing, name), "wb") as f:
            f.write(data)
    load_new_files(spark, landing, staging, ckpt)
    assert spark.read.parquet(staging).count() == 4
    with open(os.path.join(landing, "may_2015.csv"), "wb") as f:
        f.write(MAY)
    load_new_files(spark, landing, staging, ckpt)  # only the new file is loaded
    stg = spark.read.parquet(staging)
    assert stg.count() == 7
    assert stg.select("_source_file", "_row_idx").distinct().count() == 7
    assert stg.count() == in_load_order(stg).select("_row_key").distinct().count()
    t = refresh_warehouse(spark, staging)
    assert t.fact.count() == 7 and t.fact.where("supplier_key IS NULL").count() == 0
