"""Landed text is compressed, in files of bounded rows, and read back whole."""
from pathlib import Path

from conftest import SMALL
from helpers import LOADED, dataset
from pyspark.sql.classic.dataframe import DataFrame

from lakevault.plans import registry
from lakevault.sources import files
from lakevault.sources.landing import land_batch
from lakevault.sources.ledger import raw_files
from lakevault.sources.raw import read_batches
from lakevault.sources.schemas import SOURCES


def test_landed_rows_are_compressed_and_read_back(spark, folder, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 40)
    names = [{"seller_id": f"s{n}", "seller_zip_code_prefix": "1", "seller_city": "á ", "seller_state": "SP"} for n in range(100)]
    rows = dataset(spark, "sellers", names).select(*SOURCES["sellers"].columns).coalesce(1)
    assert land_batch(rows, folder, "sellers", LOADED.date()).count() == 100
    landed = [f for f in Path(folder.removeprefix("file:")).rglob("part-*")]
    assert len(landed) == 3 and all(f.name.endswith(".json.gz") for f in landed)
    found = read_batches(spark, folder, "sellers", LOADED)
    assert sorted(found.select(*rows.columns).collect()) == sorted(rows.collect())
    assert found.select("seq").distinct().count() == 3 == raw_files(spark, folder, "sellers").count()


def test_the_event_roundtrip_fixes_no_number_of_files(spark, monkeypatch):
    asked, plain = [], DataFrame.repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda self, *by: (asked.append(by), plain(self, *by))[1])
    assert registry.raw_event_roundtrip(spark, SMALL).count() > 0
    assert asked == [("event_id",)]
