"""Event files of the streams: compressed, as many as they were asked for, all of them taken in."""
from pathlib import Path

from conftest import SMALL

from lakevault.plans.registry import event_files


def test_event_files_are_compressed(spark, folder):
    event_files(spark, SMALL, folder)
    files = [path.name for path in Path(folder.removeprefix("file:")).rglob("part-*")]
    assert len(files) == 4 and all(name.endswith(".json.gz") for name in files)
    assert spark.read.text(f"{folder}/events").count() == spark.read.parquet(f"{SMALL}/events.parquet").count()
