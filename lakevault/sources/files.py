"""What lies in a folder, on any file system Spark knows."""
from __future__ import annotations

from pyspark.sql import DataFrameWriter, SparkSession

# Raw files readers take, plain or compressed.
RAW_FILES = "*.{json,txt,json.gz,txt.gz}"

# Compressed files are read by one task each, so none holds more rows than this.
ROWS_PER_FILE = 500_000


def compressed(writer: DataFrameWriter) -> DataFrameWriter:
    """Land text compressed, in files small enough to be read side by side."""
    return writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)


def has_files(spark: SparkSession, path: str) -> bool:
    """Is there any file to read? The listing stops at the first one that readers would see.

    Like the readers it passes over files in or below anything hidden, such as ``_temporary``, which a write that died
    leaves behind.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return False
    top = system.getFileStatus(folder).getPath().toUri().getPath()
    files = system.listFiles(folder, True)
    while files.hasNext():
        below = files.next().getPath().toUri().getPath()[len(top) :]
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            return True
    return False


def is_written(spark: SparkSession, path: str) -> bool:
    """Did a write to this folder come to its end?"""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def written_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders of a pattern whose writes came to their end; their files are not listed."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(status.getPath().getParent().toString() for status in found or [])
