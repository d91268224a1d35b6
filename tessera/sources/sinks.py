"""What a run leaves behind: a file for each item in two trees, and a summary in the order of the tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The trees with a file for each item, and the summary.
WHOLE, FINAL, SUMMARY = "per_image", "final_labels", "summary.jsonl"


def place(spark, *parts: str):
    """A path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def prepare(spark, folder: str, overwrite: bool = False) -> None:
    """Make the folders; on demand without the files of an earlier run. A summary of an earlier run always goes."""
    for tree in (WHOLE, FINAL):
        path, files = place(spark, folder, tree)
        if overwrite and files.exists(path):
            for status in files.listStatus(path):
                if status.getPath().getName().endswith(".json"):
                    files.delete(status.getPath(), False)
        files.mkdirs(path)
    path, files = place(spark, folder, SUMMARY)
    files.delete(path, True)


def write_items(rows: DataFrame, folder: str) -> None:
    """Files named by item, each with its JSON text: (item, text). Executors write them where `folder` leads, so it must be one that all of them share."""

    def write(part) -> None:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for row in part:
            with system.open_output_stream(f"{base.rstrip('/')}/{row.item}.json") as out:
                out.write(row.text.encode())

    rows.select("item", "text").foreachPartition(write)


def write_summary(rows: DataFrame, folder: str, order: str = "path") -> int:
    """One JSON line for each row in order; how many there are. Lines are streamed through the driver, a partition at a time."""
    spark = rows.sparkSession
    path, files = place(spark, folder, SUMMARY)
    out, n = files.create(path, True), 0
    try:
        lines = rows.select(order, F.to_json(F.struct(*[c for c in rows.columns if c != order]), {"ignoreNullFields": "false"}).alias("line")).orderBy(order)
        for row in lines.toLocalIterator():
            out.write(bytearray((row.line + "\n").encode()))
            n += 1
    finally:
        out.close()
    return n
