"""Session helpers: the shared scratch folder and tables written to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read, from ``spark.checkpoint.dir``.

    Only where the session names none (local tests) a folder of this machine is made and set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = "file://" + tempfile.mkdtemp(prefix="gramspan_")
        spark.conf.set("spark.checkpoint.dir", at)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


_made: list[str] = []


@atexit.register
def _clean() -> None:
    """Takes away the tables of this driver's runs when it ends, as far as its file system lets it."""
    from pyarrow import fs

    for root in _made:
        with contextlib.suppress(Exception):
            where, at = fs.FileSystem.from_uri(root)
            where.delete_dir(at)


class Scratch:
    """Tables of one operator run, kept under a folder of their own in the shared folder.

    ``keep`` writes a DataFrame as Parquet and returns it as read back: lineage ends there and
    a lost executor costs no recomputation beyond its own tasks. ``drop`` deletes what is no
    longer read, so that a run holds only what it still needs.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}_{uuid.uuid4().hex[:12]}"
        _made.append(self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        schema = df.schema
        df.write.options(compression="zstd", **options).mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names or ("",):
            at = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
            at.getFileSystem(conf).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, once per application."""
    import io
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_gramspan_shipped", False):
        return
    home = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="gramspan_src_")) / "gramspan_src.zip"
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for file in sorted(home.rglob("*.py")):
            z.write(file, f"gramspan/{file.relative_to(home)}")
    at.write_bytes(held.getvalue())
    sc.addPyFile(str(at))
    sc._gramspan_shipped = True
