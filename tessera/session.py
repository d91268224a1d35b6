"""Sessions, and how this package gets to the Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the operators expect."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tessera")
    settings = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.sql.adaptive.enabled": "true"}
    return builder.config(map=settings | conf).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to workers that would not find it, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    if str(ROOT) in {os.path.abspath(p) for p in [os.getcwd(),
            *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p} and spark.sparkContext.master.startswith("local"):
        return
    place = Path(os.path.realpath(tempfile.mkdtemp())) / "tessera_package.zip"
    with zipfile.ZipFile(place, "w") as z:
        for f in sorted((ROOT / "tessera").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(place))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where the setting is absent and everything runs in this one process is it a temporary folder of this machine's."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.gettempdir()}/tessera-checkpoints"
    return folder.rstrip("/")


def materialized(df: DataFrame, name: str = "stage") -> DataFrame:
    """The rows from a Parquet table in the shared folder: computed once for all that read them, with a short plan, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table made by materialized(), when nothing will read it again."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
