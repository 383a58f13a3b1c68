"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Settings every session of this engine relies on. Partition counts are left to AQE: the initial
# number is a ceiling that coalescing brings down, so it is safe to set it high on a cluster.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


_LOCAL_ROOTS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in SESSION_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, unless they find it by PYTHONPATH."""
    package = Path(__file__).resolve().parent
    found = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    application = spark.sparkContext.applicationId
    if str(package.parent) in found or application in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="millrace-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the cluster.

    Only a local session without the setting (a test) gets a temporary folder of its own; on a cluster
    such a folder would be another one on each machine.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all machines share (master is {master})")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="millrace-")
        root = _LOCAL_ROOTS[application]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless the cluster already did."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(spark)}/checkpoints")


def local_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A handful of driver rows as a local relation, which Spark can work on without a job."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import MapType, StructType

    struct = StructType.fromDDL(schema)
    maps = {f.name for f in struct if isinstance(f.dataType, MapType)}
    plain = [
        {k: list(v.items()) if k in maps and v is not None else v for k, v in row.items()} for row in rows
    ]
    table = pa.Table.from_pylist(plain, schema=to_arrow_schema(struct))
    return spark.createDataFrame(table, struct)
