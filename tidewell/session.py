"""Session set-up and the two ways a frame is cut loose from its lineage.

``settle`` is for statistics: bounded results become a local relation whose exact
size Catalyst knows, so it picks broadcast or shuffle joins from a measured size.
``durable`` is for data: it is written once to the shared checkpoint folder, so a
lost executor re-reads files instead of re-running everything upstream.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SETTLE_ROWS = 200_000
SETTLE_BYTES = 64 << 20


def build_session(app_name: str = "tidewell", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings this library is tuned for; ``conf`` keys use ``__`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # one task is one core; array libraries must not start threads of their own
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def _one_machine(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once per application: functions in tasks are found by module name there."""
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    place = os.path.join(tempfile.mkdtemp(prefix="tidewell-"), f"tidewell-{uuid.uuid4().hex}.zip")
    with open(place, "wb") as file:  # on the driver, which serves it to the executors
        file.write(packed.getvalue())
    spark.sparkContext.addPyFile(place)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where everything runs on one machine is one made for the run; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _one_machine(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidewell-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed."""
    return f"{shared_root(spark)}/tidewell/{tag}-{uuid.uuid4().hex}"


def durable(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_counted(stats: DataFrame, max_rows: int = SETTLE_ROWS) -> tuple[DataFrame, int | None]:
    """Compute a frame once: ``(local relation, its row count)`` up to ``max_rows`` rows and ``SETTLE_BYTES``,
    else ``(written table, None)``."""
    head = stats.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows and head.nbytes <= SETTLE_BYTES:
        return stats.sparkSession.createDataFrame(head, schema=stats.schema), head.num_rows
    return durable(stats, "stats"), None


def settle(stats: DataFrame, max_rows: int = SETTLE_ROWS) -> DataFrame:
    """Compute a statistics frame once.

    Up to ``max_rows`` rows come back as a local relation of known size; a larger
    result is written and re-read, and joins against it stay distributed.
    """
    return settle_counted(stats, max_rows)[0]
