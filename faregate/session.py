"""Session profiles and the shared scratch folder.

Two profiles. ``teaching`` switches adaptive execution off so that skew stays
visible in the stage report; ``production`` leaves every run-time remedy on.
"""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that can change on a running session.
SQL_PROFILES: dict[str, dict[str, str]] = {
    "teaching": {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "10485760",
        "spark.sql.session.timeZone": "UTC",
    },
    "production": {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "134217728",
        "spark.sql.autoBroadcastJoinThreshold": "10485760",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    },
}

# Settings taken when the JVM starts.
LAUNCH_PROFILES: dict[str, dict[str, str]] = {
    "teaching": {
        "spark.driver.memory": "3g",
        "spark.driver.maxResultSize": "512m",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    },
    "production": {
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    },
}


def build_session(
    profile: str = "production",
    app_name: str = "faregate",
    master: str | None = None,
    event_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or fetch) a session with one of the profiles; the web page stays off."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    conf = {**LAUNCH_PROFILES[profile], **SQL_PROFILES[profile]}
    if event_dir:
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.compress"] = "false"  # a running session's log stays readable
        conf["spark.eventLog.dir"] = event_dir if "://" in event_dir else f"file://{event_dir}"
    for name, value in {**conf, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the shuffle width for an input: about 256 MB each, at least 200 partitions.

    Adaptive execution joins partitions that turn out small, so a wide start
    costs little; too narrow a start spills. Hot keys are judged against this
    width as well.
    """
    partitions = max(input_bytes // (256 << 20), 200)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def flush_events(spark: SparkSession, wait_ms: int = 10_000) -> None:
    """Wait until the running session has written its events to its log."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(wait_ms)


def variant_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A sibling session on the same cluster with its own SQL settings.

    Comparing plans under different settings must not change the caller's
    session, so each variant reads its tables through a session of its own.
    """
    sibling = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and sibling.conf.isModifiable(name):
            sibling.conf.set(name, value)
    for name, value in settings.items():
        sibling.conf.set(name, value)
    return sibling


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may start where it cannot be imported."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"  # on the driver, which serves it
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder the cluster names.

    On several machines a folder of one machine would lose what the others
    write, so there a missing setting is an error. Only where driver and tasks
    share one process (``local`` masters: tests, a laptop) a temporary folder is
    made; it is removed when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="faregate-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/faregate-{uuid.uuid4().hex}"
