"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine: tests and the bench."""
    conf = LOCAL_CONF | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory}
    return SparkSession.builder.master(f"local[{cores}]").appName("tallyloom").config(map=conf).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset, only a local master may fall back on a temporary folder; on a cluster that
    is an error, since such a folder would exist on one machine only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _local_folder()


@lru_cache(1)
def _local_folder() -> str:
    """A temporary folder of this process, removed at its end."""
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Spark send this package to its Python workers, once per application; they may not have it on their path."""
    context, package = spark.sparkContext, Path(__file__).parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    _SHIPPED.add(context.applicationId)
    folder = spark.conf.get("spark.checkpoint.dir", None) or _local_folder()
    folder = folder.removeprefix("file://") if folder.startswith("file://") else folder if ":/" not in folder else _local_folder()
    archive = Path(folder, f"{package.name}-{context.applicationId}.zip")
    archive.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive, "w") as z:
        for module in sorted(package.rglob("*.py")):
            z.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))  # the driver serves the file to the executors


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored reliably in the shared folder, without its lineage."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def telling(spark: SparkSession, tell: Callable[[str], None], every: float = 5.0) -> Iterator[None]:
    """Tells the progress of what runs inside, every ``every`` seconds: for each active stage its tasks, those done, running and failed.

    ``tell`` is called from a thread of its own; an error of it ends the telling, not the work.
    """
    tracker, stop = spark.sparkContext.statusTracker(), threading.Event()

    def watch() -> None:
        last = ""
        while not stop.wait(every):
            stages = [i for i in map(tracker.getStageInfo, tracker.getActiveStageIds()) if i is not None]
            now = "; ".join(f"stage {i.stageId}: {i.numCompletedTasks} of {i.numTasks} done, {i.numActiveTasks} running, {i.numFailedTasks} failed" for i in sorted(stages, key=lambda i: i.stageId))
            if now and now != last:
                tell(now)
                last = now

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        stop.set()
        thread.join()
