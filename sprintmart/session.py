"""Session settings and shared scratch space."""

from __future__ import annotations

import contextlib
import functools
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def build_session(app: str = "sprintmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on.

    UTC makes zone-less source timestamps mean the same instant everywhere. Adaptive execution
    splits skewed join partitions and turns joins into broadcasts from measured sizes, which is
    why no operator here hints a broadcast for data that grows.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Whether the files of a statement's shuffles go when the statement ends. Else they stay until the driver happens to
#: collect garbage, which a run of many statements may not see before its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: list[SparkSession] = []
_CLEANING_LOCK = threading.Lock()


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the statements inside end with their statement, unless the session has a setting of its own.

    For runs that store what they read again: a frame executed a second time would shuffle again.
    """
    with _CLEANING_LOCK:
        # Nested and concurrent uses: the first sets it, the last takes it away.
        mine = any(s is spark for s in _CLEANING) or spark.conf.get(_CLEANUP, "false") == "false"
        if mine:
            _CLEANING.append(spark)
            spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            if mine:
                del _CLEANING[next(i for i, s in enumerate(_CLEANING) if s is spark)]
                if not any(s is spark for s in _CLEANING):
                    spark.conf.unset(_CLEANUP)


def release_driver(spark: SparkSession) -> None:
    """Let the driver give back what ended statements left: plans, broadcasts and results that nothing refers to.

    The JVM holds on to its garbage until its heap is full, and keeps the heap at the size that took; a collection
    shrinks it to what is in use. For runs of many statements, between two of them; it takes a fraction of a second.
    """
    gc.collect()  # frames that Python no longer uses hold their plans in the JVM
    spark._jvm.System.gc()


def require_utc(spark: SparkSession) -> None:
    """Fail early where zone-less source timestamps would be read in another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}:
        raise ValueError(f"the session time zone is {zone}, it must be UTC")


def together(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Results of jobs that do not depend on each other, run side by side, so that one's last tasks leave no cores idle;
    the first error is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [r.result() for r in running]


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="sprintmart-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for one run's intermediate tables, in the folder the cluster shares.

    The shared folder is ``spark.checkpoint.dir``; only a session without that setting on one
    machine (a test) falls back to a temporary folder. On a cluster that folder would be another
    one on each executor, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
