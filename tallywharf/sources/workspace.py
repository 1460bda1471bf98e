"""A fresh folder for stream state and tables, reachable from every executor."""

import tempfile
import uuid


def fresh_folder(spark, purpose):
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Without that setting only a local session may go on, as it needs no shared folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark):
    """Makes ``DataFrame.checkpoint`` usable where the session has no checkpoint folder yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(fresh_folder(spark, "checkpoints"))
