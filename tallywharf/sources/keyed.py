"""Tables with a key, kept as plain parquet.

``<table>/recent/batch_id=<n>/`` holds what one micro-batch wrote; running the batch again overwrites its own folder,
so a repeated batch changes nothing.  ``<table>/settled/`` holds bulk-loaded rows in one folder per day.  Readers see
both and keep one row per key.  Micro-batches get no day folders: one that spans many days would shatter into small
files.  Their rows are sorted by day instead, and a day filter skips by the statistics in the files.

A job folds its batches as it goes (``fold``): ``<table>/folded/<first>-<last>/`` holds the rows of a run of batches and
stands in their place once Spark has marked it complete.  Folders that have been replaced stay until the next fold, so
readers that began before have time to end, and their number grows with the logarithm of the number of batches.
Where a table format with MERGE is available, that replaces this convention.
"""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.newest import first_row, newest_version_rows

SETTLED = -1
#: Batches to a fold, and folds to the next larger one.
FAN = 16


def _identified(rows):
    """A null ``doc_id`` gets a generated one."""
    return rows.withColumn("doc_id", F.coalesce("doc_id", F.uuid())) if "doc_id" in rows.columns else rows


def write_batch(rows, table, batch_id, day=None, by=()):
    """``by`` names columns of few values that get a folder each within the batch's."""
    rows = _identified(rows)
    if day is not None:
        rows = rows.sortWithinPartitions(*by, day)
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{table}/recent/batch_id={batch_id}")


def write_settled(rows, table, day=None, lookup=()):
    """Stores a table's starting rows, by day if ``day`` names a column.

    Rows are gathered by day first, so a day gets few files instead of one per task; adaptive execution splits a day
    that is too large for one task.  The columns in ``lookup`` get Bloom filters, by which a search for a few of their
    values skips most row groups of a day.
    """
    rows = _identified(rows)
    if day is None:
        _writer(rows, lookup).parquet(f"{table}/settled")
    else:
        _writer(rows.hint("rebalance", day), lookup).partitionBy(day).parquet(f"{table}/settled")


def _writer(rows, lookup=()):
    writer = rows.write.mode("overwrite")
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        # A dictionary would hold the values as well, but only as long as it stays small.
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    return writer


def read_batches(spark, table, schema, before=None):
    """All stored rows with their ``batch_id``; only batches below ``before`` when given; none if nothing is stored.

    A batch must not see its own rows when it is run again, hence ``before``.
    """
    layout = schema if isinstance(schema, str) else ddl(schema)
    stored = _stored(spark, table, [f for f in folders(spark, table) if before is None or f[0] < before], f"{layout}, batch_id bigint")
    if before is not None:
        stored = stored.where(F.col("batch_id") < before)
    settled = _read(spark, f"{table}/settled", layout).withColumn("batch_id", F.lit(SETTLED).cast("bigint"))
    return stored.unionByName(settled)


def read_batch(spark, table, schema, batch_id):
    """The rows that one batch has written."""
    layout = schema if isinstance(schema, str) else ddl(schema)
    return spark.read.schema(layout).parquet(f"{table}/recent/batch_id={batch_id}")


def newest_folder(spark, table, schema, before):
    """The rows of the last stored batches below ``before``: one folder, whatever the table's size."""
    layout = schema if isinstance(schema, str) else ddl(schema)
    found = [f for f in folders(spark, table) if f[0] < before]
    return _stored(spark, table, found[-1:], f"{layout}, batch_id bigint").where(F.col("batch_id") < before)


def _stored(spark, table, found, layout):
    """The rows of folders, as ``folders`` names them."""
    single = [f"{table}/recent/batch_id={a}" for a, b, folded in found if not folded]
    folds = [f"{table}/folded/{a}-{b}" for a, b, folded in found if folded]
    reader = spark.read.schema(layout)
    frames = []
    if single:
        frames.append(reader.option("basePath", f"{table}/recent").parquet(*single))
    if folds:
        frames.append(spark.read.schema(layout).parquet(*folds))
    return reduce(DataFrame.unionByName, frames) if frames else _none(spark, layout)


def _none(spark, layout):
    """No rows; Spark leaves them out of its plan, while an empty list would start tasks and Python workers."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(layout)])


# Folding ---------------------------------------------------------------------------------------------------------


def _path(spark, path):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark, path):
    path, files = _path(spark, path)
    return [x.getPath().getName() for x in files.listStatus(path)] if files.exists(path) else []


def _exists(spark, path):
    path, files = _path(spark, path)
    return files.exists(path)


def move(spark, source, target):
    """Gives a folder another name; False if there is no such folder."""
    source, files = _path(spark, source)
    target, _ = _path(spark, target)
    if not files.exists(source):
        return False
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def _all_folders(spark, table):
    """(first, last, folded) of every folder of batches; of folds only the complete ones."""
    single = [int(x.split("=")[1]) for x in _names(spark, f"{table}/recent") if x.startswith("batch_id=")]
    runs = [tuple(map(int, x.split("-"))) for x in _names(spark, f"{table}/folded") if "-" in x]
    folds = [(a, b, True) for a, b in runs if _exists(spark, f"{table}/folded/{a}-{b}/_SUCCESS")]
    return [(n, n, False) for n in single] + folds


def _covered(folder, found):
    """Whether a fold holds what the folder holds."""
    return any(a <= folder[0] and folder[1] <= b and (a, b, folded) != folder for a, b, folded in found if folded)


def folders(spark, table):
    """The folders that together hold every batch once, in order: (first batch, last batch, whether it is a fold)."""
    found = _all_folders(spark, table)
    return sorted(f for f in found if not _covered(f, found))


def fold(spark, table, batch_id, keys=(), version=(), day=None, fan=FAN, lookup=(), *, keep=None, by=(), layout=None):
    """Folds the batches before ``batch_id`` when a run of them is complete; to be called as a batch begins.

    After ``fan`` batches these become one folder, after ``fan`` such folders those do, and so on.  With ``keys`` only
    the latest version of each key stays, as in ``current``; with ``keep``, a condition, only what meets it.  ``by`` is
    as in ``write_batch``, and then ``layout`` must be given, as batches without rows have no file to tell it.  All
    batches before have been committed, so a batch that runs again finds its fold done, or writes it again from the same
    rows.
    """
    if batch_id <= 0 or batch_id % fan:
        return
    span = fan
    while batch_id % (span * fan) == 0:
        span *= fan
    first, last = batch_id - span, batch_id - 1
    known = _all_folders(spark, table)
    if (first, last, True) in known:
        return
    parts = sorted(f for f in known if first <= f[0] and f[1] <= last and not _covered(f, known))
    if not parts:
        return
    single = [f"{table}/recent/batch_id={a}" for a, _, folded in parts if not folded]
    folds = [f"{table}/folded/{a}-{b}" for a, b, folded in parts if folded]
    reader = spark.read if layout is None else spark.read.schema(f"{layout}, batch_id bigint")
    frames = [reader.parquet(*folds)] if folds else []
    if single:
        recent = reader.option("basePath", f"{table}/recent").parquet(*single)
        frames.append(recent.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)
    if keep is not None:
        rows = rows.where(keep)
    if keys:
        rows = first_row(rows, list(keys), [F.desc(c) for c in [*version, "batch_id"]])
    rows = rows.hint("rebalance") if day is None else rows.hint("rebalance", day).sortWithinPartitions(*by, day)
    _writer(rows, lookup).partitionBy(*by).parquet(f"{table}/folded/{first}-{last}")
    for a, b, folded in known:
        if _covered((a, b, folded), known):
            path, files = _path(spark, f"{table}/folded/{a}-{b}" if folded else f"{table}/recent/batch_id={a}")
            files.delete(path, True)


def _read(spark, path, layout):
    try:
        return spark.read.schema(layout).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return _none(spark, layout)


def ddl(schema):
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def current(rows, keys, version=()):
    """One row per key: the latest version, the later batch among equal versions.

    A batch stores one row per key, so that order is complete and columns nobody asks for need not be read.
    """
    return first_row(rows, list(keys), [F.desc(c) for c in [*version, "batch_id"]]).drop("batch_id")


def current_documents(rows, keys, version, entry):
    """All rows of the newest version of each document; ``entry`` names what tells its rows apart."""
    newest = newest_version_rows(rows, list(keys), version)
    return first_row(newest, [*keys, *entry], [F.desc("batch_id")]).drop("batch_id")
