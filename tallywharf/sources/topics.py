"""Topics of JSON lines.

A topic gives messages of (value STRING, arrived TIMESTAMP, source STRING, position BIGINT).  ``arrived`` is the time the
message reached the topic, which is the same on every replay.  ``source`` and ``position`` say where it stands: a
partition and an offset, which no other message has, or a file and the start of the stretch that is read at once, within
which lines keep their order.  Two carriers are supported: Kafka, where its Spark package is on the class path,
and a folder of text files, laid out as ``<root>/batch_id=<n>/topic=<name>/``.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clock


#: Between the mark and the line in files that carry marks.
_TAB = "\t"


def _messages(frame, value, arrived, source, position, *more):
    return frame.select(
        value.alias("value"), arrived.alias("arrived"), source.alias("source"), position.cast("bigint").alias("position"), *more
    )


def read_kafka(spark, topic, servers, starting="latest", **options):
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for name, value in options.items():
        stream = stream.option(name, value)
    source = F.concat_ws("-", "topic", "partition")
    return _messages(stream.load(), F.col("value").cast("string"), F.col("timestamp"), source, F.col("offset"))


def read_files(spark, path, max_files=None, marked=False):
    """Stream of text lines below ``path`` (globs allowed); arrival is the file's modification time.

    From files that ``write_topics`` has marked, messages also have their ``mark``.
    """
    stream = spark.readStream.format("text").schema("value string")
    if max_files is not None:
        stream = stream.option("maxFilesPerTrigger", max_files)
    value, mark = F.col("value"), []
    if marked:
        value, mark = F.substring_index("value", _TAB, -1), [F.substring_index("value", _TAB, 1).alias("mark")]
    place = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return _messages(stream.load(path), value, F.col("_metadata.file_modification_time"), *place, *mark)


def topic_path(root, topic):
    return f"{root}/batch_id=*/topic={topic}"


def write_topics(messages, root, batch_id, marked=False):
    """Writes (topic, value) rows of one batch as the files of that batch, replacing those of an earlier attempt.

    A reader that has already taken the first files sees the lines again.  With ``marked`` every line begins with a mark:
    the batch, a digest of the line, and its number among equal lines, which are the same in every attempt.  By the mark a
    job counts each message once.  JSON lines hold no tab, so the line follows after one.
    """
    rows = messages.select("topic", "value")
    if marked:
        digest = F.md5("value")
        number = F.row_number().over(Window.partitionBy("topic", digest).orderBy("value"))
        mark = F.concat_ws("-", F.lit(str(batch_id)), digest, number)
        rows = rows.select("topic", F.concat(mark, F.lit(_TAB), "value").alias("value"))
    rows.write.mode("overwrite").partitionBy("topic").text(f"{root}/batch_id={batch_id}")


def write_kafka(messages, servers):
    messages.select("topic", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_day_files(messages, root, batch_id, zone):
    """Appends raw lines to files rolled by arrival day."""
    day = clock.day_text(clock.local_time(F.unix_seconds("arrived"), zone))
    (
        messages.select(day.alias("day"), "value")
        .write.mode("overwrite").partitionBy("day").text(f"{root}/batch_id={batch_id}")
    )
