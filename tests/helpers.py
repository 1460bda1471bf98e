import json
import os
import time


def messages(spark, *objects, arrived="2021-05-28 13:30:00"):
    """A static frame of topic messages; a string is taken as it is."""
    rows = [(o if isinstance(o, str) or o is None else json.dumps(o), arrived) for o in objects]
    return spark.createDataFrame(rows, "value string, at string").selectExpr(
        "value", "to_timestamp(at || '+00:00', 'yyyy-MM-dd HH:mm:ssXXX') AS arrived"
    )


def rows(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)


class Landing:
    """A folder that receives one parquet file per call, each newer than the one before."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, path, 0
        os.makedirs(path)
        self.clock = time.time() - 10_000

    def add(self, frame):
        part = f"{self.path}/.staging-{self.files}"
        frame.coalesce(1).write.parquet(part)
        file = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = f"{self.path}/{self.files:03d}.parquet"
        os.link(f"{part}/{file}", target)
        self.files += 1
        os.utime(target, (self.clock + self.files, self.clock + self.files))

    def stream(self, schema, per_batch=1):
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(self.path)


def finish(query):
    query.awaitTermination(120)
    assert not query.isActive
