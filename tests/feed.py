"""Feed parts of a table to a stream, one micro-batch or more for each."""

from tidemark.session import rocksdb, scratch_path
from tidemark.streaming.windows import run_available


def feed(parts, starts):
    """Each part is read to its end by all queries, in turn, before the next one arrives."""
    spark = parts[0].sparkSession
    root = scratch_path(spark, "feed")
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        for i, start in enumerate(starts if isinstance(starts, list) else [starts]):
            stream = spark.readStream.schema(part.schema).parquet(f"{root}/in")
            with rocksdb(spark):
                run_available(start(stream), f"{root}/checkpoint-{i}")
