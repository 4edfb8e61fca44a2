"""Small helpers for tests."""

from __future__ import annotations


def rows(df, *order):
    """Rows as tuples, sorted by `order` or as a whole."""
    out = df.orderBy(*order).collect() if order else df.collect()
    tuples = [tuple(r) for r in out]
    return tuples if order else sorted(tuples, key=repr)


def feed(spark, data, ddl, folder, files):
    """Write rows as `files` Parquet files that a file stream takes one by one, in order."""
    import os

    cuts = [len(data) * i // files for i in range(files + 1)]
    for i in range(files):
        part = f"{folder}/.part{i}"
        spark.createDataFrame(data[cuts[i] : cuts[i + 1]], ddl).coalesce(1).write.parquet(part)
        name = next(n for n in os.listdir(part) if n.endswith(".parquet"))
        target = f"{folder}/{i:03d}.parquet"
        os.link(f"{part}/{name}", target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")
