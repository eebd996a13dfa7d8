"""Parquet and CSV tables, in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, columns: Sequence[str] | None = None, glob: str | None = None) -> DataFrame:
    """A Parquet table; only `columns` are read, and only files that `glob` matches."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def write(df: DataFrame, path: str, *, by: Sequence[str] = (), order: Sequence[str] = (), max_rows: int = 20_000_000) -> None:
    """zstd Parquet, in folders of `by`; rows of one first key lie together and in `order`, so readers can skip row groups. All or nothing."""
    if order:
        df = df.repartition(*[F.col(c) for c in dict.fromkeys([*by, order[0]])]).sortWithinPartitions(*by, *order)
    writer = df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", max_rows)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Rows added to a Parquet table whose first write fixed its schema: ValueError for another. An empty addition adds nothing."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        have, new = ([(f.name, f.dataType) for f in x.schema] for x in (spark.read.parquet(path), df))
        if have != new:
            raise ValueError(f"another schema than the first write's: {new} instead of {have}")
    df.write.mode("append").option("compression", "zstd").parquet(path)


def write_once(df: DataFrame, path: str) -> None:
    """A whole table or none: written beside its place and moved there when it is complete. FileExistsError if something is there."""
    spark = df.sparkSession
    conf, new = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, draft = new(path), new(f"{path.rstrip('/')}.draft")
    system = target.getFileSystem(conf)
    if system.exists(target):
        raise FileExistsError(path)
    df.write.mode("overwrite").option("compression", "zstd").parquet(str(draft))
    if not system.rename(draft, target):
        raise OSError(f"can't move to {path}")


def stream_to(df: DataFrame, path: str, mark: str, *, partitions: int | None = None):
    """Rows of a stream into a Parquet table, batch by batch and each once; `mark` is where the stream keeps its place."""
    rows = df.coalesce(partitions) if partitions else df
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", mark).trigger(availableNow=True).start()


def tail(spark: SparkSession, path: str, n: int = 50) -> list[str]:
    """The last n lines of a text file, read from its end."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size, step = system.getFileStatus(where).getLen(), 1 << 16
    file, raw = system.open(where), b""
    try:
        while size and raw.count(b"\n") <= n:
            take = min(step, size)
            size -= take
            file.seek(size)
            raw = bytes(file.readNBytes(take)) + raw
    finally:
        file.close()
    return [x.decode("utf-8", "replace") for x in raw.splitlines()[-n:]] if n else []


def write_reports(reports: DataFrame, path: str, by: str = "update_day") -> None:
    """One folder of JSON a day, replaced if it is there."""
    reports.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).json(path)


def write_series(df: DataFrame, path: str) -> None:
    """A short series as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def plot_series(df: DataFrame, path: str, *, x: str = "eval_day", y: str = "rank_ic", title: str = "Rank IC", rolling: int | None = None) -> str:
    """An SVG chart of a short series, with a line at 0; `rolling` rows make a mean, which then is what is drawn. Returns the path."""
    if rolling:
        from tidemill.operators.dataset import rolling_mean

        df, y, title = rolling_mean(df, rolling, value=y, order=x, name="__mean"), "__mean", f"{title}, mean of {rolling}"
    rows = [(str(r[x]), r[y]) for r in df.select(x, y).orderBy(x).collect()]
    known = [v for _, v in rows if v is not None and v == v]
    low, high = min([0.0, *known]), max([0.0, *known])
    width, height, edge = 1000, 400, 40
    across = lambda k: edge + (width - 2 * edge) * k / max(1, len(rows) - 1)
    up = lambda v: height - edge - (height - 2 * edge) * (v - low) / ((high - low) or 1.0)
    points = " ".join(f"{across(k):.1f},{up(v):.1f}" for k, (_, v) in enumerate(rows) if v is not None and v == v)
    names = "".join(f'<text x="{across(k):.0f}" y="{height - 12}" font-size="11" text-anchor="middle">{rows[k][0]}</text>' for k in sorted({0, len(rows) // 2, len(rows) - 1}) if rows)
    scale = "".join(f'<text x="4" y="{up(v):.0f}" font-size="11">{v:.3f}</text>' for v in sorted({low, 0.0, high}))
    with open(path, "w", encoding="utf-8") as f:
        f.write(f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><text x="{width // 2}" y="20" text-anchor="middle">{title}</text>{names}{scale}')
        f.write(f'<line x1="{edge}" x2="{width - edge}" y1="{up(0.0):.1f}" y2="{up(0.0):.1f}" stroke="gray" stroke-dasharray="4"/><polyline points="{points}" fill="none" stroke="black"/></svg>')
    return path
