"""Writers. Default mode is ``errorifexists``; pass ``mode='overwrite'`` to
replace an existing output folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MODES = ("errorifexists", "overwrite", "append", "ignore")


def _mode(mode: str) -> str:
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}")
    return mode


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """One ``k<TAB>v...`` line per row (NULL prints as empty), all columns in order."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    w = df.select(line.alias("value")).write.mode(_mode(mode))
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_lines(df: DataFrame, col: str, path: str, mode: str = "errorifexists",
                compression: str | None = None, line_sep: str | None = None) -> None:
    """The record column only, one per line."""
    w = df.select(F.col(col).cast("string").alias("value")).write.mode(_mode(mode))
    if compression:
        w = w.option("compression", compression)
    if line_sep is not None:
        w = w.option("lineSep", line_sep)
    w.text(path)


def write_by_year(df: DataFrame, path: str, year: str = "year", record: str = "raw",
                  files_per_year: int | None = None, max_records_per_file: int = 0,
                  mode: str = "errorifexists") -> None:
    """Records in one folder per year (``year=YYYY/part-*``).

    Without ``files_per_year`` each task writes its rows straight to the year
    folders (no shuffle, no skew). With it, rows are hash-spread over
    ``files_per_year`` salts inside each year, so a year holding a third of all
    rows is still written by many tasks.
    """
    out = df.select(F.col(year).alias("year"), F.col(record).cast("string").alias("value"))
    if files_per_year:
        salt = F.pmod(F.xxhash64("value"), F.lit(files_per_year))
        out = out.repartition("year", salt)
    w = out.write.mode(_mode(mode)).partitionBy("year")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(path)


def write_placed(df: DataFrame, part: str, record: str, path: str, rows_per_file: int,
                 mode: str = "errorifexists") -> int:
    """Records in one folder per partition number (``part=N/part-*``), placed by
    number; returns the number of files.

    The rows of every partition number are counted first, and a number with n rows
    gets a range of ceil(n / rows_per_file) output tasks. Each row then goes straight
    to a task of its number's range (an exchange by partition id, no hashing), so a
    task writes one file, a small partition is one file, and a number that holds a
    third of all rows is written by as many tasks as its rows need. NULL numbers
    have a range of their own. One row per number comes to the driver: ``part`` is
    a partition number, of which a layout has few.
    """
    rows = df.select(F.col(part).cast("int").alias("part"), F.col(record).cast("string").alias("value"))
    starts, files = [], 0
    for r in sorted(rows.groupBy("part").count().collect(), key=lambda r: (r["part"] is not None, r["part"])):
        needed = -(-r["count"] // rows_per_file)
        starts.append((r["part"], files, needed))
        files += needed
    ranges = F.broadcast(df.sparkSession.createDataFrame(starts, "p int, first int, files int"))
    place = F.col("first") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("files")).cast("int")
    placed = rows.join(ranges, F.col("part").eqNullSafe(F.col("p"))).withColumn("place", place)
    (placed.repartitionById(max(files, 1), "place").select("part", "value")
     .write.mode(_mode(mode)).partitionBy("part").text(path))
    return files


def write_named_files(df: DataFrame, name: str, record: str, path: str, mode: str = "errorifexists") -> None:
    """Records in one folder per ``name`` value (``file=<name>/part-*``), for
    ``sources.text.read_named_lines``. The name is carried by the folder, which
    the writers' commit protocol makes: nothing is renamed afterwards. A NULL or
    empty name is read back as NULL."""
    rows = df.select(F.col(name).cast("string").alias("file"), F.col(record).cast("string").alias("value"))
    rows.write.mode(_mode(mode)).partitionBy("file").text(path)
