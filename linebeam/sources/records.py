"""Record sources: attribute rows, number lists, points."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam.functions.xmlrow import attr_map, is_row_line
from linebeam.sources.text import read_lines


def read_xml_rows(spark: SparkSession, paths, keep_raw: bool = True) -> DataFrame:
    """(attrs map<string,string>[, raw string]) for each ``<row .../>`` line.

    Read line by line (splittable, no root element needed); header, root and
    blank lines give nothing. Entities stay escaped.
    """
    lines = read_lines(spark, paths).where(is_row_line(F.col("value")))
    cols = [attr_map(F.col("value")).alias("attrs")]
    if keep_raw:
        cols.append(F.col("value").alias("raw"))
    return lines.select(*cols)


def parse_points(lines: DataFrame, text: str = "value") -> DataFrame:
    """(x double, y double) from ``x,y`` lines (blanks around numbers allowed)."""
    parts = F.split(F.col(text), ",")
    return lines.select(F.trim(parts[0]).cast("double").alias("x"), F.trim(parts[1]).cast("double").alias("y"))


# No quoting in point lines, so a quote sign is data.
_POINT_LINES = {"header": "false", "quote": "", "escape": "", "sep": ",", "mode": "PERMISSIVE"}


def _first_line(spark: SparkSession, path) -> tuple[str, str, str] | None:
    """(file, its path in the rows' metadata, line) of the first record: the first line that isn't blank of the first
    file by name that has one. Files are opened in order until then, each from its
    start, and a file's later splits only if its first ones are blank."""
    files = sorted(spark.read.text(path).inputFiles(), key=lambda f: (f.rsplit("/", 1)[-1], f))
    for file in files:
        file = unquote(file)
        lines = (spark.read.text(file).select("value", F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_path").alias("file"))
                 .where(F.trim("value") != ""))
        head = lines.where("start = 0").first() or lines.orderBy("start").first()
        if head is not None:
            return file, head["file"], head["value"]
    return None


def read_points(spark: SparkSession, path, header_path: str | None = None) -> tuple[DataFrame, float, float]:
    """Points plus their header ``R,N``. Returns ``(points, r, n)``.

    The header is the first record of the data (the first line that isn't blank of
    the first file by name) or, with ``header_path``, the first line of a file of
    its own. Only that line reaches the driver. It is left out of the points by its
    place: the reader of the first file skips the record that starts it, and the
    other files, told apart by their metadata, are read as they are. So the points
    are scanned once, and a point that looks like the header stays. Blank lines
    are no points.
    """
    if header_path is not None:
        found = _first_line(spark, header_path)
        points = parse_points(read_lines(spark, path).where(F.trim("value") != ""))
    else:
        found = _first_line(spark, path)
        if found is not None:
            fields = spark.read.schema("x string, y string").options(**_POINT_LINES)
            first = fields.option("header", "true").csv(found[0])
            rest = fields.option("header", "false").csv(path).where(F.col("_metadata.file_path") != found[1])
            points = first.union(rest.select("x", "y")).select(*[F.trim(c).cast("double").alias(c) for c in ("x", "y")])
    if found is None:
        raise ValueError("no header line")
    r_txt, n_txt = [t.strip() for t in found[2].split(",")[:2]]
    return points, float(r_txt), float(n_txt)
