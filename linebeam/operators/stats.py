"""Number-list statistics and the point-in-circle estimator.

All global results are single ``agg`` calls: every task computes a partial
(sum, count, min, max, count_if) and only those partials cross the shuffle,
instead of routing every value to one reducer under a constant key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from linebeam.functions.numbers import array_sum, drop_trailing, int_list, int_list_valid

_ON_BAD = ("fail", "skip")

# The min/max report line and the two point labels.
REPORT_FORMAT = "Minimum: %s\tMaximum: %s\tmalformed: %s"
INSIDE = "Inside"
OUTSIDE = "Outside"


def space_numbers(lines: DataFrame, text: str = "value", on_bad: str = "fail",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """(nums array<int>) per line of blank-separated integers.

    Trailing blanks are ignored; a bad token, a double blank or an empty line
    fails the job (``on_bad='fail'``) or drops the line (``on_bad='skip'``).
    ``keep`` names columns passed through unchanged.
    """
    if on_bad not in _ON_BAD:
        raise ValueError(f"on_bad must be one of {_ON_BAD}")
    # a plain filter: for short lines re-evaluating the cheap validation costs
    # less than computing the row once through ``keep_where`` (measured)
    line = F.regexp_replace(F.col(text), " +$", "")
    parsed = lines.select(*keep, line.alias("line"), int_list_valid(line, " ").alias("ok"))
    if on_bad == "skip":
        parsed = parsed.where("ok")
    else:
        parsed = parsed.where(F.when(F.col("ok"), F.lit(True))
                              .otherwise(F.raise_error(F.concat(F.lit("bad number line: "), F.col("line")))))
    return parsed.select(*keep, int_list(F.col("line"), " ").alias("nums"))


def hash_numbers(lines: DataFrame, text: str = "value", trailing_sep: str = "malformed",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(nums array<int>, bad boolean) per line of '#'-separated integers.

    A line is bad when any token is not an int32 (blank line, empty token
    between two separators, overflow). ``trailing_sep='malformed'`` also marks
    ``8#`` bad (numbers only between separators); ``'ignore'`` accepts it.
    """
    if trailing_sep not in ("malformed", "ignore"):
        raise ValueError("trailing_sep must be 'malformed' or 'ignore'")
    line = F.col(text)
    if trailing_sep == "ignore":
        line = drop_trailing(line, "#")
    bad = ~int_list_valid(line, "#")
    return lines.select(*keep, F.when(~bad, int_list(line, "#")).alias("nums"), bad.alias("bad"))


def line_mean_col(nums: str = "nums"):
    """Mean of one line's numbers (double)."""
    return array_sum(F.col(nums)) / F.size(nums)


def line_means(nums: DataFrame) -> DataFrame:
    """(mean double) per line: the mean of the line's numbers."""
    return nums.select(line_mean_col().alias("mean"))


def mean_of_line_means(nums: DataFrame) -> DataFrame:
    """(mean double): unweighted mean of the per-line means."""
    return line_means(nums).agg(F.avg("mean").alias("mean"))


def global_mean(nums: DataFrame) -> DataFrame:
    """(mean double): mean of all numbers of all lines (weighted by length)."""
    agg = nums.agg(F.sum(array_sum(F.col("nums"))).alias("s"), F.sum(F.size("nums")).alias("c"))
    return agg.select((F.col("s") / F.col("c")).alias("mean"))


def min_max(parsed: DataFrame) -> DataFrame:
    """(min int, max int, malformed bigint) over ``hash_numbers`` output.

    Bad lines are skipped for min/max and counted; with no good line min and
    max are NULL.
    """
    good = ~F.col("bad")
    return parsed.agg(
        F.min(F.when(good, F.array_min("nums"))).alias("min"),
        F.max(F.when(good, F.array_max("nums"))).alias("max"),
        F.count_if(F.col("bad")).cast("bigint").alias("malformed"),
    )


def malformed_lines(lines: DataFrame, text: str = "value", trailing_sep: str = "malformed") -> DataFrame:
    """(line string): the lines ``hash_numbers`` marks bad, as they are."""
    line = F.col(text)
    if trailing_sep == "ignore":
        line = drop_trailing(line, "#")
    return lines.where(~int_list_valid(line, "#")).select(F.col(text).alias("line"))


def malformed_count(parsed: DataFrame) -> DataFrame:
    """(malformed bigint) over ``hash_numbers`` output."""
    return parsed.agg(F.count_if(F.col("bad")).cast("bigint").alias("malformed"))


def observe_malformed(parsed: DataFrame, name: str = "malformed") -> tuple[DataFrame, Observation]:
    """Attach a job-level counter of bad lines; read ``obs.get`` after an action."""
    obs = Observation(name)
    return parsed.observe(obs, F.count_if(F.col("bad")).alias("malformed")), obs


@dataclass
class JobCounter:
    """A counter that comes with a job's result.

    The count is an aggregate of the job itself and is observed on the row that
    ends it, not where the lines are read. Counters updated by map tasks count a
    stage twice when a lost executor makes it run again, or when its exchange is
    computed for two consumers; here those tasks' rows pass through the shuffle,
    which keeps one result a task, and the observed row exists once."""
    observation: Observation

    def run(self, result: DataFrame) -> tuple[list[Row], dict]:
        """The result's rows and the counters, from one execution."""
        rows = result.collect()   # the aggregate's one row
        return rows, self.observation.get


def min_max_counted(parsed: DataFrame, name: str = "malformed") -> tuple[DataFrame, JobCounter]:
    """((min int, max int), counter ``malformed``): ``min_max`` with the number of bad
    lines as the job's counter instead of a column."""
    observation = Observation(name)
    seen = min_max(parsed).observe(observation, F.max("malformed").alias("malformed"))
    return seen.select("min", "max"), JobCounter(observation)


def minmax_report(stats: DataFrame) -> DataFrame:
    """(report string): ``Minimum: a<TAB>Maximum: b<TAB>malformed: c``."""
    return stats.select(F.format_string(REPORT_FORMAT,
                                        F.coalesce(F.col("min").cast("string"), F.lit("null")),
                                        F.coalesce(F.col("max").cast("string"), F.lit("null")),
                                        F.col("malformed")).alias("report"))


def inside_circle(x: str, y: str, r: float):
    """Strict point-in-circle test; NaN or NULL coordinates are outside."""
    return F.coalesce(F.col(x) * F.col(x) + F.col(y) * F.col(y) < F.lit(r) * F.lit(r), F.lit(False))


def circle_label_count(points: DataFrame, r: float, x: str = "x", y: str = "y") -> DataFrame:
    """(label string, n bigint) with labels ``Inside`` and ``Outside``."""
    label = F.when(inside_circle(x, y, r), F.lit(INSIDE)).otherwise(F.lit(OUTSIDE))
    return points.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def circle_area_ratio(points: DataFrame, r: float, x: str = "x", y: str = "y") -> DataFrame:
    """(ratio double): 4 * inside / all, the pi estimate; NULL on no points."""
    agg = points.agg(F.count_if(inside_circle(x, y, r)).alias("inside"), F.count(F.lit(1)).alias("n"))
    return agg.select((F.lit(4.0) * F.col("inside") / F.nullif(F.col("n"), F.lit(0))).alias("ratio"))
