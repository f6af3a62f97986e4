"""Service log lines: parse, drop health checks, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

# The line layout "time level logger: message" with comma milliseconds.
LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),(\d{3}) ([A-Z]+) ([^ :]+): (.*)$"

# The path ends there: `/health-records` is an ordinary request.
HEALTH_CHECK = r"(?i)\bGET /(health|healthz|ready)(?=[\s?/]|$)"

_JSON_LINE = "time string, level string, logger string, message string"


def parse_lines(lines: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """``service`` and ``line`` to time, level, logger and message. A line is JSON, the plain
    layout, or neither (a stack trace's continuation): the last is kept as ``unparsed``. Columns
    ``also`` are kept."""
    record = F.from_json("line", _JSON_LINE)
    is_json = F.startswith(F.col("line"), F.lit("{")) & record["time"].isNotNull()
    is_plain = F.col("line").rlike(LINE)

    def part(n: int):
        return F.regexp_extract("line", LINE, n)

    moment = F.when(is_json, record["time"]).when(is_plain, F.concat(part(1), F.lit("."), part(2)))
    return lines.select(
        "service",
        moment.try_cast("timestamp").alias("log_time"),
        F.when(is_json, record["level"]).when(is_plain, part(3)).alias("level"),
        F.when(is_json, record["logger"]).when(is_plain, part(4)).alias("logger"),
        F.when(is_json, record["message"])
        .when(is_plain, part(5))
        .otherwise(F.col("line"))
        .alias("message"),
        F.when(is_json, "json").when(is_plain, "plain").otherwise("unparsed").alias("layout"),
        *also,
    )


def entries(lines: DataFrame) -> DataFrame:
    """Lines with their places (``tables.read_log_lines``) to entries: a line with a header, and the lines after it that
    have none, such as a stack trace, as its ``trace`` (NULL without any). Beside the columns of ``parse_lines`` an entry
    has ``file`` and ``line_count``.

    Lines before the first header of a file belong to no entry; each is one by itself, `unparsed`.

    A task sees one block of a file, and an entry may begin in an earlier one. Headers are therefore counted per block;
    what the blocks before have in sum is added to a running count inside the block. The first is one row per block,
    the second a window over one block, so a file of any length is read by many tasks.
    """
    spot = ["file", "block"]
    # a window needs the places as they were read, so lines are parsed before they move
    parsed = parse_lines(lines, also=("file", "block", "place", "line")).withColumn("is_header", F.col("layout") != "unparsed")
    headers = parsed.groupBy(*spot).agg(F.count_if("is_header").alias("headers"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = headers.select(*spot, F.coalesce(F.sum("headers").over(earlier), F.lit(0)).alias("before"))
    so_far = W.partitionBy(*spot).orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = parsed.withColumn("inside", F.count_if("is_header").over(so_far)).join(before, spot)
    numbered = counted.withColumn("entry", F.col("before") + F.col("inside"))
    # lines without an entry stay apart by their place, below all numbers of entries
    entry = F.when(F.col("entry") == 0, -1 - F.col("place")).otherwise(F.col("entry"))
    head = F.struct("log_time", "level", "logger", "message", "layout")
    more = F.array_sort(F.collect_list(F.when(~F.col("is_header"), F.struct("block", "place", "line"))))
    return (
        numbered.withColumn("entry", entry)
        .groupBy("service", "file", "entry")
        .agg(
            F.max_by(head, "is_header").alias("head"), F.count_if("is_header").alias("headers"), more.alias("more"),
            F.count("*").alias("line_count"),
        )
        .select(
            "service", "file", "head.*",
            F.when((F.col("headers") > 0) & (F.size("more") > 0), F.array_join(F.transform("more", lambda m: m["line"]), "\n"))
            .alias("trace"),
            "line_count",
        )
    )


def without_health_checks(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.coalesce(F.col("message").rlike(HEALTH_CHECK), F.lit(False)))


def levels_per_day(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy(
        F.to_date("log_time").alias("log_date"), "service", "level"
    ).agg(F.count("*").alias("line_count"))
