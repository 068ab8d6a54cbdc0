"""Reports on storage blocks, charts, time zones and trend files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.time import boundary_diff

# Storage locations checked: local paths of the first types (fixed values).
REMOTE_PREFIX = "rr:"
STORAGE_TYPES_BELOW = 5
HOURLY, DAILY = 1, 2
BLOCK_DIGITS = 3


def block_audit(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """History blocks with a missing status file, a block overlapping such a
    one, or a number beyond those expected for the day.

    Block names end in ``_nnn``; of others only the status file is checked. One
    row per problem.
    """
    expected = (
        F.when(F.col("time_unit_id") == HOURLY, F.floor(F.try_divide(F.lit(24), F.col("block_duration"))))
        .when(F.col("time_unit_id") == DAILY, F.lit(1))
    )
    checked = (
        locations.filter(
            ~F.col("path").startswith(REMOTE_PREFIX)
            & (F.col("storage_type") < STORAGE_TYPES_BELOW)
        )
        .select("path", expected.cast("int").alias("max_count"))
    )
    def part(n: int):
        return F.split_part("block_name", F.lit("_"), F.lit(n))

    named = blocks.join(checked, "path").select(
        "path",
        "block_name",
        part(1).alias("prefix"),
        part(2).try_cast("int").alias("number"),
        "has_status",
        "max_count",
    )
    missing = named.filter(~F.col("has_status"))
    following_number = (F.col("number") + 1).cast("string")
    width = F.greatest(F.length(following_number), F.lit(BLOCK_DIGITS))  # padding never cuts
    following = F.concat("prefix", F.lit("_"), F.lpad(following_number, width, F.lit("0")))
    overlapped = missing.select("path", following.alias("block_name")).join(
        blocks.select("path", "block_name").distinct(), ["path", "block_name"], "left_semi"
    )
    exceeding = named.filter(F.col("number") > F.col("max_count"))

    def problem(df: DataFrame, text: str) -> DataFrame:
        return df.select("path", "block_name", F.lit(text).alias("problem"))

    return (
        problem(missing, "missing status")
        .unionByName(problem(overlapped, "possible overlap"))
        .unionByName(problem(exceeding, "exceeds expected count"))
    )


# Sections of a chart document, in order.
SECTIONS = ("chart", "keyword", "tag", "property", "dashboard")


def _flag(name: str):
    return F.when(F.col(name) == 1, "True").otherwise("False").alias(name)


def chart_parts(
    charts: DataFrame,
    keywords: DataFrame,
    tags: DataFrame,
    properties: DataFrame,
    dashboards: DataFrame,
    users: DataFrame,
) -> DataFrame:
    """Each chart as rows: the chart itself with its owner, then its keywords,
    tags, properties and dashboard members, one JSON ``content`` per row.

    Nothing is gathered, so a chart may have any number of parts. To write
    them in order, sort by chart_type, chart_key, section_no, item.
    """
    kinds = charts.select("chart_key", "chart_type")
    owned = charts.drop("chart_type").join(users, charts["owner_key"] == users["user_key"], "left")
    urls = charts.select(F.col("chart_key").alias("member_key"), "url")

    def section(df: DataFrame, name: str, item: str, *columns) -> DataFrame:
        # The given columns are shuffled; the text is made from them after the join.
        return df.join(kinds, "chart_key").select(
            "chart_type",
            "chart_key",
            F.lit(SECTIONS.index(name)).alias("section_no"),
            F.lit(name).alias("section"),
            F.col(item).cast("string").alias("item"),
            F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("content"),
        )

    return (
        section(owned, "chart", "name", "name", "url", F.col("user_name").alias("owner"))
        .unionByName(section(keywords, "keyword", "keyword", "keyword"))
        .unionByName(
            section(
                tags, "tag", "fqn",
                "fqn", _flag("selected"), "color", _flag("active_group"),
                "layout_index", "selected_order",
            )
        )
        .unionByName(section(properties, "property", "property", "property", "value"))
        .unionByName(
            section(dashboards.join(urls, "member_key"), "dashboard", "url", "url", "position")
        )
    )


def tz_report(df: DataFrame, tz: str, standard_offset_min: int, ts: str = "ts") -> DataFrame:
    """Local and UTC time and offset of UTC instants in a zone.

    ``is_standard`` compares the offset with the zone's standard one;
    ``consistent`` is true for all rows when every one does.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts))
    rows = df.select(
        F.lit(tz).alias("tz"),
        F.col(ts).alias("utc_ts"),
        local.alias("local_ts"),
    ).withColumn("offset_min", boundary_diff("minute", F.col("utc_ts"), F.col("local_ts")))
    checked = rows.withColumn("is_standard", F.col("offset_min") == standard_offset_min)
    verdict = checked.agg(F.bool_and("is_standard")).scalar()
    return checked.withColumn("consistent", verdict)


def read_trends(spark: SparkSession, path: str) -> DataFrame:
    """Items of trend files (XML) as file, server, tag."""
    items = (
        spark.read.format("xml")
        .option("rowTag", "trendItem")
        .schema("SERVER_NAME string, TAG_NAME string")
        .load(path)
    )
    return items.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("SERVER_NAME").alias("server"),
        F.col("TAG_NAME").alias("tag"),
    )


def rename_server(items: DataFrame, old: str, new: str) -> DataFrame:
    """Trend items with one server renamed; ``changed`` marks the items touched
    and ``dirty`` all items of a file with any such. Case is ignored; items
    without a file are dirty by themselves."""
    hit = F.coalesce(F.lower("server") == old.lower(), F.lit(False))
    dirty = items.filter(hit).select("file").distinct().withColumn("dirty", F.lit(True))
    return items.join(dirty, "file", "left").select(
        "file",
        F.when(hit, new).otherwise(F.col("server")).alias("server"),
        "tag",
        hit.alias("changed"),
        F.coalesce("dirty", hit).alias("dirty"),
    )
