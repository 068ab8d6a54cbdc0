"""Namespace, tag-version, translation and clean-up reporting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.time import boundary_diff, midnight, shift, trunc, ts_lit
from tagloom.operators.summary import analog_summary
from tagloom.plans.blocks import BLOCK_MS
from tagloom.sources.history import for_tags

# Type of the built-in groups that hold everything (fixed value).
BUILT_IN_GROUP_TYPE = 1_000_000
# Separator of a namespace path (fixed value).
PATH_SEPARATOR = "\\"
# Prefix of a description still to be translated (fixed value).
PLACEHOLDER = "ToDo: "


def namespace_paths(
    ns: DataFrame, root: int = 1, skip_types: Iterable[int] = (BUILT_IN_GROUP_TYPE,)
) -> DataFrame:
    """Every group below ``root`` with its full path; groups of a skipped type
    and all below them are left out. The root itself is always kept."""
    nodes = ns.filter(~F.col("type").isin(list(skip_types)))
    return ns.sparkSession.sql(
        """
        WITH RECURSIVE tree (name_key, path, type) AS (
          SELECT name_key, concat(:separator, name), type FROM {ns} WHERE name_key = :root
          UNION ALL
          SELECT child.name_key, concat(parent.path, :separator, child.name), child.type
          FROM tree parent JOIN {nodes} child ON child.parent_key = parent.name_key
        )
        SELECT name_key, path, type FROM tree
        """,
        args={"root": root, "separator": PATH_SEPARATOR},
        ns=ns,
        nodes=nodes,
    )


def tags_under(
    ns: DataFrame,
    group_tag: DataFrame,
    tag_ref: DataFrame,
    tag: DataFrame,
    prefix: str,
    root: int = 1,
) -> DataFrame:
    """Tags in the groups whose path starts with ``prefix``, with that path."""
    groups = namespace_paths(ns, root).filter(F.col("path").startswith(prefix))
    return (
        group_tag.join(groups, "name_key")
        .join(tag_ref, "domain_tag_key")
        .join(tag.select("tag"), "tag")
        .select("tag", F.col("path").alias("group_name"))
    )


def group_summary(
    df: DataFrame,
    tags: DataFrame,
    now,
    days: int = 1,
    resolution_ms: int = 3_600_000,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Hourly summary of the ``days`` before the last midnight for each group
    and tag in ``tags`` (tag, group_name).

    A tag in several groups is summarised once.
    """
    summary = analog_summary(
        for_tags(df, tags),
        midnight(now, -days),
        midnight(now),
        resolution_ms=resolution_ms,
        block_ms=block_ms,
    )
    return summary.join(tags, "tag").select(
        "start_ts",
        "group_name",
        "tag",
        "average",
        "integral",
        "minimum",
        "maximum",
        "value_count",
        "percent_good",
    )


def version_churn(th: DataFrame) -> DataFrame:
    """Tags with several versions and the properties likely to cause them."""
    # Equal versions are combined first: the distinct counts handle each row several times.
    kinds = th.groupBy("tag", "description", "unit", "min_eu", "max_eu").agg(
        F.count("*").alias("n"),
        F.min("date_created").alias("first_ts"),
        F.max("date_created").alias("last_ts"),
    )
    per_tag = kinds.groupBy("tag").agg(
        F.sum("n").alias("versions"),
        F.countDistinct("description").alias("descriptions"),
        F.countDistinct("unit").alias("units"),
        F.countDistinct("min_eu").alias("min_eu_changes"),
        F.countDistinct("max_eu").alias("max_eu_changes"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )
    life = boundary_diff("second", F.col("first_ts"), F.col("last_ts"))
    return (
        per_tag.filter("versions > 1")
        .withColumn("avg_life_s", life.cast("double") / F.col("versions"))
        .orderBy(F.desc("versions"), F.desc("descriptions"), "tag")
    )


def version_rate(
    th: DataFrame,
    unit: str = "month",
    min_count: int = 5,
    pattern: str = "%",
    start="2000-01-01",
    end=None,
) -> DataFrame:
    """Versions per tag and month (or other unit), where more than ``min_count``."""
    rows = th.filter(F.col("tag").like(pattern))
    rows = rows.filter(F.col("date_created") >= ts_lit(start))
    if end is not None:
        rows = rows.filter(F.col("date_created") <= ts_lit(end))
    return (
        rows.groupBy(trunc(unit, F.col("date_created")).alias("beginning"), "tag")
        .agg(F.count("*").alias("versions"))
        .filter(F.col("versions") > min_count)
        .orderBy(F.desc("versions"), "beginning", "tag")
    )


def localized_tags(tag: DataFrame, descriptions: DataFrame, lang: int) -> DataFrame:
    """Tags with their description in a language, or the default one."""
    local = descriptions.filter(F.col("lang_id") == lang).select("tag", "local_desc")
    return (
        tag.join(local, "tag", "left")
        .withColumn("description", F.coalesce("local_desc", "description"))
        .select(*tag.columns)
    )


def add_translations(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing translations and those new ones whose tag and language lack one."""
    return existing.unionByName(new.join(existing, ["tag", "lang_id"], "left_anti"))


def missing_translations(
    tag: DataFrame, descriptions: DataFrame, lang: int, pattern: str = "%"
) -> DataFrame:
    """Placeholder translations of tags that have none in a language."""
    have = descriptions.filter(F.col("lang_id") == lang)
    return (
        tag.filter(F.col("tag").like(pattern))
        .join(have, "tag", "left_anti")
        .select(
            "tag",
            F.concat(F.lit(PLACEHOLDER), "description").alias("local_desc"),
            F.lit(lang).alias("lang_id"),
        )
    )


def stale_tags(
    tag: DataFrame,
    live: DataFrame,
    now,
    days_old: int = 90,
    live_days_old: int | None = None,
) -> DataFrame:
    """Tags created more than ``days_old`` days ago whose last value is NULL and
    more than ``live_days_old`` days old; tags of I/O server 1 are spared."""
    live_days_old = days_old if live_days_old is None else live_days_old
    silent = live.filter(
        F.col("value").isNull() & (F.col("ts") < shift(ts_lit(now), days=-live_days_old))
    ).select("tag")
    return (
        tag.filter(F.col("date_created") < shift(ts_lit(now), days=-days_old))
        .filter(F.col("io_server_key") != 1)
        .join(silent, "tag", "left_semi")
        .select("tag")
    )


def drop_tags(tag: DataFrame, doomed: DataFrame) -> DataFrame:
    """The tag table without some tags."""
    return tag.join(doomed.select("tag"), "tag", "left_anti")


def orphan_attributes(attributes: DataFrame, tag: DataFrame) -> DataFrame:
    """Attributes whose name is no tag."""
    return attributes.join(
        tag, attributes["attribute_name"] == tag["tag"], "left_anti"
    )


def orphan_namespace(ns: DataFrame, objects: DataFrame, pending: DataFrame) -> DataFrame:
    """Namespace rows named after an object that is not pending."""
    settled = objects.join(pending, "object_name", "left_anti")
    return ns.join(settled, ns["name"] == settled["object_name"], "left_semi")


def orphan_objects(objects: DataFrame, attributes: DataFrame) -> DataFrame:
    """Objects with no attributes that are no other object's parent."""
    parents = objects.select(F.col("parent_key").alias("object_key"))
    return objects.join(attributes, "object_key", "left_anti").join(
        parents, "object_key", "left_anti"
    )
