"""Merge scheduling: which domains to merge hourly or daily, and the payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from accesslens.constants import PAYLOAD_BATCH
from accesslens.functions import net

DAILY, HOURLY = "0", "1"


def with_config(domains: DataFrame, config: DataFrame) -> DataFrame:
    """Config of the parent domain if there is one, else of the name itself.

    ``config`` is ``(domain, merge_flag, dir_flag)``; domains without any config
    are dropped.  A name without a dot has no parent.
    """
    def side(prefix: str) -> DataFrame:
        return config.select(*[F.col(c).alias(f"{prefix}{c}") for c in ("domain", "merge_flag", "dir_flag")])

    parent = F.when(F.col("domain").contains("."), net.parent_domain(F.col("domain")))
    joined = (
        domains.select("domain")
        .distinct()
        .withColumn("_parent", parent)
        .join(side("p_"), F.col("_parent") == F.col("p_domain"), "left")
        .join(side("s_"), F.col("domain") == F.col("s_domain"), "left")
    )
    from_parent = F.col("p_domain").isNotNull()

    def pick(c: str) -> Column:
        return F.when(from_parent, F.col(f"p_{c}")).otherwise(F.col(f"s_{c}"))

    return joined.select("domain", pick("merge_flag").alias("merge_flag"), pick("dir_flag").alias("dir_flag")).filter(
        F.col("merge_flag").isNotNull()
    )


def _dir_flag() -> Column:
    return F.when(F.col("dir_flag") == "0", "0").otherwise("1").alias("dir_flag")


def hourly(domains: DataFrame, config: DataFrame) -> DataFrame:
    """Domains merged each hour, with their directory flag."""
    known = with_config(domains, config)
    return known.filter(F.col("merge_flag") == HOURLY).select("domain", _dir_flag())


def daily_to_save(domains: DataFrame, config: DataFrame, saved: DataFrame) -> DataFrame:
    """Domains merged each day that are not saved yet."""
    known = with_config(domains, config).filter(F.col("merge_flag") == DAILY)
    return known.select("domain").join(saved.select("domain").distinct(), "domain", "left_anti")


def schedule_hourly(domains: DataFrame, config: DataFrame, saved: DataFrame) -> DataFrame:
    """Both results of the hourly run: rows to post now, rows to save for the day."""
    post = hourly(domains, config).select(F.lit("post").alias("action"), "domain", "dir_flag")
    save = daily_to_save(domains, config, saved).select(
        F.lit("save").alias("action"), "domain", F.lit(None).cast("string").alias("dir_flag")
    )
    return post.unionByName(save)


def schedule_daily(saved: DataFrame, config: DataFrame) -> DataFrame:
    """Saved domains that are still merged daily."""
    known = with_config(saved, config)
    return known.filter(F.col("merge_flag") == DAILY).select("domain", _dir_flag())


HASH_DIGITS = 3


def batched(scheduled: DataFrame, size: int = PAYLOAD_BATCH) -> DataFrame:
    """Number the domains and cut them into batches of ``size``.

    The order is (md5 prefix, domain).  Domains are ranked inside their prefix
    and shifted by the domains of all smaller prefixes, so no task ever sees
    the whole list; only the 4,096 prefix counts are added up in one place.
    """
    keyed = scheduled.withColumn("_p", F.substring(F.md5("domain"), 1, HASH_DIGITS))
    counts = keyed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    # at most 16 ** HASH_DIGITS rows, whatever the number of domains
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy("domain"))
    place = F.col("_off") + inside - 1
    return (
        keyed.join(offsets, "_p")
        .withColumn("place", place)
        .withColumn("batch", F.floor(F.col("place") / size))
        .drop("_p", "_off")
    )


def payloads(scheduled: DataFrame, time: str, size: int = PAYLOAD_BATCH, **fixed: str) -> DataFrame:
    """One JSON payload per batch: time, ``domain dirflag`` entries, fixed fields."""
    entry = F.concat_ws(" ", "domain", "dir_flag")
    rows = batched(scheduled, size).select("batch", F.struct("place", entry.alias("e")).alias("x"))
    lists = rows.groupBy("batch").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    body = F.struct(
        F.lit(time).alias("time"),
        F.col("xs.e").alias("domain"),
        *[F.lit(v).alias(k) for k, v in fixed.items()],
    )
    return lists.select("batch", F.to_json(body).alias("payload"))


def output_sizes(files: DataFrame) -> DataFrame:
    """``domain 0 bytes`` per domain directory, from (domain, path, size) rows."""
    sizes = files.groupBy("domain").agg(F.sum("size").alias("bytes"))
    return sizes.select("domain", F.concat_ws(" ", "domain", F.lit("0"), F.col("bytes").cast("string")).alias("status"))
