"""URL rules by a sort-merge range join with a stack of active nested rules.

A host is reversed label by label ("net.example.www."), which makes a rule for a host and
its subdomains an interval of keys. Rule hosts and urls are sorted together inside
buckets, and one sweep carries the stack: one slot per label depth holds the rule host
opened last at that depth. Intervals of one depth never overlap, so a slot is active
exactly if its key is a prefix of the url's key. Only native expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.llm.common import BROADCAST_IDS, written

RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
DEFAULT = "allow"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    return F.translate(column, _LOWER.upper(), _LOWER)


def host_of(url: str = "url") -> Column:
    """After the first "://" up to "/", "?", "#" or the end; empty for null or no "://"."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: str = "url") -> Column:
    found = r"(?s)\A.*?://[^/?#]*([^?#]*)"
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), found, 1)


def host_key(host: str) -> Column:
    """Labels in reverse, each closed by a dot: prefixes of it are the host's parents."""
    return F.concat(F.array_join(F.reverse(F.split(F.col(host), r"\.")), "."), F.lit("."))


def first_label(key: str) -> Column:
    return F.substring_index(F.col(key), ".", 1)


def judge_urls(
    pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT
) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict.

    ``rules`` has verdict, host and path. The longest rule wins (by host, then by path; of
    repeated rules "allow" wins). Null urls and urls without "://" have an empty host and
    path and get ``default``, as does any url without a fitting rule. An empty rule table
    or page table is fine; other columns are not read.

    A hot host is spread by page over as many buckets as its first label's share of all
    rows asks for, and each bucket gets the rules of that label. A label is never spread
    over more buckets than it has pages per rule, so copies of rules stay below the pages.
    The paths of one rule host travel as one array.
    """
    spark = pages.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    urls = pages.select(
        F.col(id_col).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path")
    ).withColumn("key", host_key("host"))
    by_host = (
        rules.select("verdict", ascii_lower(F.col("host")).alias("host"), "path")
        .groupBy("host")
        .agg(
            F.array_sort(
                F.collect_set(F.struct("path", "verdict")),
                # longest path first, then "allow" before "block"
                lambda a, b: F.when(F.length(a["path"]) != F.length(b["path"]),
                    F.length(b["path"]) - F.length(a["path"]))
                .when(a["verdict"] < b["verdict"], -1).when(a["verdict"] > b["verdict"], 1).otherwise(0),
            ).alias("paths")
        )
        .withColumn("key", host_key("host"))
        .withColumn("depth", F.size(F.split("host", r"\.")))
    )
    labels = by_host.groupBy(first_label("key").alias("label")).agg(F.count("*").alias("n_rules"))
    depths = sorted(r[0] for r in by_host.select("depth").distinct().collect())  # label depths: at most 127

    # Spread of each rule label; at most one row per label that has rules.
    counts = urls.groupBy(first_label("key").alias("label")).agg(F.count("*").alias("n"))
    total = F.lit(max(1, urls.count()))
    spread = labels.join(counts, "label", "left").select(
        "label",
        F.greatest(
            F.lit(1),
            F.least(F.ceil(F.coalesce("n", F.lit(0)) * buckets / total), F.ceil(F.col("n") / F.col("n_rules"))),
        ).cast("int").alias("salts"),
    )
    # As many rows as labels with rules: broadcast up to a counted size, else joined by shuffle.
    spread = written(spread, "rule-labels")
    if spread.count() <= BROADCAST_IDS:
        spread = F.broadcast(spread)
    # Urls whose label has no rule are spread over all buckets.
    placed = urls.withColumn("label", first_label("key")).join(spread, "label", "left")
    salt = F.pmod(F.xxhash64("page_id", "path"), F.coalesce("salts", F.lit(buckets))).cast("int")
    url_events = placed.select(
        "label", salt.alias("salt"), "key", F.lit(1).alias("kind"), "page_id", "host", "path",
        F.lit(None).cast("int").alias("depth"), F.lit(None).cast(by_host.schema["paths"].dataType).alias("paths"),
    )
    rule_events = (
        by_host.withColumn("label", first_label("key"))
        .join(spread, "label")
        .select(
            "label", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "key",
            F.lit(0).alias("kind"), F.lit(None).cast(urls.schema["page_id"].dataType).alias("page_id"),
            "host", F.lit(None).cast("string").alias("path"), "depth", "paths",
        )
    )
    sweep = (
        Window.partitionBy("label", "salt").orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    slot = F.struct("key", "host", "paths")
    # Dealt by both columns by name: rows that a join has put together by label alone would
    # else count as dealt already, and a hot label would stay in one task.
    dealt = url_events.unionByName(rule_events).repartition("label", "salt")
    swept = dealt.select(
        "*",
        *[
            F.last(F.when((F.col("kind") == 0) & (F.col("depth") == d), slot), ignorenulls=True).over(sweep).alias(f"at{d}")
            for d in depths
        ],
    )

    def fitting(d: int) -> Column:
        top = F.col(f"at{d}")
        found = F.filter(top["paths"], lambda p: F.startswith(F.col("path"), p["path"]))
        hit = F.get(found, F.lit(0))
        rule = F.struct(F.concat(top["host"], hit["path"]).alias("rule"), hit["verdict"].alias("verdict"))
        return F.when(F.startswith(F.col("key"), top["key"]) & hit.isNotNull(), rule)

    deepest_first = [fitting(d) for d in reversed(depths)]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return (
        swept.filter("kind = 1")
        .withColumn("hit", F.coalesce(*deepest_first, none))
        .select(
            "page_id", "host", "path", F.col("hit.rule").alias("rule"),
            F.coalesce(F.col("hit.verdict"), F.lit(default)).alias("verdict"),
        )
    )
