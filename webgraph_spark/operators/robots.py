"""Robots files as tables: rules, decisions, delays, sitemaps (ROB-1..6, JOI-7).

A robots text becomes one row per line; window functions over the lines of a
site find the groups. The work per site is bounded by its one robots file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.functions import urls
from webgraph_spark.operators.skew import spread_join
from webgraph_spark.session import cut_lineage

# Fixed value: line breaks of a robots text.
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"

# Keys that close the list of agents and belong to a group.
RULE_KEYS = ["disallow", "allow", "crawl-delay", "request-rate"]

# Fixed value: white space around keys, values and whole lines.
_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

_RATE = r"^[\s]*([0-9]+)[\s]*/[\s]*([0-9]+)[\s]*$"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, _BLANKS, "")


def robots_file_usable(fetches: DataFrame) -> DataFrame:
    """ROB-4: fetched robots files that count; without one everything is allowed."""
    return fetches.where((F.col("status") == 200) & F.col("content_type").contains("text/plain"))


def sitemap_file_usable(fetches: DataFrame) -> DataFrame:
    """ROB-5: fetched sitemap files that count."""
    return fetches.where(F.col("status") == 200)


def robots_lines(sites: DataFrame) -> DataFrame:
    """(site_id, line_no, key, value) of every line that matters; key '' marks an empty line.

    sites has site_id, robots_content. Comments and blank lines do not end a
    group, only an exactly empty line does.
    """
    lines = sites.select("site_id", F.posexplode(F.split("robots_content", LINE_BREAK)).alias("line_no", "line"))
    content = F.col("content")
    colon = F.instr(content, ":")
    keyed = (
        lines.withColumn("content", _strip(F.substring_index("line", "#", 1)))
        .where((F.col("line") == "") | (F.instr(F.col("content"), ":") > 0))
        .select(
            "site_id",
            "line_no",
            F.when(F.col("line") == "", "").otherwise(F.lower(_strip(F.substring_index(content, ":", 1)))).alias("key"),
            urls.percent_decode(_strip(F.substring(content, colon + 1, F.length(content)))).alias("value"),
        )
    )
    return keyed.where(F.col("key").isin("", "user-agent", "sitemap", *RULE_KEYS))


def robots_rules(sites: DataFrame) -> DataFrame:
    """One row per group: agents, ordered rules, crawl delay, request rate.

    A delay or a part of a rate too large for an integer is NULL.
    """
    in_file = Window.partitionBy("site_id").orderBy("line_no")
    kind = F.when(F.col("key") == "", "E").when(F.col("key") == "user-agent", "U").otherwise("R")
    lines = robots_lines(sites).where(F.col("key") != "sitemap").withColumn("kind", kind)

    # A rule counts while the last empty or agent line above it names an agent.
    opener = F.last(F.when(F.col("kind") != "R", F.col("kind")), ignorenulls=True).over(in_file)
    counted = lines.withColumn("opener", opener).where((F.col("kind") != "R") | (F.col("opener") == "U"))
    opens = (F.col("kind") == "U") & (F.coalesce(F.lag("kind").over(in_file), F.lit("E")) != "U")
    grouped = counted.withColumn("opens", opens.cast("int")).withColumn("group_no", F.sum("opens").over(in_file))

    key, value = F.col("key"), F.col("value")
    path = F.when(value == "", "").otherwise(urls.percent_encode(urls.drop_empty_parts(value), urls.PATH_SAFE))
    rule = F.struct(
        F.col("line_no").alias("rule_no"),
        path.alias("path"),
        ((key == "allow") | (value == "")).alias("allow"),
    )
    delay = F.when((key == "crawl-delay") & value.rlike("^[0-9]+$"), F.expr("try_cast(value AS int)"))
    rate = F.when(
        (key == "request-rate") & value.rlike(_RATE),
        F.struct(
            F.regexp_extract(value, _RATE, 1).try_cast("int").alias("requests"),
            F.regexp_extract(value, _RATE, 2).try_cast("int").alias("seconds"),
        ),
    )
    agent = F.when(key == "user-agent", F.struct("line_no", value.alias("agent")))
    groups = (
        grouped.where(F.col("kind") != "E")
        .withColumn("_delay", delay)
        .withColumn("_rate", rate)
        .groupBy("site_id", "group_no")
        .agg(
            F.transform(F.array_sort(F.collect_list(agent)), lambda a: a["agent"]).alias("agents"),
            F.array_sort(F.collect_list(F.when(key.isin("disallow", "allow"), rule))).alias("rules"),
            F.max_by("_delay", F.when(F.col("_delay").isNotNull(), F.col("line_no"))).alias("crawl_delay"),
            F.max_by("_rate", F.when(F.col("_rate").isNotNull(), F.col("line_no"))).alias("request_rate"),
            F.max((F.col("kind") == "R").cast("int")).alias("_has_rule"),
        )
    )
    return groups.where("_has_rule = 1").select(
        "site_id",
        F.col("group_no").cast("int").alias("group_no"),
        "agents",
        F.array_contains("agents", "*").alias("is_default"),
        "rules",
        "crawl_delay",
        "request_rate",
    )


def sitemap_list(sites: DataFrame) -> DataFrame:
    """Sitemap lines in file order, also outside groups."""
    lines = robots_lines(sites).where(F.col("key") == "sitemap")
    pos = F.row_number().over(Window.partitionBy("site_id").orderBy("line_no"))
    return lines.select("site_id", pos.alias("pos"), F.col("value").alias("sitemap_url"))


def group_for_agent(rules: DataFrame, agent: str = "*") -> DataFrame:
    """The group each site answers ``agent`` with: the first that names it, else the first default."""
    token = agent.split("/")[0].lower()
    named = F.exists("agents", lambda a: F.lit(token).contains(F.lower(a)))
    chosen = F.min(F.struct("is_default", "group_no", "rules", "crawl_delay", "request_rate")).alias("_group")
    applicable = rules.where(F.col("is_default") | named)
    return applicable.groupBy("site_id").agg(chosen).select(
        "site_id", "_group.rules", "_group.crawl_delay", "_group.request_rate"
    )


def robots_crawl_delay(rules: DataFrame, agent: str = "*") -> DataFrame:
    return group_for_agent(rules, agent).select("site_id", "crawl_delay")


def robots_request_rate(rules: DataFrame, agent: str = "*") -> DataFrame:
    """NULL for sites without a group for the agent, which have no row here."""
    return group_for_agent(rules, agent).select("site_id", "request_rate")


def prefix_index(rules: DataFrame, agent: str = "*") -> DataFrame:
    """(site_id, prefix, first): per prefix the lowest rule number and what it says; ``*`` is the empty prefix."""
    chosen = group_for_agent(rules, agent).select("site_id", F.posexplode("rules").alias("rule_no", "rule"))
    prefix = F.when(F.col("rule.path") == "*", "").otherwise(F.col("rule.path"))
    first = F.min(F.struct("rule_no", F.col("rule.allow").alias("allow"))).alias("first")
    return chosen.where(prefix.isNotNull()).groupBy("site_id", prefix.alias("prefix")).agg(first)


def robots_decision(targets: DataFrame, rules: DataFrame, agent: str = "*") -> DataFrame:
    """Adds ``allowed`` to targets (site_id, url, ...): the first rule that is a prefix decides.

    Each path asks the index only for the prefix lengths its site has rules of, by equality, and the lowest rule number
    found decides. So a site with very many rules costs a path as many probes as it has lengths, and no row holds all of
    them. A path that occurs often is decided once; sites with very many paths are spread.
    """
    index = cut_lineage(prefix_index(rules, agent), "robots")
    lengths = index.groupBy("site_id").agg(F.collect_set(F.length("prefix")).alias("_lengths"))
    located = targets.withColumn("_path", urls.robots_path(F.col("url")))
    paths = located.where(F.col("site_id").isNotNull()).select("site_id", "_path").distinct()
    fitting = spread_join(paths, lengths, ["site_id"], "inner", ["_path"]).select(
        "site_id", "_path", F.explode(F.filter("_lengths", lambda n: n <= F.length("_path"))).alias("_n")
    )
    probes = fitting.select("site_id", "_path", F.expr("substring(_path, 1, _n)").alias("prefix"))
    found = spread_join(probes, index, ["site_id", "prefix"], "inner", ["_path"])
    decided = found.groupBy("site_id", "_path").agg(F.min("first").alias("_first"))
    joined = located.join(decided.select("site_id", "_path", F.col("_first.allow").alias("_allow")), ["site_id", "_path"], "left")
    return joined.withColumn("allowed", F.coalesce("_allow", F.lit(True))).select(*targets.columns, "allowed")
