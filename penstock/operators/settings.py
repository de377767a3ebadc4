"""Layered settings as tables: ``(cluster, topic, role, key, value)``, topic NULL for cluster defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.functions.logs import key_value_line

SCHEMA = "cluster string, topic string, role string, key string, value string"
CLIENT_ROLES = ["producer", "consumer"]

# Group titles of the listing.
CLUSTER_GROUPS = {
    "server": "SERVER CONFIGURATION",
    "producer": "SERVER PRODUCER CONFIGURATION",
    "consumer": "SERVER CONSUMER CONFIGURATION",
}
ABOUT_GROUP = "GLOBAL CONFIG"
ABOUT_FIELDS = ["Version", "Author", "Description", "Environment"]
TOPIC_GROUPS = {"producer": "PRODUCER SETTINGS", "consumer": "CONSUMER SETTINGS"}

_ENTRY = ["cluster", "topic", "role", "key"]


def from_nested(spark: SparkSession, clusters: Mapping) -> DataFrame:
    """The long table of one nested settings mapping (cluster → server/producer/consumer/topics)."""
    rows = []
    for cluster, sections in clusters.items():
        for role in ["server", *CLIENT_ROLES]:
            rows += [(cluster, None, role, k, str(v)) for k, v in (sections.get(role) or {}).items()]
        for topic, topic_sections in (sections.get("topics") or {}).items():
            for role in CLIENT_ROLES:
                rows += [(cluster, topic, role, k, str(v)) for k, v in (topic_sections.get(role) or {}).items()]
    return spark.createDataFrame(rows, SCHEMA)


def _client_defaults(defaults: DataFrame, with_server: bool) -> DataFrame:
    """What every topic of a cluster inherits, one row per (cluster, role, key).

    Server settings reach both client roles and give way to a role default of
    the same key.
    """
    is_server = F.col("role") == "server"
    if not with_server:
        defaults = defaults.where(~is_server)
    clients = F.when(is_server, F.array(*[F.lit(r) for r in CLIENT_ROLES])).otherwise(F.array("role"))
    entry = F.struct(F.when(is_server, F.lit(0)).otherwise(F.lit(1)).alias("layer"), "value")
    own = defaults.select("cluster", F.explode(clients).alias("role"), "key", entry.alias("entry"))
    return own.groupBy("cluster", "role", "key").agg(F.max("entry").alias("entry")).select(
        "cluster", "role", "key", F.col("entry.value").alias("inherited"),
        F.element_at(F.array(F.lit("server"), F.lit("cluster")), F.col("entry.layer") + 1).alias("inherited_from"))


def _with_code(wanted: DataFrame, below: DataFrame, code: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """What every wanted topic inherits, and the program's settings of it.

    A topic becomes one row that meets its cluster's defaults and one per
    program setting, which has no cluster to meet.
    """
    names = ["set_role", "set_key", "set_value"]
    entries = [(None, None, None), *((r, k, v) for r, values in code.items() for k, v in values.items())]
    rows = F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, entry)])
                     for entry in entries])
    spread = wanted.select("cluster", "topic", F.inline(rows)).withColumn(
        "meets", F.when(F.col("set_role").isNull(), F.col("cluster")))
    return spread.join(below.withColumnRenamed("cluster", "meets"), "meets", "left").select(
        "cluster", "topic", F.coalesce("set_role", "role").alias("role"), F.coalesce("set_key", "key").alias("key"),
        F.coalesce("set_value", "inherited").alias("inherited"),
        F.when(F.col("set_role").isNotNull(), F.lit("code")).otherwise(F.col("inherited_from"))
        .alias("inherited_from")).where(F.col("role").isNotNull())


def effective(topics: DataFrame, defaults: DataFrame, overrides: DataFrame, with_server: bool = True,
              code: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """The settings in force for each given (cluster, topic) and client role.

    What the program sets (``code``: role → key → value) wins over topic
    settings, those over cluster role defaults, those over server settings
    (left out with ``with_server=False``). A topic without settings of its own
    gets the defaults, and every given topic gets the program's settings of
    each role, whether anything is configured for it or not.

    Topics meet their cluster's defaults by an equi-join on the cluster, whose
    build side has one row per configured key. The program's layer goes into
    the same merge and adds no exchange to it.
    """
    wanted = topics.select("cluster", "topic").distinct()
    below = _client_defaults(defaults, with_server)
    own = overrides.join(wanted, ["cluster", "topic"], "left_semi").select(*_ENTRY, "value")
    for role, values in (code or {}).items():
        unset = (F.col("role") != role) | ~F.col("key").isin(list(values))
        below, own = below.where(unset), own.where(unset)
    if code:
        inherited = _with_code(wanted, below, code)
    else:
        inherited = wanted.join(below, "cluster")
    return inherited.join(own, _ENTRY, "full_outer").select(
        *_ENTRY,
        F.coalesce("value", "inherited").alias("value"),
        F.when(F.col("value").isNotNull(), F.lit("topic")).otherwise(F.col("inherited_from")).alias("layer"),
    )


def invalid_keys(settings: DataFrame, allowed: DataFrame) -> DataFrame:
    """Client settings whose key is not on its role's list. Server settings are not checked."""
    clients = settings.where(F.col("role").isin(CLIENT_ROLES))
    return clients.join(allowed.select("role", "key").distinct(), ["role", "key"], "left_anti").select(
        *_ENTRY, "value")


def require_valid(settings: DataFrame, allowed: DataFrame) -> DataFrame:
    """The same settings, or an error naming some key that is not allowed."""
    bad = invalid_keys(settings, allowed).select("key").head(1)
    if bad:
        raise ValueError(f"Invalid config key: {bad[0]['key']}")
    return settings


def lookup(requests: DataFrame, defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """Each request with whether its cluster and topic exist, and how many settings the topic has of its own.

    Both sides are reduced to one row per cluster or topic before they meet
    the requests, which are never aggregated.
    """
    clusters = defaults.select("cluster").union(overrides.select("cluster")).distinct().withColumn(
        "cluster_found", F.lit(True))
    topics = overrides.groupBy("cluster", "topic").agg(F.count("*").alias("own_settings"))
    return (
        requests.join(clusters, "cluster", "left").join(topics, ["cluster", "topic"], "left")
        .withColumn("cluster_found", F.coalesce("cluster_found", F.lit(False)))
        .withColumn("topic_found", F.col("own_settings").isNotNull())
        .withColumn("own_settings", F.coalesce("own_settings", F.lit(0)))
    )


def about(values: DataFrame) -> DataFrame:
    """The lines that head a listing, ``Field: value``, from a table ``(key, value)`` with keys in any case.

    All four fields have a line, ``null`` where the table names no value; other keys have none, and of
    a repeated key the smallest value counts.
    """
    given = values.groupBy(F.lower("key").alias("at")).agg(F.min("value").alias("value"))
    fields = values.sparkSession.createDataFrame([(f,) for f in ABOUT_FIELDS], "key string")
    found = fields.join(given, F.lower(fields["key"]) == given["at"], "left")
    none = F.lit(None).cast("string")
    return found.select(none.alias("cluster"), none.alias("topic"), "key", F.lit(ABOUT_GROUP).alias("group_name"),
                        F.concat("key", F.lit(": "), F.coalesce("value", F.lit("null"))).alias("line"))


def listing(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """One text line per setting: three groups per cluster, two per topic (with inherited defaults).

    :func:`about` gives the lines above them.
    """
    def titles(names: Mapping[str, str]):
        title = F.when(F.lit(False), F.lit(""))
        for role, text in names.items():
            title = title.when(F.col("role") == role, F.lit(text))
        return title

    columns = ["cluster", "topic", "key"]
    per_cluster = defaults.select(*columns, titles(CLUSTER_GROUPS).alias("group_name"),
                                  key_value_line("key", "value").alias("line"))
    topics = effective(overrides, defaults, overrides, with_server=False)
    per_topic = topics.select(*columns, titles(TOPIC_GROUPS).alias("group_name"),
                              key_value_line("key", "value", indent=1).alias("line"))
    return per_cluster.unionByName(per_topic)


def sections(settings: DataFrame, allowed: DataFrame) -> DataFrame:
    """One map of allowed keys per (cluster, topic, role).

    Keys are distinct and on the list, so a map is never larger than the list.
    """
    known = settings.join(allowed.select("role", "key").distinct(), ["role", "key"], "left_semi")
    entries = F.sort_array(F.collect_list(F.struct("key", "value")))
    return known.groupBy("cluster", "topic", "role").agg(F.map_from_entries(entries).alias("entries"))


def section(settings: DataFrame, cluster: str, topic: str, role: str) -> dict[str, str]:
    """The settings of one client, all of them, as a plain dict to hand to a connector."""
    rows = settings.where(
        (F.col("cluster") == cluster) & (F.col("topic") == topic) & (F.col("role") == role)
    ).select("key", "value").collect()
    return {r["key"]: r["value"] for r in rows}
