"""Queue connector options and record columns.

The connector itself is Spark's ``kafka`` format, a separate public package.
Everything past the scan takes any frame with that connector's columns.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.functions.device import once
from penstock.functions.logs import fits_message
from penstock.sources import seen_offsets

# Client settings Spark sets itself or refuses.
MANAGED_KEYS = [
    "key.serializer", "value.serializer", "key.deserializer", "value.deserializer",
    "auto.offset.reset", "enable.auto.commit", "auto.commit.interval.ms", "interceptor.classes",
]
EARLIEST, READ_COMMITTED = "earliest", "read_committed"
RECORD_ID = "record_id"
_SHARE, _TAIL = "_share", "_tail"

# The setting names Kafka 3.9 clients know, from its public documentation.
_COMMON_KEYS = """
bootstrap.servers client.dns.lookup client.id connections.max.idle.ms enable.metrics.push interceptor.classes
metadata.max.age.ms metadata.recovery.strategy metric.reporters metrics.num.samples metrics.recording.level
metrics.sample.window.ms auto.include.jmx.reporter receive.buffer.bytes reconnect.backoff.max.ms reconnect.backoff.ms
request.timeout.ms retry.backoff.max.ms retry.backoff.ms send.buffer.bytes socket.connection.setup.timeout.max.ms
socket.connection.setup.timeout.ms security.protocol security.providers
sasl.client.callback.handler.class sasl.jaas.config sasl.kerberos.kinit.cmd sasl.kerberos.min.time.before.relogin
sasl.kerberos.service.name sasl.kerberos.ticket.renew.jitter sasl.kerberos.ticket.renew.window.factor
sasl.login.callback.handler.class sasl.login.class sasl.login.connect.timeout.ms sasl.login.read.timeout.ms
sasl.login.refresh.buffer.seconds sasl.login.refresh.min.period.seconds sasl.login.refresh.window.factor
sasl.login.refresh.window.jitter sasl.login.retry.backoff.max.ms sasl.login.retry.backoff.ms sasl.mechanism
sasl.oauthbearer.clock.skew.seconds sasl.oauthbearer.expected.audience sasl.oauthbearer.expected.issuer
sasl.oauthbearer.header.urlencode sasl.oauthbearer.jwks.endpoint.refresh.ms
sasl.oauthbearer.jwks.endpoint.retry.backoff.max.ms sasl.oauthbearer.jwks.endpoint.retry.backoff.ms
sasl.oauthbearer.jwks.endpoint.url sasl.oauthbearer.scope.claim.name sasl.oauthbearer.sub.claim.name
sasl.oauthbearer.token.endpoint.url
ssl.cipher.suites ssl.enabled.protocols ssl.endpoint.identification.algorithm ssl.engine.factory.class
ssl.key.password ssl.keymanager.algorithm ssl.keystore.certificate.chain ssl.keystore.key ssl.keystore.location
ssl.keystore.password ssl.keystore.type ssl.protocol ssl.provider ssl.secure.random.implementation
ssl.trustmanager.algorithm ssl.truststore.certificates ssl.truststore.location ssl.truststore.password
ssl.truststore.type
""".split()
PRODUCER_KEYS = _COMMON_KEYS + """
acks batch.size buffer.memory compression.gzip.level compression.lz4.level compression.type compression.zstd.level
delivery.timeout.ms enable.idempotence key.serializer linger.ms max.block.ms max.in.flight.requests.per.connection
max.request.size metadata.max.idle.ms partitioner.adaptive.partitioning.enable partitioner.availability.timeout.ms
partitioner.class partitioner.ignore.keys retries transaction.timeout.ms transactional.id value.serializer
""".split()
CONSUMER_KEYS = _COMMON_KEYS + """
allow.auto.create.topics auto.commit.interval.ms auto.offset.reset check.crcs client.rack default.api.timeout.ms
enable.auto.commit exclude.internal.topics fetch.max.bytes fetch.max.wait.ms fetch.min.bytes group.id
group.instance.id group.protocol group.remote.assignor heartbeat.interval.ms internal.leave.group.on.close
internal.throw.on.fetch.stable.offset.unsupported isolation.level key.deserializer max.partition.fetch.bytes
max.poll.interval.ms max.poll.records partition.assignment.strategy session.timeout.ms value.deserializer
""".split()


def allowed_keys(spark: SparkSession) -> DataFrame:
    """Role and key of every setting a client accepts."""
    rows = [("producer", k) for k in PRODUCER_KEYS] + [("consumer", k) for k in CONSUMER_KEYS]
    return spark.createDataFrame(rows, "role string, key string")


def client_options(settings: Mapping[str, str]) -> dict[str, str]:
    """Effective client settings as connector options, without those Spark manages."""
    return {f"kafka.{k}": str(v) for k, v in settings.items() if k not in MANAGED_KEYS}


def source_options(settings: Mapping[str, str], topic: str, starting: str = EARLIEST,
                   max_offsets: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Options of one topic's source: from the earliest offset, committed records only.

    Parallelism follows the topic's partitions; ``min_partitions`` splits them
    further when one holds far more than the others. Offsets are kept in the
    query's checkpoint and never committed by the client.
    """
    options = {"kafka.isolation.level": READ_COMMITTED, **client_options(settings)}
    options |= {"subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "true"}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(settings: Mapping[str, str], topic: str) -> dict[str, str]:
    """Options of one topic's sink: idempotent, acknowledged by all replicas unless set otherwise.

    A transactional id is left out: Spark's sink is at-least-once, so outgoing
    records carry an id (:func:`with_record_id`) and readers drop repeats
    (:func:`drop_repeats`).
    """
    defaults = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}
    client = client_options(settings)
    return {**defaults, **{k: v for k, v in client.items()
                           if k not in ("kafka.transactional.id", "kafka.transaction.timeout.ms")}, "topic": topic}


def read_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def write_batch(records: DataFrame, options: Mapping[str, str]) -> None:
    records.write.format("kafka").options(**options).save()


def records_as_text(records: DataFrame) -> DataFrame:
    """Key and value as UTF-8 text, with the record's place in the queue."""
    return records.withColumn("key", F.col("key").cast("string")).withColumn("value", F.col("value").cast("string"))


def json_table(records: DataFrame, schema: T.StructType, *keep: str, unreadable: str | None = None) -> DataFrame:
    """A declared table over JSON message values; fields a message lacks are NULL.

    An unreadable message gives a row of NULLs, which the key check downstream
    sets aside, instead of stopping the stream. ``unreadable`` names a further
    column that keeps the text of such a message.
    """
    options = {}
    if unreadable is not None:
        schema = T.StructType([*schema.fields, T.StructField(unreadable, T.StringType())])
        options["columnNameOfCorruptRecord"] = unreadable
    row = once(F.from_json(F.col("value").cast("string"), schema, options))
    return records.withColumn("_row", row).select("_row.*", *keep)


def with_record_id(records: DataFrame) -> DataFrame:
    """An id fixed by where a record was read, the same on every retry."""
    return records.withColumn(RECORD_ID, F.concat_ws("-", "topic", "partition", "offset"))


def outgoing(records: DataFrame) -> DataFrame:
    """Key and value to send, with the record id as a header."""
    header = F.struct(F.lit(RECORD_ID).alias("key"), F.col(RECORD_ID).cast("binary").alias("value"))
    return records.select("key", "value", F.array(header).alias("headers"))


def with_sent_id(records: DataFrame) -> DataFrame:
    """The id a record was sent with (read with the connector's ``includeHeaders`` option)."""
    sent = F.filter("headers", lambda h: h["key"] == RECORD_ID)
    return records.withColumn(RECORD_ID, F.try_element_at(sent, F.lit(-1))["value"].cast("string"))


def drop_repeats(records: DataFrame) -> DataFrame:
    """One of each record id (a sink that writes at least once may repeat some). For batches of records."""
    return records.dropDuplicates([RECORD_ID])


def with_sent_place(records: DataFrame) -> DataFrame:
    """Where a record was read before it was sent, from its id: ``sent_topic``, ``sent_partition``, ``sent_offset``."""
    # One regular expression a row: without the generator, a filter on a part of the place would repeat it.
    parts = records.withColumn(_TAIL, once(F.regexp_extract(RECORD_ID, r"\A.*-(\d+-\d+)\z", 1)))
    topic = F.when(F.col(_TAIL) == "", "").otherwise(F.left(RECORD_ID, F.length(RECORD_ID) - F.length(_TAIL) - 1))
    partition, offset = (F.when(F.col(_TAIL) != "", F.substring_index(_TAIL, "-", side).cast(kind))
                         for side, kind in ((1, "int"), (-1, "long")))
    return parts.withColumns({"sent_topic": topic, "sent_partition": partition, "sent_offset": offset}).drop(_TAIL)


def first_of_each(records: DataFrame, topic: str = "topic", partition: str = "partition",
                  offset: str = "offset", shares: int = 32) -> DataFrame:
    """A stream of records without those that came before, in any batch of this query, restarts included.

    For readers of a sink that writes at least once: name the columns of the sent place (:func:`with_sent_place`). State is
    kept per topic, partition and one of ``shares`` that runs of its offsets are dealt over, so that one partition occupies
    many tasks; a checkpoint keeps its number. State holds the gaps between offsets only, so it needs no watermark and
    does not grow with the stream, and a batch touches the part of it around its own offsets. Rows with a null in one of
    the three have no place and pass. The query needs the settings of :func:`state_settings`.
    """
    cloudpickle.register_pickle_by_value(sys.modules[seen_offsets.__name__])  # workers need no copy of this package
    placed = F.col(topic).isNotNull() & F.col(partition).isNotNull() & F.col(offset).isNotNull()
    shared = records.where(placed).withColumn(_SHARE, seen_offsets.share_of(F.col(offset), shares))
    once = shared.groupBy(topic, partition, _SHARE).transformWithStateInPandas(
        seen_offsets.SeenOffsets(offset, records.columns, shares), records.schema, outputMode="Append", timeMode="None")
    return once.union(records.where(~placed))


#: Session settings of queries with this kind of state.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def state_settings(spark: SparkSession, parts: int | None = None) -> dict[str, str | int]:
    """The same with the number of parts of the state, each of which costs a task in every batch, used or not.

    By default as many as the cluster has cores now. The first run's number holds for the life of a checkpoint: name
    one for a query that begins on a small cluster.
    """
    return STATE_STORE | {"spark.sql.shuffle.partitions": parts or spark.sparkContext.defaultParallelism}


def within_size(messages: DataFrame, limit: int, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Messages a queue accepts, and the oversized rest."""
    ok = F.coalesce(fits_message(value, limit), F.lit(True))  # a null value has no size
    return messages.where(ok), messages.where(~ok)
