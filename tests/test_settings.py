import pytest
from pyspark.sql import functions as F

from penstock.operators import settings
from penstock.sources import kafka
from penstock.streaming import jobs

NESTED = {
    "main": {
        "server": {"bootstrap.servers": "h:1", "client.id": "from-server", "kerberos.domain.name": "d"},
        "producer": {"linger.ms": "20", "compression.type": "lz4", "transaction.timeout.ms": "900000",
                     "key.serializer": "S", "client.id": "from-cluster"},
        "consumer": {"auto.offset.reset": "latest", "isolation.level": "read_committed", "fetch.min.bytes": 1048576},
        "topics": {
            "T1": {"producer": {"client.id": "C1", "linger.ms": "5"}, "consumer": {"group.id": "G1"}},
            "T2": {"producer": {"transactional.id": "tx"}},
        },
    },
    "bare": {"server": {"bootstrap.servers": "h:2"}},
}


@pytest.fixture(scope="module")
def tables(spark):
    entries = settings.from_nested(spark, NESTED)
    return entries.where("topic is null"), entries.where("topic is not null")


def sections(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["cluster"], r["topic"], r["role"]), {})[r["key"]] = (r["value"], r["layer"])
    return out


def test_layers(spark, tables):
    topics = spark.createDataFrame([("main", "T1"), ("main", "T2"), ("main", "none"), ("bare", "T1"), ("no", "T1")],
                                   "cluster string, topic string")
    found = sections(settings.effective(topics, *tables))
    assert found["main", "T1", "producer"] == {
        "bootstrap.servers": ("h:1", "server"), "kerberos.domain.name": ("d", "server"), "client.id": ("C1", "topic"),
        "linger.ms": ("5", "topic"), "compression.type": ("lz4", "cluster"),
        "transaction.timeout.ms": ("900000", "cluster"), "key.serializer": ("S", "cluster")}
    assert found["main", "T1", "consumer"]["client.id"] == ("from-server", "server")
    assert found["main", "T1", "consumer"]["group.id"] == ("G1", "topic")
    assert found["main", "none", "producer"]["client.id"] == ("from-cluster", "cluster")
    assert found["bare", "T1", "consumer"] == {"bootstrap.servers": ("h:2", "server")}
    assert not any(cluster == "no" for cluster, _, _ in found)


def test_topic_configuration_leaves_server_out(tables):
    found = sections(settings.effective(tables[1], *tables, with_server=False))
    assert found["main", "T2", "producer"]["linger.ms"] == ("20", "cluster")
    assert "bootstrap.servers" not in found["main", "T2", "producer"]


def test_code_wins_per_role(spark, tables):
    topics = spark.createDataFrame([("main", "T1"), ("main", "none"), ("no", "T1")], "cluster string, topic string")
    code = {"consumer": {"auto.offset.reset": "earliest", "group.id": "G9"}, "producer": {"linger.ms": "0"}}
    found = sections(settings.effective(topics, *tables, code=code))
    plain = sections(settings.effective(topics, *tables))
    for topic in ["T1", "none"]:
        assert found["main", topic, "consumer"] == plain["main", topic, "consumer"] | {
            "auto.offset.reset": ("earliest", "code"), "group.id": ("G9", "code")}
        assert found["main", topic, "producer"] == plain["main", topic, "producer"] | {"linger.ms": ("0", "code")}
    assert found["no", "T1", "producer"] == {"linger.ms": ("0", "code")}  # nothing is configured there
    assert sections(settings.effective(topics, *tables, code={"consumer": {}})) == plain


def test_allowed_keys(spark, tables):
    allowed = kafka.allowed_keys(spark)
    entries = tables[0].unionByName(tables[1])
    assert settings.require_valid(entries, allowed) is entries
    wrong = settings.from_nested(spark, {"c": {"server": {"any.thing": 1}, "consumer": {"linger.ms": 1}}})
    assert [r["key"] for r in settings.invalid_keys(wrong, allowed).collect()] == ["linger.ms"]
    with pytest.raises(ValueError, match="Invalid config key: linger.ms"):
        settings.require_valid(wrong, allowed)


def test_lookup(spark, tables):
    asked = spark.createDataFrame([(1, "main", "T1"), (2, "main", "x"), (3, "x", "T1")],
                                  "request_id int, cluster string, topic string")
    found = {r["request_id"]: (r["cluster_found"], r["topic_found"], r["own_settings"])
             for r in settings.lookup(asked, *tables).collect()}
    assert found == {1: (True, True, 3), 2: (True, False, 0), 3: (False, False, 0)}


def test_listing_pads_keys(tables):
    lines = {(r["topic"], r["group_name"], r["key"]): r["line"] for r in settings.listing(*tables).collect()}
    assert lines[None, "SERVER CONFIGURATION", "client.id"] == "client.id" + " " * 21 + " = from-server"
    assert lines["T1", "CONSUMER SETTINGS", "group.id"] == "  group.id" + " " * 22 + " = G1"


def test_about_lines_head_a_listing(spark, tables):
    values = spark.createDataFrame([("version", "1.2"), ("AUTHOR", "a"), ("description", None), ("other", "x"),
                                    ("author", "b")], "key string, value string")
    both = settings.about(values).unionByName(settings.listing(*tables))
    found = {r["key"]: r["line"] for r in both.where(F.col("group_name") == settings.ABOUT_GROUP).collect()}
    assert found == {"Version": "Version: 1.2", "Author": "Author: a", "Description": "Description: null",
                     "Environment": "Environment: null"}
    assert both.where("cluster is null").count() == 4
    assert settings.about(values.where("false")).count() == 4


def test_long_key_stays_whole(spark):
    key = "k" * 40
    entries = settings.from_nested(spark, {"c": {"server": {key: "v"}}})
    assert settings.listing(entries, entries.where("topic is not null")).first()["line"] == f"{key} = v"


def test_connector_options(tables):
    merged = settings.effective(tables[1], *tables)
    consumer = settings.section(merged, "main", "T1", "consumer")
    options = kafka.source_options(consumer, "T1", max_offsets=1000, min_partitions=8)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "kafka.client.id": "from-server", "kafka.kerberos.domain.name": "d",
        "kafka.isolation.level": "read_committed", "kafka.fetch.min.bytes": "1048576", "kafka.group.id": "G1",
        "subscribe": "T1", "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "1000",
        "minPartitions": "8"}
    producer = kafka.sink_options(settings.section(merged, "main", "T2", "producer"), "T2")
    assert producer["topic"] == "T2" and producer["kafka.acks"] == "all" and producer["kafka.linger.ms"] == "20"
    assert not any("transaction" in k or "serializer" in k for k in producer)


def test_section_has_every_key(spark):
    many = spark.range(2500).selectExpr("'c' as cluster", "'t' as topic", "'producer' as role",
                                        "concat('k', id) as key", "'v' as value")
    assert len(settings.section(many, "c", "t", "producer")) == 2500


def test_queue_records(spark):
    records = spark.createDataFrame([(bytearray(b"k"), bytearray(b"v"), "t", 0, 5)] * 2,
                                    "key binary, value binary, topic string, partition int, offset long")
    text = kafka.with_record_id(kafka.records_as_text(records))
    assert kafka.drop_repeats(text).select("key", "value", "record_id").collect() == [("k", "v", "t-0-5")]


def test_queue_connector_is_named(spark, folder):
    """Without the connector package the job fails at the format, not in our code."""
    with pytest.raises(Exception, match="kafka"):
        kafka.read_stream(spark, kafka.source_options({"bootstrap.servers": "h:1"}, "t"))
    stream = spark.readStream.format("rate").load().selectExpr("'k' as key", "'v' as value")
    with pytest.raises(Exception, match="kafka"):
        jobs.send(stream, {"bootstrap.servers": "h:1"}, "t", f"{folder}/cp", once=True, limit=10,
                  oversized=f"{folder}/large").awaitTermination()
    with pytest.raises(ValueError):
        jobs.send(stream, {"bootstrap.servers": "h:1"}, "t", f"{folder}/cp2", limit=10)


def test_every_record_is_sent_or_set_aside(spark, folder):
    rows = spark.createDataFrame([("k", "v" * n) for n in range(30)] + [("k", None)], "key string, value string")
    sent = []
    for _ in range(2):
        sent.clear()
        jobs.split_send(rows, 1024, f"{folder}/none", lambda x: sent.extend(x.collect()))
    small = [r for r in sent]
    jobs.split_send(rows, 20, f"{folder}/large", lambda x: sent.append(x.count()))
    assert len(small) == 31
    assert sent[-1] + spark.read.parquet(f"{folder}/large").count() == 31
