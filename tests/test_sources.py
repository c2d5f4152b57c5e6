import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.sampling import HashOrder, take
from ledgerlark.plans import exploration
from ledgerlark.plans.publishing import publish_rows
from ledgerlark.schema import RAW_CSV_COLUMNS, TRANSACTION_SCHEMA, raw_csv_schema
from ledgerlark.session import scratch_path, shared_folder
from ledgerlark.sources import files, messages
from ledgerlark.views import txn_raw

SF = "/root/testdata/sf0.001"
BROKER = {"bootstrap_servers": " a:1, b:2 ,", "topic": "train", "test_data": "test", "output_topic": "out"}


def test_source_options():
    bounded = messages.source_options(BROKER)
    assert bounded == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "train", "startingOffsets": "earliest",
                       "kafka.security.protocol": "PLAINTEXT"}
    stream = messages.source_options({**BROKER, "max_offsets": 500}, streaming=True)
    assert (stream["subscribe"], stream["startingOffsets"], stream["maxOffsetsPerTrigger"]) == ("test", "latest", "500")
    assert messages.sink_options(BROKER)["topic"] == "out"


def test_sasl_options(monkeypatch):
    config = {**BROKER, "security_protocol": "sasl_ssl", "username": "u", "password": "p"}
    options = messages.sink_options(config)
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"].endswith('required username="u" password="p";')
    monkeypatch.setenv("KAFKA_USERNAME", "from-env")
    assert 'username="from-env"' in messages.security_options({"security_protocol": "SASL_PLAINTEXT"})["kafka.sasl.jaas.config"]


@pytest.mark.parametrize("config", [{"topic": "t"}, {"bootstrap_servers": "a:1"}])
def test_incomplete_configuration(config):
    with pytest.raises(ValueError):
        messages.source_options(config)


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == configured
    assert scratch_path(spark, "x").startswith(configured + "/x-") and scratch_path(spark, "x") != scratch_path(spark, "x")


def payload(spark, **changes):
    row = {c: None for c in ["idx", *RAW_CSV_COLUMNS]} | {"trans_num": "t1", "idx": "3"} | changes
    df = spark.createDataFrame([tuple(row.values())], raw_csv_schema("idx")).withColumn("ordinal", F.lit(77).cast("bigint"))
    return messages.transaction_payload(df, "idx")


def test_payload_has_the_message_fields(spark):
    assert payload(spark).columns == TRANSACTION_SCHEMA.names


@pytest.mark.parametrize("idx, wanted", [("3", 3), ("0", 77), ("", 77), (None, 77), ("x", 77), ("2.9", 2)])
def test_record_id_falls_back_to_the_ordinal(spark, idx, wanted):
    assert payload(spark, idx=idx).first()["record_id"] == wanted


def test_rows_without_id_are_dropped(spark):
    assert payload(spark, trans_num="").count() == 0 and payload(spark, trans_num=None).count() == 0


def test_numbers_are_parsed(spark):
    row = payload(spark, amt="x", zip="123.9", unix_time="", lat="1.5").first()
    assert (row["amount"], row["zip"], row["unix_time"], row["lat"]) == (None, 123, None, 1.5)


def test_ordinals_are_dense(spark):
    df = messages.with_ordinal(spark.range(1000).repartition(7))
    assert sorted(r["ordinal"] for r in df.collect()) == list(range(1000))


def test_csv_keeps_blanks_quotes_and_missing(spark):
    path = scratch_path(spark, "csv")
    rows = [(" a ", 'q"uo,te', None, ""), ("é", "x", "y", "z")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    files.write_csv(df, path)
    got = [tuple(r) for r in files.read_csv(spark, path, df.schema).orderBy("a").collect()]
    assert got == [(" a ", 'q"uo,te', None, None), ("é", "x", "y", "z")]


def test_fallback(spark):
    full, other = spark.range(3), spark.range(5)
    assert files.read_with_fallback(lambda: full, lambda: other).count() == 3
    assert files.read_with_fallback(lambda: full.limit(0), lambda: other).count() == 5
    assert files.read_with_fallback(lambda: spark.read.parquet("/nowhere"), lambda: other).count() == 5
    missing = {"bootstrap_servers": "nowhere:1", "topic": "t"}    # no connector in this installation
    assert files.read_with_fallback(lambda: messages.read_messages(spark, missing), lambda: other).count() == 5


def test_envelope_round_trip(spark):
    config = {"path": scratch_path(spark, "topic")}
    df = spark.createDataFrame([("t1", None, 1.5)], "transaction_id string, gender string, amount double")
    messages.publish(messages.to_envelope(df, timestamp=F.lit(dt.datetime(2024, 1, 1))), config)
    row = messages.read_messages(spark, config).first()
    assert tuple(row) == ("t1", '{"transaction_id":"t1","gender":null,"amount":1.5}', dt.datetime(2024, 1, 1))


@pytest.mark.parametrize("limit, size", [(50, 50), (None, 1020)])
def test_publish_job(spark, limit, size):
    raw = txn_raw(spark, SF)
    path = scratch_path(spark, "csv")
    full = raw.select("idx", *[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in RAW_CSV_COLUMNS])
    files.write_csv(full, path)
    config = {"path": scratch_path(spark, "topic")}
    publish_rows(files.read_csv(spark, path, raw_csv_schema("idx")), config, limit, index="idx")
    published = messages.read_messages(spark, config)
    without_id = full.filter("trans_num = ''").count()
    assert size - without_id <= published.count() <= size
    assert published.filter("key is null").count() == 0


def test_exploration_report(spark):
    raw = txn_raw(spark, SF).withColumn("record_id", F.col("idx").cast("bigint"))
    tables = exploration.report(exploration.cleaned(raw))
    assert {name: t.count() > 0 for name, t in tables.items()} == dict.fromkeys(tables, True)
    assert tables["category_rates"].columns == ["category", "transactions", "fraud_cases", "fraud_rate"]


def test_reservoir_is_uniform(spark):
    """Every row is drawn about equally often over many seeds."""
    df = spark.range(100).cache()
    hits = sum((take(df, 30, HashOrder("id", seed)).select(F.collect_set("id")).first()[0] for seed in range(12)), [])
    assert len(hits) == 360 and len(set(hits)) > 90


# --- untidy files and failing sources ---------------------------------------------------------

def _csv(tmp_path, name, *lines):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    schema = raw_csv_schema()
    plain = _csv(tmp_path, "plain.csv", "trans_num,amt,merchant", "t1,2.5,m", "t2,,n")
    indexed = _csv(tmp_path, "indexed.csv", ",trans_num,amt,merchant", "0,t1,2.5,m", "1,t2,,n")
    moved = _csv(tmp_path, "moved.csv", "merchant,extra,amt,trans_num", "m,x,2.5,t1", "n,y,,t2")
    wanted = [("t1", "2.5", "m"), ("t2", None, "n")]
    for path in (plain, indexed, moved):
        rows = files.read_csv(spark, path, schema)
        assert sorted(tuple(r) for r in rows.select("trans_num", "amt", "merchant").collect()) == wanted
        assert set(rows.columns) == {"trans_num", "amt", "merchant"}
    with pytest.raises(ValueError, match="none of the columns"):
        files.read_csv(spark, _csv(tmp_path, "other.csv", "a,b", "1,2"), schema)


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    _csv(tmp_path, "a.csv", "trans_num,amt", "t1,1")
    _csv(tmp_path, "b.csv", "amt,trans_num", "2,t2")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), raw_csv_schema()).collect()


def test_any_connector_failure_falls_back(spark):
    other = spark.range(3)

    def java_failure():
        return spark._jvm.java.lang.Integer.parseInt("no number")

    def missing_folder():
        return spark.read.parquet("/no/such/folder")

    for broken in (java_failure, missing_folder, lambda: spark.range(0)):
        assert files.read_with_fallback(broken, lambda: other).count() == 3
    with pytest.raises(ValueError):       # a wrong configuration is not hidden
        files.read_with_fallback(lambda: messages.source_options({}), lambda: other)


def test_credentials_are_escaped():
    options = messages.security_options({"security_protocol": "SASL_SSL", "username": 'a"b', "password": "c\\d"})
    assert options["kafka.sasl.jaas.config"].endswith('required username="a\\"b" password="c\\\\d";')


def test_everything_is_published_without_a_limit(spark, tmp_path):
    raw = txn_raw(spark, SF).withColumnRenamed("idx", "index")
    ids = raw.filter("trans_num <> ''").count()
    for limit, size in ((None, ids), (7, None)):
        folder = str(tmp_path / f"topic{limit}")
        sent = publish_rows(raw, {"path": folder}, limit, index="index")
        read = messages.read_messages(spark, {"path": folder})
        assert read.count() == sent.count() and (read.count() == size if size else read.count() <= 7)
