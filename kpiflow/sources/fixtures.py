"""Test-fixture envelope derived from the driver's ``events`` table.

The driver ships TPC-H-like tables plus an ``events`` table; this module turns
``events`` into what the pipeline consumes in production: a Kafka-style
envelope ``(source_name, key, value, timestamp, partition, offset)`` whose
``value`` is a JSON click or order, including the injected faults, replays and
late rows described in FIXTURES.md. Everything is a Spark plan over the
input, so the fixture grows with the table.

Offsets are increasing and contiguous per (source, partition) like Kafka's.
They are assigned without a single-task sort of a whole partition: an
ordered scan over range partitions (``kpiflow.plans.ordered``) splits even a
hot topic partition into balanced contiguous ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiflow.session import checkpoint_root, ensure_utc

# Fixed values of the fixture definition (FIXTURES.md section 2), in order.
CHANNEL_BY_K = [(28, "organic"), (52, "paid_search"), (68, "social"), (82, "email"), (92, "affiliate")]
CHANNEL_ELSE = "direct"
REFERRERS = [
    None,
    "https://www.Google.com/s",
    "https://bing.com",
    "https://m.facebook.com/ad",
    "https://partner.example.com",
]
REFERRER_WITH_CHANNEL = "https://ref.example.com"
DEVICES = ["mobile", "desktop", "tablet"]
COUNTRIES = ["US", "IN", "GB", "DE", "AU", "SG"]
PAYMENT_METHODS = ["card", "wallet", "upi", "paypal"]
CATEGORIES = ["apparel", "electronics", "home", "beauty", "sports"]
STATUS_BY_K = [(18, "authorized"), (90, "captured"), (95, "declined")]
STATUS_ELSE = "refunded"

DENSE_T0_MICROS = 1704067200000000  # 2024-01-01 00:00:00 UTC
DENSE_FACTOR = 144  # 30 days -> 5 hours
BAD_EVENT_TIME = "2024-13-01"
VERSION_BY_FAULT = {
    "bad_type": '"x"', "version_text": '"1"', "version_fraction": "1.5", "version_boolean": "true", "key_twice": '"x","schema_version":1',
}

PROFILES = ("sparse", "dense", "resent")  # resent: dense, and ids that come again with another payload
RESENT_AFTER = "INTERVAL 2 HOURS"


def _pick(index: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _bands(x: Column, bands: list[tuple[int, str]], otherwise: str) -> Column:
    expr = None
    for upper, name in bands:
        expr = F.when(x < upper, F.lit(name)) if expr is None else expr.when(x < upper, F.lit(name))
    return expr.otherwise(F.lit(otherwise))


def _lpad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_rows(events: DataFrame, profile: str = "dense", keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per driver event with all derived fields (no JSON yet), and the columns ``keep`` as they are."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    m = F.col("event_id")
    u = F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    if profile != "sparse":
        micros = F.lit(DENSE_T0_MICROS) + F.floor((F.unix_micros(ts) - F.lit(DENSE_T0_MICROS)) / DENSE_FACTOR)
        etime = F.timestamp_micros(micros.cast("long"))
    else:
        etime = ts
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    raw_channel = (
        F.when(m % 10 == 3, F.lit(None).cast("string"))
        .when(m % 10 == 4, F.lit(""))
        .otherwise(_bands(k, CHANNEL_BY_K, CHANNEL_ELSE))
    )
    blank_channel = raw_channel.isNull() | (raw_channel == "")
    ev_type = (
        F.when(m % 97 == 0, F.lit("unknown_evt"))
        .when(F.col("event_type") == "view", F.when(m % 2 == 0, "page_view").otherwise("product_view"))
        .when(F.col("event_type") == "click", F.when(m % 3 == 0, "add_to_cart").otherwise("search"))
        .when(F.col("event_type") == "signup", F.lit("checkout_started"))
        .when(F.col("event_type") == "error", F.lit("ad_click"))
    )
    is_order = F.col("event_type") == "purchase"
    return events.select(
        m.alias("m"),
        k.alias("k"),
        F.when(is_order, F.lit("orders")).otherwise(F.lit("clickstream")).alias("source_name"),
        F.when(is_order, F.concat(F.lit("ord_"), _lpad(m, 10)))
        .otherwise(F.concat(F.lit("evt_"), _lpad(m, 10)))
        .alias("id"),
        etime.alias("etime"),
        F.concat(F.lit("sess_"), _lpad(u, 6), F.lit("_"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        F.concat(F.lit("usr_"), _lpad(u, 6)).alias("user_id"),
        ev_type.alias("event_type"),
        raw_channel.alias("channel"),
        F.when(blank_channel, _pick(F.floor(m / 10) % 5, REFERRERS))
        .otherwise(F.lit(REFERRER_WITH_CHANNEL))
        .alias("referrer"),
        F.when(blank_channel | (raw_channel == CHANNEL_ELSE), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("cmp_"), (F.lit(1000) + u % 20).cast("string")))
        .alias("campaign_id"),
        F.when(m % 101 == 0, F.lit(None).cast("string")).otherwise(_pick(k % 3, DEVICES)).alias("device_type"),
        _pick(m % 6, COUNTRIES).alias("country_code"),
        F.concat(F.lit("https://shop.example.com/p/"), k.cast("string")).alias("page_url"),
        F.concat(F.lit("prd_"), _lpad(k, 4)).alias("product_id"),
        _pick(k % 5, CATEGORIES).alias("category"),
        _bands(k, STATUS_BY_K, STATUS_ELSE).alias("status"),
        _pick(k % 4, PAYMENT_METHODS).alias("payment_method"),
        F.col("value").alias("order_value"),
        (F.lit(1) + m % 5).cast("int").alias("items_count"),
        (k / 100.0).alias("fraud_score"),
        (u % F.when(is_order, F.lit(12)).otherwise(F.lit(24))).cast("int").alias("partition"),
        *keep,
    )


def _fault(m: Column) -> Column:
    """Injected fault kind; first matching rule wins."""
    return (
        F.when(m % 25 == 0, F.lit("truncated"))
        .when(m % 500 == 41, F.lit("blank"))
        .when(m % 25 == 12, F.lit("null_id"))
        .when(m % 200 == 31, F.lit("bad_time"))
        .when(m % 200 == 57, F.lit("bad_type"))
        .when(m % 200 == 83, F.lit("version_text"))
        .when(m % 200 == 107, F.lit("version_fraction"))
        .when(m % 200 == 133, F.lit("version_boolean"))
        .when(m % 200 == 157, F.lit("id_number"))
        .when(m % 200 == 181, F.lit("user_object"))
        .when(m % 200 == 71, F.lit("leading_space"))
        .when(m % 200 == 95, F.lit("key_twice"))
        .otherwise(F.lit("none"))
    )


def _drop_last_char(text: Column) -> Column:
    return text.substr(F.lit(1), F.length(text) - 1)


def _json_body(fault: Column) -> Column:
    """JSON text of the click or order, without schema_version."""
    id_value = F.when(fault == "null_id", F.lit(None).cast("string")).otherwise(F.col("id"))
    time_text = F.when(fault == "bad_time", F.lit(BAD_EVENT_TIME)).otherwise(
        F.date_format(F.col("etime"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    click = F.struct(
        id_value.alias("event_id"), time_text.alias("event_time"), "event_type", "session_id", "user_id",
        "page_url", "product_id", "category", "campaign_id", "channel", "device_type", "country_code", "referrer",
    )
    order = F.struct(
        id_value.alias("order_id"), time_text.alias("event_time"), "session_id", "user_id", "status",
        "payment_method", F.lit("USD").alias("currency"), "order_value", "items_count", "fraud_score",
        F.col("country_code").alias("shipping_country"),
    )
    body = F.when(F.col("source_name") == "orders", F.to_json(order)).otherwise(F.to_json(click))
    quoted = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    return (
        F.when(fault == "id_number", F.replace(body, quoted("id"), F.col("m").cast("string")))
        .when(fault == "user_object", F.replace(body, quoted("user_id"), F.lit('{"name":"x"}')))
        .otherwise(body)
    )


def _with_version(body: Column, fault: Column) -> Column:
    """Splice schema_version into the object text, so that a row can carry a
    wrong-typed value, or the key twice (the last value counts)."""
    version = F.coalesce(*[F.when(fault == k, F.lit(v)) for k, v in VERSION_BY_FAULT.items()], F.lit("1"))
    return F.concat(_drop_last_char(body), F.lit(',"schema_version":'), version, F.lit("}"))


def _payload_text(full: Column, fault: Column) -> Column:
    """Apply the transport faults: a truncated object, or a blank payload."""
    return (
        F.when(fault == "truncated", _drop_last_char(full))
        .when(fault == "blank", F.lit(""))
        .when(fault == "leading_space", F.concat(F.lit("\n\t "), full))
        .otherwise(full)
    )


def _moved_time(etime: Column) -> Column:
    return F.when(F.col("moved"), etime + F.expr(RESENT_AFTER)).otherwise(etime)


def envelope(events: DataFrame, profile: str = "dense") -> DataFrame:
    """Kafka-style envelope of both topics, with replays, delays and faults.

    What is sent when, and its offset, is settled on the bare events; the JSON texts are made behind the shuffle.
    """
    m = F.col("m")
    fault = F.col("fault")
    bare = events.select(F.struct("event_id", "user_id", "ts", "event_type", "value", "props").alias("_event"))
    rows = event_rows(bare.select("_event", "_event.*"), profile, ("_event",)).select("_event", "m", "etime", "source_name", "partition", _fault(m).alias("fault"))
    # m % 60 == 37: the producer sends the id again two hours later, at another event time and with another status
    moved = (m % 60 == 37) & (fault == "none") if profile == "resent" else F.lit(False)
    rows = rows.withColumn("moved", F.explode(F.when(moved, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    # m % 50 == 9: the producer re-sends the row 300 s later (identical payload).
    replay = F.explode(F.when(F.col("moved"), F.array(F.lit(2))).when(m % 50 == 9, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    delay_s = (m % 120) + F.when(F.col("replay") == 1, F.lit(300)).otherwise(F.lit(0)) + F.when(m % 300 == 77, F.lit(7200)).otherwise(F.lit(0))
    sent = rows.withColumn("replay", replay).withColumn(
        "timestamp", F.timestamp_micros(F.unix_micros(_moved_time(F.col("etime"))) + delay_s * 1_000_000)
    )
    placed = assign_offsets(sent.select("_event", "source_name", "m", "partition", "moved", "replay", "timestamp"))
    carried = ("moved", "replay", "timestamp", "offset")
    staged = (
        event_rows(placed.select("_event.*", *carried), profile, carried)
        .withColumn("fault", _fault(m))
        .withColumn("etime", _moved_time(F.col("etime")))
        .withColumn("status", F.when(~F.col("moved"), F.col("status")).when(F.col("status") == "captured", "refunded").otherwise("captured"))
        .withColumn("_body", _json_body(fault))
        .withColumn("_full", _with_version(F.col("_body"), fault))
    )
    return staged.select(
        "source_name", F.col("session_id").alias("key"), _payload_text(F.col("_full"), fault).alias("value"),
        "timestamp", "partition", "offset", "m", "replay",
    )


def assign_offsets(sent: DataFrame) -> DataFrame:
    """Contiguous per-(source, partition) offsets in arrival order
    (timestamp, m, replay), by a range-partitioned ordered scan."""
    from kpiflow.plans.ordered import ordered_scan

    scanned = ordered_scan(sent, ["source_name", "partition"], ["timestamp", "m", "replay"])
    return scanned.withColumnRenamed("_pos", "offset")


FIXTURE_VERSION = "v5"


def _fingerprint(spark: SparkSession, sf_dir: str, profile: str) -> str:
    """Identity of a materialised envelope: the code that derives it, input
    path, size and mtime, profile. A code change never reuses a stale table."""
    import hashlib

    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    st = fs.getFileStatus(jvm_path)
    import os

    code = hashlib.sha1()
    here = os.path.dirname(os.path.abspath(__file__))
    for rel in ("fixtures.py", os.path.join("..", "plans", "ordered.py")):
        with open(os.path.join(here, rel), "rb") as fh:
            code.update(fh.read())
    key = (
        f"{FIXTURE_VERSION}|{code.hexdigest()}|{st.getPath().toString()}|{st.getLen()}|"
        f"{st.getModificationTime()}|{profile}"
    )
    return hashlib.sha1(key.encode()).hexdigest()[:16]


def envelope_path(spark: SparkSession, sf_dir: str, profile: str = "dense") -> str:
    """Materialise the envelope once as parquet under the shared checkpoint
    folder (partitioned by topic) and return its path.

    This is the landing table the pipeline reads -- the batch stand-in for
    the Kafka topics. Writing it once cuts the derivation's lineage, so every
    query plans against a plain parquet scan with partition pruning on
    ``source_name`` and pushed filters. A finished table has ``_SUCCESS``;
    builders write to private folders and rename into place.
    """
    ensure_utc(spark)
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/kpiflow-envelope/{_fingerprint(spark, sf_dir, profile)}"
    jvm = spark._jvm.org.apache.hadoop.fs
    done = jvm.Path(f"{path}/_SUCCESS")
    fs = done.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(done):
        # Each builder writes its own folder and renames it into place, so two
        # concurrent builders never overwrite each other; the loser drops its copy.
        import uuid

        tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
        env = envelope(load_events(spark, sf_dir), profile)
        # No repartition on (source, partition): 36 keys would mean 36 writer
        # tasks. Each task writes its own rows, sorted by arrival time so the
        # row-group statistics prune time-range reads; by topic first, as the
        # partitioned write would else sort once more.
        env.sortWithinPartitions("source_name", "timestamp").write.mode("overwrite").partitionBy("source_name").parquet(tmp)
        if fs.exists(jvm.Path(path)) and not fs.exists(done):
            fs.delete(jvm.Path(path), True)  # leftover of an interrupted build
        if not fs.rename(jvm.Path(tmp), jvm.Path(path)):
            fs.delete(jvm.Path(tmp), True)
    return path


def raw_stream_table(spark: SparkSession, sf_dir: str, profile: str = "dense") -> DataFrame:
    """Envelope of both topics (batch), read from its materialised table."""
    return spark.read.parquet(envelope_path(spark, sf_dir, profile))


def topic(env: DataFrame, source_name: str) -> DataFrame:
    """The Kafka-record columns of one topic, as the Kafka source yields them."""
    return env.filter(F.col("source_name") == source_name).select(
        "key", "value", "timestamp", "partition", "offset"
    )
