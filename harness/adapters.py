"""The two sources, as RAW rows made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.timefn import ISO_MICROS, NTZ
from millrace.operators.clean import clean_full
from millrace.session import adopt, spread
from millrace.specs import API_A, API_B, RAW_SCHEMA

AS_OF = "2024-01-31 04:00:00"

# Where the upsert queries split their input into an old and a new part.
SPLIT_A, SPLIT_B = "2024-01-16 00:00:00", "1998-06-01 00:00:00"

RAW_COLUMNS = [*RAW_SCHEMA.fieldNames(), "ordinal"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adopt(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(c: Column | str) -> Column:
    return F.date_format(c, ISO_MICROS)


def json_text(**fields: Column) -> Column:
    """JSON text with null fields kept."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def file_name(source: str, ts: Column, batch_id: Column) -> Column:
    day = F.date_format(ts, "yyyy-MM-dd")
    head = F.concat(F.lit(f"source={source}/dt="), day, F.lit("/hour="), F.date_format(ts, "HH"))
    return F.concat(head, F.lit("/batch_id="), batch_id, F.lit("/part-0001.jsonl"))


def event_id_text() -> Column:
    return F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("event_type"))


def json_a(with_nulls: bool = False, **more: Column) -> Column:
    key, updated = event_id_text(), F.col("ts")
    if with_nulls:
        key = F.when(F.col("event_id") % 101 != 0, key)
        updated = F.when(F.col("event_id") % 103 != 0, updated)
    category = F.concat(F.lit("k"), F.get_json_object("props", "$.k"))
    return json_text(
        id=key,
        created_at=stamp("ts"),
        updated_at=stamp(updated),
        name=F.concat("event_type", F.lit(" "), F.col("user_id").cast("string")),
        status=F.element_at(F.array(F.lit("new"), F.lit("active"), F.lit("closed")), (F.col("event_id") % 3 + 1).cast("int")),
        type=F.col("event_type"),
        value=F.col("value"),
        description=F.lit(None).cast("string"),
        metadata=F.struct(category.alias("category"), F.array("event_type").alias("tags")),
        **more,
    )


def raw_a(spark: SparkSession, sf_dir: str, with_nulls: bool = False, **more: Column) -> DataFrame:
    """Events as RAW rows of source A; text is parsed so that the payload is a real VARIANT."""
    batch = F.date_format("ts", "yyyyMMdd")
    minutes = (F.col("event_id") % 97).cast("int")
    rows = spread(table(spark, sf_dir, "events")).select(
        F.parse_json(json_a(with_nulls, **more)).alias("payload"),
        F.lit("api_a").alias("source"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)).alias("ingested_at"),
        batch.alias("batch_id"),
        file_name("api_a", F.date_trunc("day", "ts"), batch).alias("file_name"),
        F.col("event_id").alias("ordinal"),
    )
    return rows.withColumn("ingested_at", F.col("ingested_at").cast(NTZ))


def orders_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "orders")).join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")
    )


def json_b(key: str) -> Column:
    return json_text(
        id=F.col(key).cast("string"),
        created_at=stamp("o_orderdate"),
        modified_at=stamp("o_orderdate"),
        title=F.concat(F.lit("order "), F.col("o_orderkey").cast("string")),
        state=F.col("o_orderstatus"),
        priority=F.col("o_orderpriority"),
        amount=F.col("o_totalprice"),
        notes=F.lit(None).cast("string"),
        user_id=F.col("o_custkey"),
        user_name=F.col("c_name"),
    )


def raw_b(spark: SparkSession, sf_dir: str, key: str = "o_orderkey") -> DataFrame:
    """Orders as RAW rows of source B, one key per order or per customer."""
    batch = F.date_format("o_orderdate", "yyyyMM")
    minutes = (F.col("o_orderkey") % 97).cast("int")
    rows = orders_b(spark, sf_dir).select(
        F.parse_json(json_b(key)).alias("payload"),
        F.lit("api_b").alias("source"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)).alias("ingested_at"),
        batch.alias("batch_id"),
        file_name("api_b", F.col("o_orderdate"), batch).alias("file_name"),
        F.col("o_orderkey").alias("ordinal"),
    )
    return rows.withColumn("ingested_at", F.col("ingested_at").cast(NTZ))


def clean_a(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    return clean_full(raw_a(spark, sf_dir, with_nulls), API_A, AS_OF, tie_break=["ordinal"])


def clean_b(spark: SparkSession, sf_dir: str, key: str = "o_orderkey") -> DataFrame:
    return clean_full(raw_b(spark, sf_dir, key), API_B, AS_OF, tie_break=["ordinal"])


def split_raw(raw: DataFrame, clock: str, at: str) -> tuple[DataFrame, DataFrame]:
    """The rows before a moment, and the rest together with every seventh old row."""
    ts, moment = F.variant_get(F.col("payload"), f"$.{clock}", NTZ), F.lit(at).cast(NTZ)
    return raw.where(ts < moment), raw.where((ts >= moment) | (F.col("ordinal") % 7 == 0))


def messy_a() -> Column:
    """JSON text of an event as a careless service would send it: odd keys, blanks, mixed timestamps,
    and ids that are missing, null or blank."""
    n, ts = F.col("event_id"), F.col("ts")
    ident = (
        F.when(n % 11 == 0, F.lit(""))
        .when(n % 13 == 0, F.lit('"id": null, '))
        .when(n % 17 == 0, F.lit('"id": "   ", '))
        .otherwise(F.concat(F.lit('"id": "  '), event_id_text(), F.lit(' \\t", ')))
    )
    updated = (
        F.when(n % 5 == 0, F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('"')))
        .when(n % 5 == 1, F.concat(F.lit('"'), stamp(ts), F.lit('"')))
        .when(n % 5 == 2, F.unix_millis(ts.cast("timestamp")).cast("string"))
        .when(n % 5 == 3, F.concat(F.lit('"'), F.date_format(ts, "dd/MM/yyyy HH:mm:ss"), F.lit('"')))
        .otherwise(F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit('+05:00"')))
    )
    return F.concat(
        F.lit("{"),
        ident,
        F.lit('"createdAt": "'), stamp(ts),
        F.lit('", "updatedAt": '), updated,
        F.lit(', "User Name": " user '), F.col("user_id").cast("string"),
        F.lit('\\u00a0", "eventType": "'), F.col("event_type"),
        F.lit('", "metaData": {"Category-Name": " k'), F.get_json_object("props", "$.k"),
        F.lit('", "tag-list": [" raw ", {"subKey": " x "}]}}'),
    )


def messy_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("ordinal"), F.parse_json(messy_a()).alias("payload")
    )


def messy_b_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with several versions per customer, ids as numbers."""
    text = json_text(
        id=F.when(F.col("o_orderkey") % 19 != 0, F.col("o_custkey")),
        createdAt=stamp("o_orderdate"),
        modifiedAt=F.date_format("o_orderdate", "yyyy-MM-dd"),
        orderState=F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(" ")),
        amount=F.col("o_orderkey"),
    )
    return spread(table(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("ordinal"), F.parse_json(text).alias("payload"))
