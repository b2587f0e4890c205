"""Clickstream messages derived from the given ``events`` table.

The table has neither JSON documents nor NULLs, so both are derived from its columns,
row by row and without a shuffle: the work of every query grows with the table.
``ORACLE_EVENTS`` in ``oracles.py`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "user-keyed-clickstream"
AGENT = "Mozilla/5.0"
TEST_AGENT = "Mozilla/5.0 LoadTest"
EPOCH_MS = 1704067200000
CLOCK_FACTOR = 2000

EVENT_IDS = {"signup": 3506, "view": 301, "click": 303, "purchase": 2649}
OTHER_EVENT_ID = 2650
UNCOUNTED_EVENT_ID = 312

# One entry per residue; None leaves the field out of the document.
SRC_IDS = (1, 96, 141, 3, 95, 2, 148, 149, 150, 4, 6, 12, 209, 163, None, None, None)
SRCS = (11, 12, 13, 4, 6, 104, 106, 112, 100, 211, None)
APPS = (0, 1, 3, 17, 18, 23, None, None)


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(values, index: Column) -> Column:
    literal = F.array(*[F.lit(v).cast("int") for v in values])
    return F.element_at(literal, (index + 1).cast("int"))


def micros() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def seconds_text() -> Column:
    """Epoch seconds with six decimals, as they are written in the documents."""
    rest = F.lpad((micros() % 1000000).cast("string"), 6, "0")
    return F.concat(F.floor(micros() / 1000000).cast("string"), F.lit("."), rest)


def counted_eid() -> Column:
    kind = F.col("event_type")
    eid = F
    for name, value in EVENT_IDS.items():
        eid = eid.when(kind == name, value)
    return eid.otherwise(OTHER_EVENT_ID).cast("int")


def event_fields() -> dict[str, Column]:
    """Typed payload fields of each event; NULL means absent."""
    number = F.col("event_id")
    return {
        "uuid": F.concat(F.lit("c-"), F.col("user_id").cast("string")),
        "eid": F.when(number % 11 == 0, UNCOUNTED_EVENT_ID).otherwise(counted_eid()),
        "uid": F.when(number % 3 == 0, 0).otherwise(F.col("user_id")).cast("int"),
        "dt": F.when(number % 5 != 0, F.floor(micros() / 1000000)).cast("int"),
        "dtm": F.when(number % 4 != 0, seconds_text()),
        "src_id": _pick(SRC_IDS, number % 17),
        "src": _pick(SRCS, F.floor(number / 17) % 11),
        "app": _pick(APPS, F.floor(number / 7) % 8),
        "ua": F.when(number % 7 == 0, F.lit(None).cast("string"))
        .when(number % 10 == 0, TEST_AGENT)
        .otherwise(AGENT),
        "cid": (number % 1000).cast("int"),
        "params": F.col("props"),
    }


def row_key() -> Column:
    number = F.col("event_id")
    return (
        F.when(number % 89 == 0, F.lit(None).cast("string"))
        .when(number % 97 == 0, F.lit(""))
        .otherwise(F.col("user_id").cast("string"))
    )


def envelope(events: DataFrame, value: Column, key: Column) -> DataFrame:
    """Four topic partitions by user; the event number is the (sparse) offset."""
    return events.select(
        key.alias("key"),
        value.alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(micros()).alias("timestamp"),
    )


def document() -> Column:
    """JSON text of an event; ``dtm`` is spelled with six decimals."""
    fields = event_fields()
    fields["dtm"] = fields["dtm"].cast("decimal(20,6)")
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message stream all queries start from."""
    return clickstream_rows(events_table(spark, sf_dir))


def clickstream_rows(events: DataFrame) -> DataFrame:
    return envelope(events, document(), row_key())


def compressed_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all users squeezed in time, so that windows hold several of them."""
    return compressed_clock_rows(events_table(spark, sf_dir))


def compressed_clock_rows(events: DataFrame) -> DataFrame:
    millis = F.floor(micros() / 1000)
    squeezed = EPOCH_MS + F.floor((millis - EPOCH_MS) / CLOCK_FACTOR)
    return events.select(
        F.col("user_id").cast("string").alias("rowkey"),
        counted_eid().alias("eid"),
        event_fields()["uid"].alias("uid"),
        squeezed.cast("bigint").alias("_server_time"),
        F.lit(0).cast("bigint").alias("_ua_is_test"),
        F.col("event_id").alias("offset"),
    )


def messy_document() -> Column:
    """Payloads in every state a schemaless topic can be in, by event number."""
    number = F.col("event_id")
    user = F.col("user_id").cast("string")
    good = document()
    case = number % 16
    return (
        F.when(case == 0, F.concat(F.lit('{"uid":'), user, F.lit(', "eid"')))
        .when(case == 1, F.concat(F.lit("[1, "), user, F.lit("]")))
        .when(case == 2, F.lit(None).cast("string"))
        .when(case == 3, F.lit("{}"))
        .when(case == 4, F.concat(F.lit('{"uid":"'), user, F.lit('","eid":"bad","ua":"null"}')))
        .when(case == 5, F.concat(F.lit('{"uid":'), user, F.lit('.0,"eid":3000000000,"ua":""}')))
        .when(case == 6, F.concat(F.lit('{"eid":5,"eid":6,"EID":7,"Uid":'), user, F.lit("}")))
        .when(case == 7, F.concat(F.lit('{"uid":'), user, F.lit(',"uid":null,"eid":""}')))
        .when(case == 8, F.concat(F.lit('{"a":tru,"uid":'), user, F.lit("}")))
        .when(case == 9, F.concat(F.lit('{"o":{"uid":1,"b":[1,2]},"uid":'), user, F.lit(',"ua":"a\\tb\\/\\u0430"}')))
        .otherwise(good)
    )


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(events_table(spark, sf_dir), messy_document(), row_key())


def spelled_document() -> Column:
    """Escapes, blanks, repeated and nested keys, and numbers that can be written in several ways."""
    user = F.col("user_id").cast("string")
    return F.concat(
        F.lit('{"uid":'), user, F.lit('.50, "o" : {"uid":'), user,
        F.lit('.5, "b":[1,  {"c":"]}"}]},\n"s":"a\\tb\\/'), F.col("event_type"),
        F.lit('\\u0430\\"","p":"{\\"uid\\": 1.0}","params":'), F.col("props"),
        F.lit(',"uid":'), user, F.lit('.500 ,"uid":null}'),
    )


def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(events_table(spark, sf_dir), spelled_document(), row_key())


def odd_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with what producers leave behind the last brace, by event number."""
    return odd_ends_rows(events_table(spark, sf_dir))


def odd_ends_rows(events: DataFrame) -> DataFrame:
    case = F.col("event_id") % 6
    ends = (
        F.when(case == 0, "\n")
        .when(case == 1, "\r\n")
        .when(case == 2, "\t")
        .when(case == 3, '{"second":1}')
        .when(case == 4, " \n\r\n ")
        .otherwise("")
    )
    return envelope(events, F.concat(document(), ends), row_key())


def untimely(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some documents with times that no timestamp, or no BIGINT, can hold."""
    case = F.col("event_id") % 50
    value = (
        F.when(case == 0, '{"eid":301,"uid":1,"dtm":9.0e15,"ua":"x"}')
        .when(case == 1, '{"eid":301,"uid":1,"dtm":1e300,"ua":"x"}')
        .otherwise(document())
    )
    return envelope(events_table(spark, sf_dir), value, row_key())


def odd_number_text() -> Column:
    """Number-like text in the shapes the coercion rules tell apart."""
    number = F.col("event_id")
    user = F.col("user_id").cast("string")
    return (
        F.when(number % 12 == 0, user)
        .when(number % 12 == 1, F.concat(F.lit("  -"), user))
        .when(number % 12 == 2, F.concat(user, F.lit("xyz")))
        .when(number % 12 == 3, F.concat(user, F.lit(".75")))
        .when(number % 12 == 4, F.lit("true"))
        .when(number % 12 == 5, F.lit("on"))
        .when(number % 12 == 6, F.lit("garbage"))
        .when(number % 12 == 7, F.concat(user, F.lit("00000000000")))
        .when(number % 12 == 8, F.concat(user, F.lit("9999999999999999999999")))
        .when(number % 12 == 9, F.concat(F.lit("-9"), F.lpad(user, 20, "9")))
        .when(number % 12 == 10, F.concat(user, F.lit("e3")))
        .otherwise(F.concat(F.lit("+00"), user, F.lit(".5e1z")))
    )
