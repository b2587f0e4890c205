import json

import pytest
from pyspark.sql import functions as F

from clickweir.functions import decisions
from clickweir.functions.coerce import coerce, stored_type
from clickweir.functions.document import (
    extend_document,
    number_spelling,
    written_entries,
    reject_reason,
    spelled_key,
)
from clickweir.functions.hashing import text_hash, text_hash_items
from clickweir.functions.ratios import guarded_ratio
from clickweir.functions.text import null_text

# Hashes of known texts.
VECTORS = {
    "": 195321900366845229,
    "a": 1439324057017381289,
    "null": 5699503050587130552,
    "301": 910769884103692187,
    "12345678": 911314015007758152,
    "click": 6993569301288442139,
    "view": 3612586576291976916,
    "signup": 9055038000819401138,
    "purchase": 4932759319506051223,
    "error": 5296819192946049186,
    "abcdefghijklmnopqrstuvwx": 2692232983804279078,
    "abcdefghijklmnopqrstuvwxyz0123": 3422718438474135893,
}

U64 = 2**64


def read(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column.alias("r")).collect()]


def test_null_text(spark):
    texts = ["", "null", None, "0", " ", "NULL"]
    assert read(spark, texts, null_text(F.col("x"))) == [None, None, None, "0", " ", "NULL"]


COERCIONS = [
    ("bigint", "strict", ["7", " 7 ", "7.0", "x", "", None], [7, 7, None, None, None, None]),
    ("int", "strict", ["3000000000", "-5", "1e3"], [None, -5, None]),
    ("int", "number", ["1.0", "1.9", "-1.9", "3000000000", "1.7e3", "true"],
     [1, 1, -1, None, 1700, None]),
    ("uint8", "strict", ["0", "255", "256", "-1"], [0, 255, None, None]),
    ("uint64", "strict", [str(U64 - 1), str(U64), "-1"], [U64 - 1, None, None]),
    ("boolean", "strict", ["true", "false", "maybe"], [True, False, None]),
    ("date", "strict", ["2024-02-29", "2023-02-29"], ["2024-02-29", None]),
    ("decimal(6,2)", "strict", ["12.345", "99999", "x"], ["12.35", None, None]),
    ("int64", "prefix", ["12abc", "-12abc", "abc", "  +7", "9" * 25, "-" + "9" * 25, "", None],
     [12, -12, 0, 7, 2**63 - 1, -(2**63), 0, None]),
    ("int32", "prefix", ["4294967297", "2147483648", "-2147483649", "9" * 25],
     [1, -(2**31), 2**31 - 1, -1]),
    ("uint8", "prefix", ["300", "-1", "256", "12x"], [44, 255, 0, 12]),
    ("uint32", "prefix", ["4294967297", "-1", "9" * 25], [1, 2**32 - 1, 2**32 - 1]),
    ("uint64", "prefix", ["-1", str(U64 - 1), str(U64), "-" + "9" * 25],
     [U64 - 1, U64 - 1, U64 - 1, U64 - 1]),
    ("double", "prefix", ["1.5abc", "abc", ".5", "-1e2x", "1e", "inf", "5."],
     [1.5, 0.0, 0.5, -100.0, 1.0, float("inf"), 5.0]),
    ("float", "prefix", ["0.1", "x"], [pytest.approx(0.1, rel=1e-6), 0.0]),
    ("boolean", "prefix", ["true", "t", "tru", "T", "1", "false"],
     [True, True, True, False, False, False]),
    ("uint8", "append", ["true", "t", "on", "yes", "0", "True", "7"], [1, 1, 1, 0, 0, 0, 7]),
    ("int64", "append", ["on", "off", "-3"], [1, 0, -3]),
    ("string", "append", ["true", " x "], ["true", " x "]),
    ("struct<a:int,b:array<int>>", "strict", ['{"a":1,"b":[2]}', None], [(1, [2]), None]),
    ("time", "strict", ["12:34:56", "noon", None], ["12:34:56", None, None]),
    ("int[]", "prefix", ["[1, 2, 3]", "x"], [[1, 2, 3], None]),
]


@pytest.mark.parametrize("kind, mode, texts, expected", COERCIONS)
def test_coerce(spark, kind, mode, texts, expected):
    column = coerce(F.col("x"), kind, mode)
    found = read(spark, texts, column)
    if kind == "date" or kind.startswith("decimal"):
        found = [None if v is None else str(v) for v in found]
    assert found == expected


def test_coerce_names():
    assert stored_type("UInt32") == "bigint"
    assert stored_type("float[]") == "array<float>"
    assert stored_type("numeric(10,2)") == "decimal(10,2)"
    assert stored_type("varchar(20)") == "string"
    with pytest.raises(ValueError):
        coerce(F.col, "int", "loose")


def test_compat_hash_vectors(spark):
    texts = list(VECTORS) + [None]
    assert read(spark, texts, text_hash(F.col("x"), "compat")) == [*VECTORS.values(), None]


def test_compat_hash_of_array_items(spark):
    rows = spark.createDataFrame([(["a", None, "click"],), (None,), ([],)], "x array<string>")
    found = rows.select(text_hash_items(F.col("x"), "compat")).collect()
    assert [r[0] for r in found] == [[VECTORS["a"], None, VECTORS["click"]], None, []]


def reference_hash(data: bytes) -> int:
    """The same hash, one value at a time with plain integers."""
    mask = U64 - 1
    words = [200, 200, -7046029254386353133 & mask]

    def mix():
        for step, shift in enumerate((43, -9, 8, 38, -23, 5, 35, -49, 11, 12, -18, 22)):
            x, y, z = step % 3, (step + 1) % 3, (step + 2) % 3
            moved = words[z] >> shift if shift > 0 else words[z] << -shift & mask
            words[x] = (words[x] - words[y] - words[z] & mask) ^ moved

    whole = len(data) // 24 * 24
    for at in range(0, whole, 24):
        for lane in range(3):
            part = data[at + 8 * lane : at + 8 * lane + 8]
            words[lane] = words[lane] + int.from_bytes(part, "little") & mask
        mix()
    tail = data[whole:].ljust(24, b"\0")
    words[2] = words[2] + len(data) & mask
    words[0] = words[0] + int.from_bytes(tail[:8], "little") & mask
    words[1] = words[1] + int.from_bytes(tail[8:16], "little") & mask
    words[2] = words[2] + (int.from_bytes(tail[16:], "little") << 8) & mask
    mix()
    return words[2] >> 1


def test_compat_hash_against_brute_force(spark):
    texts = ["ab" * n + "я" * (n % 5) for n in range(0, 120)] + ["x" * 5000, "y" * 47999]
    expected = [reference_hash(t.encode()) for t in texts]
    assert read(spark, texts, text_hash(F.col("x"), "compat")) == expected


def test_xxhash_is_the_public_one(spark):
    import xxhash

    texts = ["", "a", "click", "x" * 100]
    expected = [xxhash.xxh64_intdigest(t.encode(), seed=42) >> 1 for t in texts]
    assert read(spark, texts, text_hash(F.col("x"))) == expected
    with pytest.raises(ValueError):
        text_hash(F.col("x"), "md5")


def events(spark, rows):
    return spark.createDataFrame(rows, "src_id int, src int, app int")


def both(spark, rows, column):
    return [r[0] for r in events(spark, rows).select(column).collect()]


SRC, APP, SRC_ID = "src", "app", "src_id"
DECISIONS = [
    # src_id, src, app -> application type, client application, platform
    ((148, None, None), 11, 3, 3),
    ((149, None, None), 11, 23, 7),
    ((150, None, None), 11, 1, 4),
    ((2, None, 17), 3, 0, 2),
    ((141, None, 17), 3, 0, 2),
    ((None, 12, 17), 3, 0, 2),
    ((None, 11, 17), 1, 0, 1),
    ((141, None, 18), 1, 0, 1),
    ((141, None, 5), 141, 5, 0),
    ((1, None, None), 1, 0, 1),
    ((96, None, 3), 96, 3, 1),
    ((3, None, None), 3, 0, 2),
    ((95, None, None), 95, 0, 2),
    ((None, 13, None), 3, 0, 2),
    ((None, None, 3), 0, 3, 3),
    ((None, None, 1), 0, 1, 4),
    ((None, None, 23), 0, 23, 7),
    ((4, None, None), 4, 0, 5),
    ((None, 104, None), 4, 0, 5),
    ((None, 4, None), 4, 0, 5),
    ((6, None, None), 6, 0, 6),
    ((None, 206, None), 6, 0, 6),
    ((None, 16, None), 6, 0, 6),
    ((12, None, None), 12, 0, 16547000007),
    ((209, None, None), 209, 0, 16547000007),
    ((None, 112, None), 12, 0, 16547000007),
    ((None, 12, None), 2, 0, 0),
    ((163, None, None), 163, 0, 8),
    ((None, 100, None), 0, 0, 0),
    ((0, 104, -1), 4, 0, 0),
    ((None, None, None), 0, 0, 0),
]


@pytest.mark.parametrize("row, kind, client, platform", DECISIONS)
def test_decisions(spark, row, kind, client, platform):
    src_id, src, app = F.col("src_id"), F.col("src"), F.col("app")
    found = events(spark, [row]).select(
        decisions.app_type(src_id, src, app),
        decisions.client_app(src_id, app),
        decisions.platform(src_id, src, app),
    ).first()
    assert tuple(found) == (kind, client, platform)


def test_server_time(spark):
    rows = spark.createDataFrame(
        [(1.2345, 5), (0.0, 5), (None, 5), (-1.0, 0), (None, None), (1e300, 5)],
        "dtm double, dt int",
    )
    column = decisions.server_time(F.col("dtm"), F.col("dt"), F.lit(9))
    assert [r[0] for r in rows.select(column).collect()] == [1234, 5000, 5000, 9, 9, 9]


def test_load_test_flag(spark):
    texts = ["Mozilla LoadTest/2", "Mozilla", None]
    assert read(spark, texts, decisions.is_load_test(F.col("x"), "LoadTest")) == [1, 0, 0]


@pytest.mark.parametrize(
    "mode, expected", [("integer", [1.0, 0.0, 9.0, 0.0]), ("fraction", [1.2, 0.8, 9.0, 0.0])]
)
def test_guarded_ratio(spark, mode, expected):
    rows = spark.createDataFrame([(6, 5), (4, 5), (3, 4), (None, 5)], "n bigint, d bigint")
    column = guarded_ratio(F.col("n"), F.col("d"), 5, 9, mode)
    assert [r[0] for r in rows.select(column).collect()] == expected
    with pytest.raises(ValueError):
        guarded_ratio(F.col("n"), F.col("d"), 5, 9, "percent")


def test_extend_document(spark):
    texts = [
        '{"a":1.0,"b":"x"}', "{}", " { } ", '{"a":1}  ', "[1]", "{broken", None,
        '{"a":1} {"b":2}', '{"a":"}{"}', '{"t":5}', '{"a":1} tail', '{"a":1},{"b":2}',
        '{"a":1}}', '{"a":{"b":{}}}',
    ]
    column = extend_document(F.col("x"), {"t": F.lit(7)})
    assert read(spark, texts, column) == [
        '{"a":1.0,"b":"x","t":7}', '{"t":7}', ' { "t":7}', '{"a":1,"t":7}', None, None, None,
        None, '{"a":"}{","t":7}', '{"t":5,"t":7}', None, None,
        None, '{"a":{"b":{}},"t":7}',
    ]
    for text in read(spark, texts, column):
        if text:
            assert json.loads(text)["t"] == 7


def test_extend_json_in_sql_agrees(spark):
    from clickweir.plans.sql_job import register_functions

    register_functions(spark)
    texts = ['{"a":1}', "{}", "{broken", '{"a":1} {"b":2}', '{"a":{}}', '{"a":1}}', None]
    assert read(spark, texts, F.expr("extend_json(map('t', 7L), x)")) == read(
        spark, texts, extend_document(F.col("x"), {"t": F.lit(7)})
    )


def test_reject_reason(spark):
    texts = ['{"a":1}', "{}", "[1]", "7", "{broken", '{"a":tru}', "", None, '{"a":1,"a":2}']
    assert read(spark, texts, reject_reason(F.col("x"))) == [
        None, None, "not_object", "not_object", "malformed", "malformed", "malformed",
        "missing", None,
    ]


def test_every_text_is_extended_or_rejected(spark):
    texts = ['{"a":1}', "{}", '{"a":1} {"b":2}', '{"a":1}}', "[1]", "{broken", None, "7"]
    reasons = read(spark, texts, reject_reason(F.col("x"), whole=True))
    extended = read(spark, texts, extend_document(F.col("x"), {"t": F.lit(7)}))
    assert [r is None for r in reasons] == [e is not None for e in extended]
    assert reasons[2:] == [
        "trailing_text", "trailing_text", "not_object", "malformed", "missing", "not_object",
    ]


def test_spelled_key(spark):
    texts = ['{"eid":1,"EID":2}', '{"eid":1,"Eid":2}', '{"x":1}', "{"]
    column = spelled_key(F.json_object_keys("x"), "eid")
    assert read(spark, texts, column) == ["EID", "Eid", None, None]


def test_number_spelling(spark):
    texts = [
        '{"n":1704067207.100000}', '{"n": 1.50e3,"o":{"n":2.0}}', '{"n":"1.0"}',
        '{"n":12345678901234567890}', '{"o":{"n":7.10},"n":3.0}', '{"n":1.0,"o":{"n":1.00}}',
        '{"o":[{"n":1.00}],"n":1.000}',
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select(
        "x", F.json_tuple("x", "n").alias("n")
    )
    column = number_spelling(F.col("x"), F.lit("n"), F.col("n"))
    assert [r[0] for r in rows.select(column).collect()] == [
        "1704067207.100000", "1.50e3", "1.0", "12345678901234567890", "3.0",
        "1.0", "1.000",
    ]


def test_written_entries(spark):
    deep = "[" * 40 + "1.50" + "]" * 40
    texts = {
        '{"a":1.50,"a":"x\\"y\\u0041", "b" : [ 1, {"a":"}"} ] ,"c":null}': [
            ("a", "1.50"), ("a", 'x\\"y\\u0041'), ("b", '[ 1, {"a":"}"} ]'), ("c", "null")
        ],
        "{}": [],
        '{"a":"","":"{\\"b\\": 1}"}': [("a", ""), ("", '{\\"b\\": 1}')],
        '{"a":': None,
        "[1]": None,
        '{"a":%s,"b":2}' % deep: [("a", deep.replace("1.50", "1.5")), ("b", "2")],
        '{"a":"%s","b":[%s1]}' % ("\\n" * 50_000, "1, " * 50_000): [
            ("a", "\\n" * 50_000), ("b", "[%s1]" % ("1, " * 50_000))
        ],
    }
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    found = {r[0]: r[1] for r in rows.select("x", written_entries(F.col("x"))).collect()}
    for text, expected in texts.items():
        entries = found[text]
        assert (entries if entries is None else [tuple(e) for e in entries]) == expected
