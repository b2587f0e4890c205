import pytest
from pyspark.sql import functions as F

from clickweir.operators.enrich import enrich, extended_documents, rekey
from clickweir.operators.imports import import_rows
from clickweir.operators.latest import latest_rows
from clickweir.operators.parse import extract_fields, parse_events, rejects

# Documents in every state a topic can hold.
CORPUS = [
    r'{"eid":301,"uid":"7","dtm":1.5,"o":{"a": 1,  "b":[1, 2]},"n":null,"s":"a\tb\/cа"}',
    '{"eid":"bad","uid":9,"dtm":"x","o":[1, 2]}',
    "{broken",
    "[1,2]",
    '{"eid":5,"eid":6,"EID":7}',
    '{"a":tru,"uid":4}',
    '{"eid":3000000000,"uid":1.0}',
    '{"uid":true,"eid":""}',
    None,
    '{"a":"null"}',
    "{}",
    '{"eid":5,"eid":null}',
]


def column(frame, name):
    return [row[name] for row in frame.orderBy("offset").collect()]


def test_corpus_text(messages):
    fields = extract_fields(messages(CORPUS), ["eid", "uid", "o", "n", "s", "a"], ["offset"])
    assert column(fields, "eid") == [
        "301", "bad", None, None, "6", None, "3000000000", "", None, None, None, "5",
    ]
    assert column(fields, "uid")[:2] == ["7", "9"]
    assert column(fields, "o")[:2] == ['{"a":1,"b":[1,2]}', "[1,2]"]
    assert column(fields, "n")[0] is None
    assert column(fields, "s")[0] == "a\tb/cа"
    assert column(fields, "a")[9] == "null"


def test_corpus_typed(messages):
    events = parse_events(messages(CORPUS), "eid int, uid int, dtm double, a string")
    assert column(events, "eid") == [301, None, None, None, 6] + [None] * 6 + [5]
    assert column(events, "uid") == [7, 9] + [None] * 4 + [1] + [None] * 5
    assert column(events, "dtm")[:2] == [1.5, None]
    assert column(events, "a")[9] is None
    assert events.count() == len(CORPUS)


def test_corpus_sql_names(messages):
    events = parse_events(messages(CORPUS), "eid int, `uid` int", match="sql")
    assert column(events, "eid")[4] == 7
    assert column(events, "uid")[0] == 7
    kept = parse_events(messages(CORPUS), "eid int", match="sql", skip_rejects=True)
    assert column(kept, "offset") == [0, 1, 4, 6, 7, 9, 10, 11]


def test_whole_document_and_keys(messages):
    events = parse_events(messages(CORPUS, key=""), "eid int", document="$")
    assert column(events, "$") == CORPUS
    assert set(column(events, "rowkey")) == {""}


def test_rejects_leave_the_text_out(messages):
    found = rejects(messages(CORPUS))
    assert found.columns == ["partition", "offset", "reason"]
    assert column(found, "reason") == ["malformed", "not_object", "malformed", "missing"]
    assert column(rejects(messages(CORPUS), include_value=True), "value") == [
        "{broken", "[1,2]", '{"a":tru,"uid":4}', None,
    ]


def test_output_names_must_not_clash(messages):
    with pytest.raises(ValueError):
        extract_fields(messages(["{}"]), ["offset"], ["offset"])
    renamed = extract_fields(messages(['{"offset":"x"}']), {"own": "offset"}, ["offset"])
    assert renamed.first().asDict() == {"offset": 0, "own": "x"}


def test_wide_document(messages):
    text = "{" + ",".join(f'"k{n}":{n}' for n in range(6000)) + "}"
    assert extract_fields(messages([text]), ["k5999"]).first()[0] == "5999"


def test_extended_documents(messages):
    source = messages(['{"dt":5,"src_id":148,"x":[1.50]}', "{broken", "{}"])
    rows = extended_documents(source, F.lit(9)).orderBy("offset").collect()
    assert rows[0]["value"] == (
        '{"dt":5,"src_id":148,"x":[1.50],"_server_time":5000,"_apptype_id":11,'
        '"_clientsideapp_id":3,"_platform_id":3,"_ua_is_test":0}'
    )
    assert rows[1]["value"] is None
    assert '"_server_time":9' in rows[2]["value"]
    kept = extended_documents(source, F.lit(9), skip_rejects=True)
    assert column(kept, "offset") == [0, 2]
    assert column(kept, "value") == [rows[0]["value"], rows[2]["value"]]


def test_extra_fields_and_marker(messages):
    source = messages(['{"cid":4,"ua":"bench/1"}'])
    value = extended_documents(
        source, F.lit(1), load_test_marker="bench",
        extra_fields={"_category": lambda: F.col("cid") * 10},
    ).first()["value"]
    assert value.endswith('"_ua_is_test":1,"_category":40}')


def test_clock_is_the_last_resort(spark, messages):
    events = parse_events(
        messages(["{}"]), "dtm double, dt int, src_id int, src int, app int, ua string"
    )
    before = spark.range(1).select(F.unix_millis(F.current_timestamp())).first()[0]
    assert enrich(events).first()["_server_time"] >= before


def test_rekey_keeps_a_key_in_one_bucket(spark):
    documents = spark.createDataFrame(
        [(str(n % 7), str(n)) for n in range(500)], "rowkey string, value string"
    )
    placed = rekey(documents, 3)
    assert placed.count() == 500
    spread = placed.groupBy("rowkey").agg(F.count_distinct("key_bucket").alias("n"))
    assert {r["n"] for r in spread.collect()} == {1}


def test_latest_ignores_nulls(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", 1, None)],
        "k string, offset bigint, v string",
    )
    found = latest_rows(rows, ["k"], ["v"]).collect()
    assert {r["k"]: r["v"] for r in found} == {"a": "y", "b": None}


def test_import_types(spark):
    types = {
        "b": "boolean", "t": "tinyint", "s": "smallint", "i": "int", "l": "bigint",
        "n": "numeric(8,2)", "f": "float", "d": "double", "c": "char(3)", "day": "date",
        "at": "timestamp", "g": "text", "a": "int[]",
    }
    good = ("true", "1", "2", "3", "4", "5.25", "0.5", "0.25", "xyz", "2024-01-02",
            "2024-01-02 03:04:05", "POINT(1 2)", "[1,2]")
    bad = ("maybe", "300", "x", "1.5.1", "", "z", "z", "z", "q", "2024-99-99", "noon",
           "", "oops")
    rows = spark.createDataFrame([good, bad], ", ".join(f"{n} string" for n in types))
    accepted, rejected = import_rows(rows, types)
    first, second = accepted.collect()
    assert first["n"] == pytest.approx(5.25) or str(first["n"]) == "5.25"
    assert (first["b"], first["t"], first["l"], first["f"], first["a"]) == (
        True, 1, 4, 0.5, [1, 2],
    )
    assert str(first["day"]) == "2024-01-02" and first["g"] == "POINT(1 2)"
    assert [v for k, v in second.asDict().items() if k != "c"] == [None] * 12
    assert second["c"] == "q"
    assert rejected.count() == 0


def test_import_rejects_whole_rows(spark):
    rows = spark.createDataFrame([("1", "2"), ("x", "3"), ("4", "")], "a string, b string")
    accepted, rejected = import_rows(rows, {"a": "int", "b": "int"}, required=["a", "b"])
    assert [tuple(r) for r in accepted.collect()] == [(1, 2)]
    assert [tuple(r) for r in rejected.collect()] == [("x", "3", ["a"]), ("4", "", ["b"])]
    with pytest.raises(ValueError):
        import_rows(rows, {"a": "int"}, required=["z"])
