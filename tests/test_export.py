import gzip
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from clickweir.plans.export import ExportJob, parse_arguments, run_export
from clickweir.session import fresh_folder, shared_folder
from clickweir.sinks import files, render
from clickweir.sinks.export_spec import ExportSpec, parse_typed_columns
from clickweir.sinks.jdbc import JdbcTarget
from clickweir.sinks.tables import append_to_table
from clickweir.sources.catalog import appendable_schema, columns_from_table, schema_of
from clickweir.sources.envelope import write_replay
from tests.test_functions import VECTORS

DOCUMENTS = [
    '{"a":"x|y","b":1.50,"c":null,"d":{"k":[1, 2]},"e":""}',
    "{broken",
    '{"b":2,"b":3,"a":"null"}',
]


def lines(frame):
    return [row[0] for row in frame.collect()]


def test_spec_grammar():
    spec = ExportSpec.parse("timestamp;partition;columns:hash(u),a=g,b,c=g,hash(d)=g")
    assert spec.headers == ("timestamp", "partition")
    assert spec.mode == "columns"
    assert [(n, [(f.key, f.hashed) for f in m]) for n, m in spec.groups.items()] == [
        ("u", [("u", True)]),
        ("g", [("a", False), ("c", False), ("d", True)]),
        ("b", [("b", False)]),
    ]
    assert list(ExportSpec.parse("array:a,b=g,c").groups) == ["", "g"]
    assert ExportSpec.parse("").mode == "json"
    assert ExportSpec.parse("key;eav").headers == ("key",)
    assert ExportSpec.parse("columns:a;json").mode == "json"


@pytest.mark.parametrize("text", ["csv", "columns", "columns:md5(a)", "columns:a,,b"])
def test_spec_errors(text):
    with pytest.raises(ValueError):
        ExportSpec.parse(text)


def test_typed_columns():
    columns = parse_typed_columns("a:bigint, b:decimal(10,2),c:int[]")
    assert [(c.name, c.type) for c in columns] == [
        ("a", "bigint"), ("b", "decimal(10,2)"), ("c", "int[]"),
    ]
    nested = parse_typed_columns("a:struct<x:int,y:array<int>>,b:int")
    assert [c.name for c in nested] == ["a", "b"]
    with pytest.raises(ValueError):
        parse_typed_columns("a:int,b")


def test_delimited(messages):
    spec = "key;offset;timestamp;partition;columns:a,b,c,d,e,zz"
    assert lines(render.render_lines(messages(DOCUMENTS), spec)) == [
        'u1|0|5|0|x|y|1.50||{"k":[1,2]}||',
        "u1|1|1005|0||||||",
        "u1|2|2005|0||3||||",
    ]


def test_delimited_null_key_and_comma(messages):
    rows = messages(DOCUMENTS, key=None)
    assert lines(render.render_lines(rows, "key;columns:b,a", ",")) == [
        ",1.50,x|y", ",,", ",3,",
    ]


def test_grouped(messages):
    spec = "columns:a=g,b,c=g,d=h"
    assert lines(render.render_lines(messages(DOCUMENTS), spec)) == [
        '{x|y,}|1.50|{"k":[1,2]}', "{,}||", "{,}|3|",
    ]


def test_same_field_twice(messages):
    rows = messages(['{"a":1}'])
    assert lines(render.render_lines(rows, "columns:a,a=g,b=g")) == ["1|{1,}"]


def test_hash_covers_explicit_nulls(messages):
    rows = messages(['{"a":null}', '{"a":""}', "{}", '{"a":"click","a":301}', "{broken"])
    assert lines(render.render_lines(rows, "columns:hash(a)")) == [
        str(VECTORS["null"]), str(VECTORS[""]), "", str(VECTORS["301"]), "",
    ]


def test_json_lines_pass_any_text(messages):
    rows = messages([*DOCUMENTS, None])
    assert lines(render.render_lines(rows, "offset;json", ";")) == [
        f"0;{DOCUMENTS[0]}", "1;{broken", f"2;{DOCUMENTS[2]}", "3;",
    ]


def test_eav(messages):
    assert lines(render.render_lines(messages(DOCUMENTS), "offset;eav")) == [
        "0|a|x|y", "0|b|1.50", "0|c|null", '0|d|{"k":[1,2]}', "0|e|",
        "2|b|2", "2|b|3", "2|a|null",
    ]


def test_sparse_groups(messages):
    rows = render.sparse_groups(messages(DOCUMENTS), "offset;array:a,b,c=g,d=g").collect()
    assert [(r["offset"], r["values"], r["g"]) for r in rows] == [
        ("0", {"a": "x|y", "b": "1.50"}, {"d": '{"k":[1,2]}'}),
        ("1", {}, {}),
        ("2", {"b": "3"}, {}),
    ]
    placed = render.sparse_groups(messages(DOCUMENTS), "array:a,b,c=g,d=g", "positions")
    assert [tuple(e) for e in placed.collect()[2]["values"]] == [(1, "3")]
    with pytest.raises(ValueError):
        render.render_lines(messages(DOCUMENTS), "array:a")
    with pytest.raises(ValueError):
        render.sparse_groups(messages(DOCUMENTS), "array:a", "packed")


def test_no_size_limit(messages):
    big = "x" * 200_000
    rows = messages(['{"a":"' + big + '"}'])
    assert lines(render.render_lines(rows, "columns:a")) == [big]
    assert render.sparse_groups(rows, "array:a").first()["values"] == {"a": big}


def test_text_files(spark, messages):
    folder = fresh_folder(spark, "text")
    files.write_lines(
        messages(DOCUMENTS).coalesce(1), folder, "columns:b", newline="\r\n", compression="gzip"
    )
    (part,) = [n for n in os.listdir(folder) if n.endswith(".gz")]
    with gzip.open(f"{folder}/{part}", "rb") as file:
        assert file.read() == b"1.50\r\n\r\n3\r\n"


def test_orc_types(spark, messages):
    folder = fresh_folder(spark, "orc")
    rows = messages(
        ['{"l":"12x","s":"a\\tb","d":"1.5e1z","f":0.5,"t":"tr","i":7}', '{"l":"x","s":""}', "{"]
    )
    files.write_orc(rows, folder, "l:bigint,s:string,d:double,f:float,t:boolean,i:int")
    found = sorted(
        (tuple(r) for r in spark.read.orc(folder).collect()), key=lambda r: str(r[0])
    )
    assert found == [
        (0, None, None, None, None, None),
        (12, "a\tb", 15.0, 0.5, True, 7),
        (None,) * 6,
    ]


def test_typed_batch(messages):
    rows = files.typed_batch(
        messages(['{"i":"5","b":"true","n":1.5,"s":"click","ts":12,"a":[1,2],"w":["a","view"]}']),
        "i:integer,b:boolean,n:number,s:string,ts:timestamp,a:integer[],w:string[]",
    )
    assert tuple(rows.first()) == (
        0, rows.first()["_key"], 5, True, 1.5, VECTORS["click"], 12, [1, 2],
        [VECTORS["a"], VECTORS["view"]],
    )


@pytest.fixture
def target(spark):
    location = fresh_folder(spark, "target")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(
        f"CREATE TABLE {name} (_offset BIGINT, uid INT, ua STRING, ok BOOLEAN, "
        f"load_day STRING DEFAULT 'today') USING parquet LOCATION '{location}'"
    )
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_table_append(spark, messages, target):
    assert appendable_schema(spark, target).fieldNames() == ["_offset", "uid", "ua", "ok"]
    rows = messages(['{"uid":"on","_offset":77,"ok":"t"}', "{"])
    append_to_table(rows, target, nulls="keep")
    append_to_table(rows, target, nulls="default", slices=2)
    found = sorted(tuple(map(str, r)) for r in spark.table(target).collect())
    assert found == sorted(
        [
            ("0", "1", "None", "True", "today"),
            ("1", "None", "None", "None", "today"),
            ("0", "1", "", "True", "today"),
            ("1", "0", "", "False", "today"),
        ]
    )
    with pytest.raises(ValueError):
        append_to_table(rows, target, nulls="zero")


def test_schema_from_a_columns_table(spark):
    spark.createDataFrame(
        [
            ("dwh", "clicks", "uid", "UInt64", ""),
            ("dwh", "clicks", "ua", "String", None),
            ("dwh", "clicks", "day", "Date", "MATERIALIZED"),
            ("dwh", "other", "x", "Int32", ""),
        ],
        "database string, table string, name string, type string, default_kind string",
    ).createOrReplaceTempView("described")
    types = columns_from_table(spark, "described", "dwh.clicks")
    assert types == {"uid": "uint64", "ua": "string"}
    assert schema_of(types).simpleString() == "struct<uid:decimal(20,0),ua:string>"


def test_jdbc_options():
    options = JdbcTarget(
        "jdbc:x://{host}:{port}/{database}", "dwh.clicks", "h", 9000, "dwh", "$ME", "p",
        batch_size=10, writers=3,
    ).options({"ME": "root"})
    assert options == {
        "url": "jdbc:x://h:9000/dwh", "dbtable": "dwh.clicks", "batchsize": "10",
        "numPartitions": "3", "user": "root", "password": "p",
    }


def test_exporter_command_line(spark, messages):
    source, out = fresh_folder(spark, "replay"), fresh_folder(spark, "exported")
    write_replay(messages(DOCUMENTS), source)
    job = parse_arguments(
        ["--replay", source, "--task", "0:1:1", "--columns", "offset;columns:b",
         "--filename", out, "--delimiter", ";"]
    )
    assert run_export(spark, job) == "finished"
    assert lines(spark.read.text(out)) == ["1;"]
    assert parse_arguments(["--start-earliest", "--thread-count", "4"]).thread_count == 4
    with pytest.raises(ValueError):
        run_export(spark, ExportJob(replay=source, format="xml"))


def test_exporter_keeps_the_spelling_of_messages(spark, messages):
    source, out = fresh_folder(spark, "replay"), fresh_folder(spark, "exported")
    write_replay(messages(['{"s":"a\\tb\\/", "o":{"n": 1.50}, "n":1.500}', "{broken"]), source)
    job = parse_arguments(
        ["--replay", source, "--task", "0:0:2", "--columns", "columns:s,o,n", "--filename", out,
         "--spelling", "message"]
    )
    assert run_export(spark, job) == "finished"
    assert sorted(lines(spark.read.text(out))) == ['a\\tb\\/|{"n": 1.50}|1.500', "||"]
    with pytest.raises(ValueError):
        render.render_lines(messages(DOCUMENTS), "columns:s", spelling="other")


@pytest.mark.parametrize(
    "job",
    [
        ExportJob(replay="x"),
        ExportJob(replay="x", task="*:-2:1", format="orc", spelling="message"),
        ExportJob(replay="x", task="*:-2:1", format="table", table="t", batch_size=10),
        ExportJob(replay="x", task="*:-2:1", format="table", table="t", thread_count=2),
        ExportJob(replay="x", task="*:-2:1", format="orc", delimiter=";"),
        ExportJob(replay="x", task="*:-2:1", format="csv", columns_table="t"),
    ],
)
def test_exporter_refuses_what_it_would_ignore(spark, job):
    with pytest.raises(ValueError):
        run_export(spark, job)


def test_orc_compression_is_honoured(spark, messages):
    source, out = fresh_folder(spark, "replay"), fresh_folder(spark, "exported")
    write_replay(messages(DOCUMENTS), source)
    job = ExportJob(
        replay=source, task="*:-2:9", format="orc", columns="b:double", filename=out,
        compression="snappy",
    )
    assert run_export(spark, job) == "finished"
    assert any(name.endswith(".snappy.orc") for name in os.listdir(out))


def test_every_record_is_one_line(spark, messages):
    texts = ['{"a":"x\\ny\\r\\tz","k\\nl":1}'] * 3
    folder = fresh_folder(spark, "lines")
    files.write_lines(messages(texts), folder, "offset;columns:a")
    assert sorted(lines(spark.read.text(folder))) == [f"{n}|x\\ny\\r\\tz" for n in range(3)]
    assert render.render_lines(messages(texts), "eav").where("line rlike '[\\n\\r\\t]'").isEmpty()


def test_a_cluster_needs_a_shared_folder():
    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda *_: folder, set=lambda *_: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert shared_folder(session("local[4]"))
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"):
        with pytest.raises(ValueError):
            shared_folder(session(master))


def test_exporter_source_options():
    job = ExportJob(
        brokers="b:9092", topic="clicks", group="g", task="%:-1000:10", start_earliest=True,
        checkpoint="/c", kafka_user="me", kafka_password='p"w', sasl_mechanisms="PLAIN",
        security_protocol="SASL_SSL", ssl_ca_location="/ca.pem",
    )
    options = job.source_options()
    fresh = ExportJob(brokers="b:9092", topic="clicks", task="%:-1000:10", checkpoint="/c")
    with pytest.raises(ValueError):
        fresh.source_options(has_positions=False)
    assert fresh.source_options(has_positions=True)["startingOffsets"] == "earliest"
    assert options["subscribe"] == "clicks"
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "10"
    assert options["kafka.bootstrap.servers"] == "b:9092"
    assert 'password="p\\"w"' in options["kafka.sasl.jaas.config"]
    assert options["kafka.ssl.truststore.location"] == "/ca.pem"


def test_grouped_cells_keep_rows_whole(messages):
    rows = messages([DOCUMENTS[0]] * 100)
    assert render.render_lines(rows, "columns:a=g,b=g").agg(F.count("*")).first()[0] == 100


def test_exporter_continues_from_positions(spark, messages):
    from clickweir.sinks.manifests import ManifestLog

    root = fresh_folder(spark, "continued")
    write_replay(messages([f'{{"uid":{i}}}' for i in range(10)]), f"{root}/in")
    common = [
        "--replay", f"{root}/in", "--columns", "offset", "--filename", f"{root}/out",
        "--positions", f"{root}/group", "--start-earliest",
    ]
    for task, reason in (("%:-1000:3", []), ("%:-1000:4", []), ("%:-1000:9", ["--checkpoint", f"{root}/c"])):
        job = parse_arguments([*common, "--task", task, "--poll-timeout", "4000", *reason])
        assert run_export(spark, job) == ("idle" if reason else "finished")
    folders = ManifestLog(spark, f"{root}/group").parts()
    lines = [r[0] for f in folders for r in spark.read.text(f"{root}/out/{f}").collect()]
    assert sorted(int(line.split("|")[0]) for line in lines) == list(range(10))
    assert len(folders) == 3


def test_exporter_positions_need_an_output_that_can_be_replaced(spark):
    for options in (["--format", "jdbc", "--table", "t"], ["--format", "table", "--table", "t"]):
        job = parse_arguments(["--task", "%:-1000:3", "--positions", "p", *options])
        with pytest.raises(ValueError, match="no use for positions|batch_column"):
            run_export(spark, job)


def test_exporter_appends_each_step_to_a_table_once(spark, messages):
    root = fresh_folder(spark, "steps")
    write_replay(messages([f'{{"uid":{i}}}' for i in range(10)]), f"{root}/in")
    spark.sql("DROP TABLE IF EXISTS stepwise")
    spark.sql("CREATE TABLE stepwise (uid INT, step BIGINT) USING parquet PARTITIONED BY (step)")
    for _ in range(3):
        job = parse_arguments(
            ["--replay", f"{root}/in", "--task", "%:-1000:4", "--positions", f"{root}/group",
             "--format", "table", "--table", "stepwise", "--batch-column", "step",
             "--start-earliest", "--nulls", "keep"]
        )
        run_export(spark, job)
    rows = [tuple(r) for r in spark.table("stepwise").orderBy("uid").collect()]
    assert rows == [(i, i // 4) for i in range(10)]
    spark.sql("DROP TABLE stepwise")
