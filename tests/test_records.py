import pytest
from pyspark.sql import functions as F

from quillon.config import DatasetSpec, PayloadSpec, SpecError
from quillon.operators.contract import input_contract, schema_violations, unreachable_indexes
from quillon.operators.dedupe import first_write_wins, insert_or_ignore, last_write_wins
from quillon.operators.normalize import normalize, split_null_ids
from quillon.operators.numbering import global_index
from quillon.operators.profile import column_roles, profile, type_name
from quillon.operators.points import typed_payload
from quillon.operators.sampling import seeded_sample
from quillon.sources.tables import read_with_row_index


def spec(**kw):
    return DatasetSpec(**{"dataset": "d", "modality": "text", **kw})


def test_spec_errors():
    with pytest.raises(SpecError, match="dataset"):
        DatasetSpec.from_mapping({})
    with pytest.raises(SpecError, match="modality"):
        DatasetSpec.from_mapping({"dataset": "d", "modality": "audio"})
    with pytest.raises(SpecError, match="modality"):
        spec().overridden(modality="audio")


def test_spec_from_yaml():
    s = DatasetSpec.from_yaml(
        "dataset: d\nid_column: a\ntext_template: '{t} {t} {u}'\nmodality: text\n"
        "payload:\n  exclude: [x]\n  indexes: {t: keyword}\n"
    )
    assert s.template_columns == ["t", "u"] and s.split == "train"
    assert s.payload == PayloadSpec(None, ("x",), {"t": "keyword"})
    assert s.overridden(split="test", id_column=None).split == "test"


@pytest.mark.parametrize("kw, check", [
    ({"id_column": "gone"}, "id_column"),
    ({"text_template": "{gone}"}, "text_template"),
    ({"modality": "image"}, "modality"),
    ({"image_column": "gone"}, "image_column"),
    ({"image_column": "n"}, "image_type"),
    ({"payload": PayloadSpec(include=("s",), indexes={"n": "integer"})}, "index_column"),
    ({"payload": PayloadSpec(indexes={"n": "number"})}, "index_type"),
])
def test_schema_violations(spark, kw, check):
    df = spark.createDataFrame([], "s string, n int")
    assert [c for c, _ in schema_violations(df.schema, spec(**kw))] == [check]
    with pytest.raises(SpecError):
        normalize(df, spec(**kw))


def test_valid_spec_and_unreachable_index(spark):
    df = spark.createDataFrame([], "id string, s string, pic binary")
    s = spec(id_column="id", text_template="{s}", image_column="pic", modality="multimodal",
             payload=PayloadSpec(indexes={"id": "keyword", "s": "keyword"}))
    assert schema_violations(df.schema, s) == []
    assert unreachable_indexes(df, s) == ["id"]


def test_null_and_duplicate_ids(spark, rows):
    df = spark.createDataFrame(
        [(None, "a", None), ("1", "", "u"), ("1", " ", ""), ("2", "b", "v")],
        "id string, s string, url string",
    )
    s = spec(id_column="id", text_template="{s}", image_column="url", modality="multimodal")
    records = normalize(df, s)
    usable, quarantined = split_null_ids(records)
    assert usable.count() == 3 and quarantined.count() == 1
    counts = {r["check"]: r["count"] for r in input_contract(df, records, s).collect()}
    assert counts == {"rows": 4, "null_ids": 1, "duplicate_ids": 1, "blank_text": 2, "empty_urls": 2,
                      "schema_violations": 0, "unreachable_indexes": 0}


def test_contract_of_empty_table(spark):
    df = spark.createDataFrame([], "id string, s string")
    s = spec(id_column="id", text_template="{s}")
    assert {r["count"] for r in input_contract(df, normalize(df, s), s).collect()} == {0}


def test_boolean_id_and_missing_index(spark):
    df = spark.createDataFrame([(True,)], "id boolean")
    assert normalize(df, spec(id_column="id")).first().record_id == "True"
    with pytest.raises(ValueError, match="row index"):
        normalize(df, spec())


def test_row_index_follows_files(spark, tmp_path):
    for part, ids in (("a", range(5)), ("b", range(5, 12)), ("c", range(12, 13))):
        spark.createDataFrame([(i,) for i in ids], "n int").coalesce(1).write.mode("append").parquet(str(tmp_path / part))
    df = read_with_row_index(spark, str(tmp_path / "*"))
    got = sorted((r.row_index, r.n) for r in df.collect())
    assert [i for i, _ in got] == list(range(13))
    by_n = sorted(got, key=lambda t: t[1])
    # Rows of one file stay together and in order.
    for ids in (range(5), range(5, 12)):
        places = [i for i, n in by_n if n in ids]
        assert places == list(range(places[0], places[0] + len(ids)))


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_global_index_equals_row_number(spark, n):
    ids = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("id"))
    got = [(r.id, r.row_index) for r in global_index(ids, ["id"], partitions=7).collect()]
    assert sorted(got) == [(x, i) for i, x in enumerate(sorted(r.id for r in ids.collect()))]


def test_write_order(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], "k string, seq int, v string")
    assert rows(first_write_wins(df, ["k"], ["seq"])) == [("a", 1, "x"), ("b", 5, "z")]
    assert rows(last_write_wins(df, ["k"], ["seq"])) == [("a", 2, "y"), ("b", 5, "z")]
    state = df.where("k = 'b'")
    assert rows(insert_or_ignore(state, df, ["k"], ["seq"])) == [("a", 1, "x")]
    assert insert_or_ignore(df, df, ["k"], ["seq"]).count() == 0


def test_groups_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, seq int")
    plan = last_write_wins(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert "Partial" in plan and limit > exchange


def test_profile_and_roles(spark, rows):
    df = spark.createDataFrame(
        [("k1", "a", "x", [1], None), ("k2", "b", "x", [2], 1.0)],
        "uuid string, one string, two string, nums array<int>, val double",
    )
    got = [tuple(r) for r in profile(df).orderBy("position").collect()]
    assert got == [
        (0, "uuid", "string", "good ID candidate", 2, 0, 2),
        (1, "one", "string", "", 2, 0, 2),
        (2, "two", "string", "", 2, 0, 1),
        (3, "nums", "sequence<int32>", "not embeddable directly", 2, 0, 2),
        (4, "val", "float64", "", 2, 1, 1),
    ]
    assert rows(column_roles(profile(df))) == [
        ("one", "template"), ("text", "modality"), ("two", "template"), ("uuid", "id")]


def test_repeated_id_is_no_candidate(spark, rows):
    df = spark.createDataFrame([("k", "a"), ("k", "b")], "id string, one string")
    assert [r.note for r in profile(df).orderBy("position").collect()] == ["", ""]
    assert ("id", "template") in rows(column_roles(profile(df)))


def test_image_roles(spark, rows):
    image = ("struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    df = spark.createDataFrame([], f"pic {image}, n int")
    assert rows(column_roles(profile(df))) == [("image", "modality"), ("pic", "image")]
    assert type_name(df.schema["pic"].dataType) == "Image"


def test_sample_is_repeatable(spark, rows):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"))
    first = rows(seeded_sample(df, "id", 20, 7))
    assert first == rows(seeded_sample(df.repartition(9), "id", 20, 7))
    assert first != rows(seeded_sample(df, "id", 20, 8)) and len(first) == 20
    assert seeded_sample(df.limit(3), "id", 20).count() == 3


def test_ids_are_judged_on_all_rows(spark):
    df = spark.createDataFrame([(str(min(i, 149)), str(i)) for i in range(151)], "id string, key string")
    notes = {r.column: r.note for r in profile(df).collect()}
    assert notes == {"id": "", "key": "good ID candidate"}


def test_indexed_fields_keep_the_points_columns(spark):
    points = spark.createDataFrame([("p", "r", "{}")], "point_id string, record_id string, payload string")
    with pytest.raises(SpecError, match="record_id"):
        typed_payload(points, {"record_id": "keyword"})
