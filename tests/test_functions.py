import datetime
import decimal
import json
import uuid

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row, functions as F

from quillon.config import POINT_NAMESPACE, DatasetSpec, PayloadSpec, SpecError
from quillon.functions.keys import base64_text, point_id, request_file_name, result_file_name
from quillon.functions.pytext import payload_json, render_template
from quillon.functions.requests import content_parts, has_content, request_line
from quillon.functions.states import fetch_status, is_terminal, local_state, should_retry
from quillon.functions.vectors import l2_norm, norm_is_off, sign_sketch, truncated


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=60))
def test_point_id_is_uuid5(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    for row in df.select("id", point_id(F.col("id")).alias("p")).collect():
        assert row.p == str(uuid.uuid5(POINT_NAMESPACE, row.id))


def test_namespace_is_fixed():
    assert POINT_NAMESPACE == uuid.NAMESPACE_DNS


def test_base64_has_no_line_breaks(spark):
    text = spark.range(1).select(base64_text(F.lit(b"x" * 500)).alias("b")).first().b
    assert "\n" not in text and "\r" not in text and len(text) == 668


def test_file_names(spark):
    row = spark.range(1).select(
        result_file_name(F.lit("batches/12/3")).alias("r"),
        request_file_name(F.lit(7)).alias("s"),
        request_file_name(F.lit(1234567)).alias("t"),
    ).first()
    assert tuple(row) == ("batches_12_3.jsonl", "shard_00007.jsonl", "shard_1234567.jsonl")


VALUES = [
    Row(s="é", i=3, b=True, f=1e7, t=datetime.datetime(2024, 1, 2, 3, 4, 5)),
    Row(s=None, i=None, b=None, f=None, t=None),
    Row(s="{x}", i=-1, b=False, f=1e20, t=datetime.datetime(2024, 1, 2, 3, 4, 5, 60)),
    Row(s="", i=0, b=True, f=0.00001, t=datetime.datetime(1999, 12, 31)),
    Row(s="a", i=9, b=False, f=0.125, t=datetime.datetime(1999, 12, 31)),
]
VALUE_DDL = "s string, i bigint, b boolean, f double, t timestamp"


@pytest.mark.parametrize("template", [
    "{s} {i} {b}", "{f}", "{{{s}}}", "{i:05d}|{s!r}", "plain", "{s}{s}", "{t}",
])
def test_templates_follow_python(spark, template):
    df = spark.createDataFrame(VALUES, VALUE_DDL)
    usable = [v for v in VALUES if not (":05d" in template and v.i is None)]
    got = [r.t for r in spark.createDataFrame(usable, VALUE_DDL).select(
        render_template(template, df.schema).alias("t")).collect()]
    assert got == [template.format(**v.asDict()) for v in usable]


def test_rounding_follows_python(spark):
    df = spark.createDataFrame([(x,) for x in (0.125, 0.375, 1.005, 2.675, -0.5, 1e16)], "f double")
    got = [r.t for r in df.select(render_template("{f:.2f}", df.schema).alias("t")).collect()]
    assert got == [f"{x:.2f}" for x in (0.125, 0.375, 1.005, 2.675, -0.5, 1e16)]


def test_empty_template_and_missing_column(spark):
    df = spark.range(1)
    assert df.select(render_template("", df.schema).alias("t")).first().t == ""
    with pytest.raises(SpecError):
        render_template("{nope}", df.schema)


def test_payload_coercion(spark):
    values = {
        "id": 1, "s": "é", "n": None, "b": True, "f": 1.5, "d": datetime.date(2024, 1, 2),
        "t": datetime.datetime(2024, 1, 2, 3, 4, 5, 60), "w": datetime.datetime(2024, 1, 2),
        "c": decimal.Decimal("1.50"), "a": [1, 2], "q": ["x", "it's"], "o": {"k": "v", "m": 1},
    }
    ddl = ("id int, s string, n string, b boolean, f double, d date, t timestamp, w timestamp, "
           "c decimal(5,2), a array<int>, q array<string>, o struct<k:string,m:int>")
    df = spark.createDataFrame([tuple(values.values())], ddl)
    spec = DatasetSpec(dataset="x", id_column="id", modality="text")
    got = json.loads(df.select(payload_json(spec, df.schema).alias("p")).first().p)
    scalar = (str, int, float, bool, type(None))
    expected = {k: v if isinstance(v, scalar) else str(v) for k, v in values.items() if k != "id"}
    assert got == expected and list(got) == list(expected)


def test_payload_selection(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, x string, y string, z string")

    def keys(**payload):
        spec = DatasetSpec(dataset="x", id_column="id", modality="text", payload=PayloadSpec(**payload))
        return json.loads(df.select(payload_json(spec, df.schema).alias("p")).first().p)

    assert keys() == {"x": "a", "y": "b", "z": "c"}
    assert keys(exclude=("y",)) == {"x": "a", "z": "c"}
    assert keys(include=("z", "id", "gone")) == {"z": "c", "gone": None}
    assert keys(include=("z", "x"), exclude=("z",)) == {"x": "a"}
    assert keys(include=()) == {}


@pytest.mark.parametrize("modality", ["text", "image", "multimodal"])
@pytest.mark.parametrize("text", ["hello", "", None])
@pytest.mark.parametrize("image", [b"\x00\xff", None])
def test_requests(spark, modality, text, image):
    spec = DatasetSpec(dataset="x", modality=modality, image_column="image")
    df = spark.createDataFrame([("k", text, image)], "id string, text string, image binary")
    parts = content_parts(spec, F.col("text"), F.col("image"))
    row = df.select(
        request_line(F.col("id"), parts, dim=8, model="models/m").alias("line"),
        has_content(spec, F.col("text"), F.col("image").isNotNull()).alias("has"),
    ).first()
    expected = []
    if modality != "image" and text:
        expected.append({"text": text})
    if modality != "text" and image is not None:
        expected.append({"inline_data": {"mime_type": "image/jpeg", "data": "AP8="}})
    assert row.has == bool(expected)
    if not expected:
        assert row.line is None
        return
    assert json.loads(row.line) == {
        "key": "k",
        "request": {
            "model": "models/m", "task_type": "RETRIEVAL_DOCUMENT", "output_dimensionality": 8,
            "content": {"parts": expected},
        },
    }


def test_job_states(spark):
    names = ["JOB_STATE_CANCELLED", "JOB_STATE_PENDING", "odd", None]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = [tuple(r) for r in df.select(local_state(F.col("s")), is_terminal(F.col("s"))).collect()]
    assert got == [("FAILED", True), ("SUBMITTED", False), ("RUNNING", False), ("RUNNING", False)]


@pytest.mark.parametrize("code, error, attempt, status, retry", [
    (200, None, 1, "ok", False),
    (404, None, 1, "failed_404", False),
    (410, None, 1, "failed_404", False),
    (400, None, 1, "failed_other", True),
    (403, None, 4, "failed_other", True),
    (503, None, 5, "failed_other", False),
    (None, "timeout", 2, "failed_other", True),
    (None, "protocol", 5, "failed_other", False),
    (None, "other", 1, "failed_other", False),
    (200, "other", 1, "failed_other", False),
])
def test_fetch_outcomes(spark, code, error, attempt, status, retry):
    df = spark.createDataFrame([(code, error, attempt)], "c int, e string, a int")
    c, e, a = F.col("c"), F.col("e"), F.col("a")
    assert tuple(df.select(fetch_status(c, e), should_retry(c, e, a, 5)).first()) == (status, retry)


def test_vectors(spark):
    rng = np.random.default_rng(1)
    vector = [float(x) for x in rng.normal(size=70)]
    zero = [0.0] * 70
    df = spark.createDataFrame([(vector,), (zero,)], "v array<float>")
    first, second = df.select(
        l2_norm(F.col("v")).alias("n"), truncated(F.col("v"), 16).alias("t"), sign_sketch(F.col("v"), 70).alias("s")
    ).collect()
    v32 = np.array(vector, np.float32).astype(float)
    assert first.n == pytest.approx(np.linalg.norm(v32))
    assert np.allclose(first.t, v32[:16] / np.linalg.norm(v32[:16]), atol=1e-6)
    assert second.t == [0.0] * 16 and second.s == [0, 0]
    bits = np.packbits(v32 > 0, bitorder="little")
    packed = np.pad(bits, (0, 16 - len(bits))).view("<i8")
    assert first.s == packed.tolist()


@pytest.mark.parametrize("norm, off", [(0.94, True), (0.95, False), (1.0, False), (1.05, False), (1.06, True)])
def test_norm_range(spark, norm, off):
    df = spark.createDataFrame([([norm, 0.0],)], "v array<double>")
    assert df.select(norm_is_off(F.col("v"))).first()[0] is off
