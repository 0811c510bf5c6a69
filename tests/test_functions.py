import json
import uuid

import pytest
from pyspark.sql import functions as F

from factloom.functions import canonical as C
from factloom.functions import ident


@pytest.mark.parametrize(
    ("value", "text"),
    [(1e21, "1e+21"), (1e-7, "1e-7"), (0.000001, "0.000001"), (-0.0, "0"), (100, "100"), (1.5, "1.5"), (123456789012345680000, "123456789012345680000"), (5e-324, "5e-324")],
)
def test_numbers_print_as_in_scripts(value, text):
    assert C.number(value) == text


def test_key_orders_differ():
    value = {"recordFamily": 1, "recordedAt": 2, "B": 3, "a": 4, "_x": 5}
    assert list(json.loads(C.canonical(value))) == ["B", "_x", "a", "recordFamily", "recordedAt"]
    assert list(json.loads(C.canonical(value, C.EVIDENCE))) == ["_x", "a", "B", "recordedAt", "recordFamily"]


@pytest.mark.parametrize(
    ("value", "form", "code"),
    [
        ({"a": {"apiKey": 1}}, C.EVIDENCE, "EVIDENCE_FORBIDDEN_FIELD"),
        ({"sql": "x"}, C.DOMAIN, "DOMAIN_PROJECTION_EXECUTABLE_FIELD_FORBIDDEN"),
        ([0] * 4097, C.EVIDENCE, "EVIDENCE_JSON_SIZE_EXCEEDED"),
        ("x" * 262_143, C.EVIDENCE, "EVIDENCE_JSON_SIZE_EXCEEDED"),
        ([0] * 257, C.DOMAIN, "DOMAIN_PROJECTION_FINITE_JSON_REQUIRED"),
    ],
)
def test_limits(value, form, code):
    with pytest.raises(C.CanonicalError) as e:
        C.canonical(value, form)
    assert e.value.code == code


def test_bounds_are_inclusive():
    C.canonical("x" * 262_142, C.EVIDENCE)
    C.canonical([0] * 256, C.DOMAIN)
    deep = 0
    for _ in range(16):
        deep = [deep]
    C.canonical(deep, C.DOMAIN)
    with pytest.raises(C.CanonicalError):
        C.canonical([deep], C.DOMAIN)


def test_secret_exemptions():
    assert not C.forbidden("secretStatus", "available")
    assert C.forbidden("secretStatus", "hunter2")
    states = ["unknown", "available", "unavailable", "invalid"]
    assert not C.forbidden("secretStatus", {"type": "string", "enum": states})
    for other in ({"type": "string", "enum": states[:2]}, {"type": "string", "enum": states[::-1]}, {"enum": states}, {"type": "string", "enum": states, "x": 1}, states):
        assert C.forbidden("secretStatus", other)
    assert not C.forbidden("apiCredentialRef", "x")
    assert C.secret_paths({"a": [{"password": 1}]}) == ["$.a[0].password"]


def test_canonical_column(spark):
    rows = spark.createDataFrame([('{"b":1,"a":2}',), ("{",), (None,)], "j string")
    got = rows.select(C.canonical_column(F.col("j"), C.DOMAIN).alias("c")).collect()
    assert [r.c["text"] for r in got] == ['{"a":2,"b":1}', None, None]
    assert got[1].c["code"] == "DOMAIN_PROJECTION_FINITE_JSON_REQUIRED"


def test_uuid5_is_the_library_s(spark):
    names = ["", "a", "é\x1fb", "x" * 300]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(ident.uuid5(F.col("n")).alias("u")).collect()
    assert [r.u for r in got] == [str(uuid.uuid5(uuid.UUID(ident.NAMESPACE), n)) for n in names]


def test_strict_parsing(spark):
    rows = spark.createDataFrame(
        [("2024-02-29T00:00:00Z",), ("2023-02-29T00:00:00Z",), ("2024-01-01T00:00:00.123456789Z",), ("2024-01-01 00:00:00Z",), (None,)], "t string"
    )
    got = [r.m for r in rows.select(F.unix_millis(ident.strict_utc(F.col("t"))).alias("m")).collect()]
    assert got == [1709164800000, None, 1704067200123, None, None]
    rows = spark.createDataFrame([("18446744073709551615",), ("18446744073709551616",), ("01",), ("0",), ("-1",)], "t string")
    got = [r.u if r.u is None else int(r.u) for r in rows.select(ident.unsigned(F.col("t")).alias("u")).collect()]
    assert got == [18446744073709551615, None, None, 0, None]


def test_names_and_labels(spark):
    one = spark.range(1)
    row = one.select(
        ident.canonical_name(F.lit(" t "), F.lit("p")).alias("n"), ident.canonical_name(F.lit(" "), F.lit("p")).alias("bad"),
        ident.derived_id(F.lit("é"), F.lit("x")).alias("d"), ident.escaped_label(F.lit('a"\\\n')).alias("l"),
        ident.normalised(F.array(F.lit(" b"), F.lit("a"), F.lit(""), F.lit("b"))).alias("s"),
    ).first()
    assert row.n == "sdar-id-v1\x1ft\x1fp" and row.bad is None
    assert row.d == "derived-v1:2:é:1:x" and row.l == 'a\\"\\\\\\n' and row.s == ["a", "b"]
