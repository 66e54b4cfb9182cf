import json

import pytest
from pyspark.sql import functions as F

from cantora.functions import claims as C
from cantora.sources import landed


def claim(value):
    return {"mainsnak": {"datavalue": {"value": value}}}


def rows(spark, *payloads):
    df = spark.createDataFrame([(str(i), p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(payloads)],
                               "artist string, payload string")
    return sorted(map(tuple, landed.claim_rows(df).collect()), key=str)


def test_values_of_every_shape(spark):
    got = rows(spark, {"claims": {
        "P1477": [claim({"text": "Ana É", "language": "es"}), claim("bare")], "P19": [claim({"id": "Q1"})],
        "P569": [claim({"time": "+1960-01-02T00:00:00Z"}), claim({"time": 1960})], "P1": [claim(7), claim(True), claim(2.5), claim(None)],
        "P2": claim("single"), "P3": [{"mainsnak": {}}, {}, 5, None], "P4": [], "P5": "text", "P6": None,
    }})
    assert got == sorted([
        ("0", "P1477", 0, "object", "Ana É", None), ("0", "P1477", 1, "string", "bare", None), ("0", "P19", 0, "object", "Q1", None),
        ("0", "P569", 0, "object", '{"time":"+1960-01-02T00:00:00Z"}', "+1960-01-02T00:00:00Z"), ("0", "P569", 1, "object", '{"time":1960}', "1960"),
        ("0", "P1", 0, "number", "7", None), ("0", "P1", 1, "boolean", "true", None), ("0", "P1", 2, "number", "2.5", None),
        ("0", "P1", 3, "null", None, None), ("0", "P2", 0, "string", "single", None),
    ], key=str)


@pytest.mark.parametrize("payload", [None, "", "no json {", "[1, 2]", "3", "{}", '{"claims": []}', '{"claims": "x"}', '{"claims": null}'])
def test_payloads_without_claims_have_no_rows(spark, payload):
    assert rows(spark, payload) == []


def test_same_texts_as_the_fixed_schema(spark):
    payload = {"claims": {"P1477": [claim({"text": "A"})], "P136": [claim({"id": "Q2"}), claim("rock")], "P18": [claim("x y.jpg")]}}
    fixed = spark.createDataFrame([(json.dumps(payload),)], "payload string").select(
        F.from_json("payload", "claims map<string, array<struct<mainsnak: struct<datavalue: struct<value: string>>>>>")["claims"].alias("c"))
    want = {
        (p, i): r for p in ("P1477", "P136", "P18")
        for i, r in enumerate(fixed.select(F.transform(C.values(F.col("c"), p), lambda v: C.claim_string(v, F.lit(None).cast("string"))).alias("t")).first()["t"])
    }
    assert {(r[1], r[2]): r[4] for r in rows(spark, payload)} == want


def test_extra_columns_stay(spark):
    df = spark.createDataFrame([(1, "k", json.dumps({"claims": {"P1": [claim("v")]}}))], "id int, key string, payload string")
    assert landed.claim_rows(df).columns == ["id", "key", "property", "n", "kind", "text", "time"]
    assert landed.claim_rows(df).first()["key"] == "k"
