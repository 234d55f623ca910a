"""Literal cases of the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from assaylake.functions import json_paths, text, transforms, units, urls
from assaylake.operators import composition


def apply(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in rows.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


def test_doi(spark):
    values = ["https://doi.org/10.1016/J.X.2020.1.", "doi: 10.1/x", None, "see 10.1234/ab-c_(1);", ""]
    assert apply(spark, text.doi, values) == ["10.1016/j.x.2020.1", None, None, "10.1234/ab-c_(1", None]


def test_title_key(spark):
    assert apply(spark, text.title_key, ["Straße – Test!", None, "  A  b "]) == ["strasse test", "", "a b"]


def test_printed_number(spark):
    assert apply(spark, text.printed_number, ["−3", "1,234", "abc", "/", "–", "12.5†", "(7)", "", None, "1e3", "12,34"]) == [-3.0, 1234.0, None, None, None, 12.5, 7.0, None, None, 1000.0, None]


def test_specimen_type(spark):
    assert apply(spark, text.specimen_type, ["Mortar bars", "paste and mortar", "steel", None, "混凝土"]) == ["mortar", None, None, None, "concrete"]


def test_foaming_agent(spark):
    assert apply(spark, text.foaming_agent, ["H₂O₂", "SPC", "H2O2 + SPC", "spcx", None]) == ["h2o2", "spc", "foaming_agent", "foaming_agent", "foaming_agent"]


def test_header_unit(spark):
    values = ["NaOH 10 M (kg/m3)", "Fibre vol. %", "CaO (wt%)", "Share %", "L/S mass ratio", "SiO2/Al2O3 molar ratio", "w/b ratio", "Code", "(g) (kg)"]
    assert apply(spark, lambda c: text.header_unit(c, F.lit("none")), values) == ["kg/m3", "vol.%", "wt.%", "%", "mass ratio", "molar ratio", "ratio", "none", "none"]


def test_coded_composition(spark):
    assert apply(spark, text.coded_composition, ["C70G30U0", "C70G40", "mix", "C50C50"]) == [{"C": 70.0, "G": 30.0, "U": 0.0}, None, None, None]


def test_sentences_and_snippet(spark):
    assert apply(spark, text.sentences, ["One.  Two! \n One. Three"]) == [["One.", "Two!", "Three"]]
    (found,) = apply(spark, text.truncated_snippet, ["x" * 300])
    assert len(found["snippet"]) == 240 and len(found["sha256"]) == 64


def test_utc_time(spark):
    found = apply(spark, text.utc_time, ["2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00", "x", None])
    assert found[0] == found[1] and found[0] is not None and found[2:] == [None, None, None]


def test_canonical_https(spark):
    values = ["HTTPS://Ex.COM:443?a=1#top", "https://u:p@ex.com/", "http://ex.com", "https://ex.com:8443/a;b?c", "https://ex.com", None, "x"]
    assert apply(spark, urls.canonical_https, values) == ["https://ex.com/?a=1", None, None, "https://ex.com:8443/a;b?c", "https://ex.com/", None, None]


def test_outcome(spark):
    rows = spark.createDataFrame([(200, None), (401, None), (404, None), (429, None), (None, "PROTOCOL:x"), (200, "timeout"), (None, None)], "s int, e string")
    assert [r[0] for r in rows.select(urls.outcome(F.col("s"), F.col("e"))).collect()] == ["HTTP_STATUS_200", "DENIED", "NOT_FOUND", "RATE_LIMITED", "PROTOCOL_ERROR", "TRANSPORT_ERROR", "TRANSPORT_ERROR"]


def test_units(spark):
    rows = spark.createDataFrame([("field", "specific_surface_m2_kg", "cm2/g", 3500.0), ("field", "true_density_kg_m3", "g/cm³", 2.9), ("field", "age_seconds", "d", 28.0), ("performance", "elastic_modulus", "GPa", 2.0), ("field", "x", "y", 1.0)], "kind string, name string, unit string, value double")
    found = {r["name"]: (round(r["converted"], 6), r["target_unit"], round(r["reverse"], 6)) for r in units.convert(rows).collect()}
    assert found == {"specific_surface_m2_kg": (350.0, "m2/kg", 3500.0), "true_density_kg_m3": (2900.0, "kg/m3", 2.9), "age_seconds": (2419200.0, "s", 28.0), "elastic_modulus": (2000.0, "MPa", 2.0), "x": (1.0, "y", 1.0)}
    assert apply(spark, units.ratio, ["1/2", "3 | 4", "a/b", "1/0"]) == [0.5, 0.75, None, None]


AXIS = {"value": 7.0, "positions": [0.0, 50.0], "values": [10.0, 60.0]}
SOUND = {  # inputs, output, reverse
    transforms.SCALE: ({"value": 7.0, "scale": 60.0}, 420.0, 7.0), transforms.COMPLEMENT: ({"value": 7.0, "total": 100.0, "component_count": 2}, 93.0, 7.0), transforms.FRACTION: ({"components": [3.0, 7.0]}, 30.0, 3 / 7), transforms.LINEAR: (AXIS, 17.0, 7.0),
    transforms.LOG: (AXIS | {"values": [0.0, 2.0]}, 10**0.28, 7.0), transforms.PIXEL: ({"value": 7.0, "positions": [0.0, 50.0], "values": [10.0, 60.0]}, 53.0, 7.0), transforms.COMPONENT: ({"components": [3.0, 7.0], "token": "3:7"}, 7.0, None),
}


def receipt(name, **changes):
    if name == transforms.DURATIONS:
        own = {"inputs": {"steps": [{"value": 1.0, "scale": 86400.0}, {"value": 2.0, "scale": 3600.0}]}, "output": {"values": [86400.0, 7200.0]}, "forward": {"recorded_list": [86400.0, 7200.0]}, "reverse": {"recorded_list": [1.0, 2.0]}}
    else:
        inputs, out, back = SOUND[name]
        own = {"inputs": inputs, "output": {"value": out, "component": 1}, "forward": {"computed": out, "recorded": out}, "reverse": {"computed": back, "recorded": back, "computed_token": "3:7", "recorded_token": "3:7"}}
    own["forward"]["tolerance"] = own["reverse"]["tolerance"] = 2e-3
    return {"formal": True, "formula": "f", "kind": name} | own | changes


def told(spark, own, actual, actual_list=None):
    rows = spark.createDataFrame([(None if own is None else json.dumps(own), actual, actual_list)], "r string, a double, l array<double>")
    return rows.select(transforms.receipt_defects(F.from_json("r", transforms.RECEIPT), F.col("a"), F.col("l"))).first()[0]


@pytest.mark.parametrize("kind", transforms.KINDS)
def test_receipts(spark, kind):
    out, many = (None, [86400.0, 7200.0]) if kind == transforms.DURATIONS else (SOUND[kind][1], None)
    off = (out + 1, None) if many is None else (None, [86400.0, 7201.0])
    assert told(spark, receipt(kind), out, many) == []
    assert told(spark, receipt(kind), *off) == ["TRANSFORM_OUTPUT_RECORD_DRIFT"]
    moved = receipt(kind)
    moved["output"] = {"value": off[0], "values": off[1], "component": 1}
    assert "FORWARD_RECOMPUTE_FAILED" in told(spark, moved, *off)
    assert told(spark, receipt(kind, formal=None), out, many) == ["TRANSFORM_NOT_FORMAL_OR_FORMULA_MISSING"]
    assert told(spark, receipt(kind, reverse=None), out, many) == ["TRANSFORM_RECEIPT_INCOMPLETE"]


def test_receipts_that_are_no_case_of_their_kind(spark):
    broken = {"INVALID_BINARY_MASS_BASIS": (transforms.COMPLEMENT, {"value": 101.0, "total": 100.0, "component_count": 2}), "INVALID_STANDARD_RATIO": (transforms.FRACTION, {"components": [3.0]}), "INVALID_LINEAR_AXIS": (transforms.LINEAR, AXIS | {"values": [1.0, 1.0]})}
    assert [told(spark, receipt(kind, inputs=i), 1.0) for kind, i in broken.values()] == [[name] for name in broken]
    assert told(spark, receipt(transforms.FRACTION, output={"value": 100.0}), 1.0) == ["INVALID_STANDARD_FRACTION"]
    assert told(spark, receipt(transforms.SCALE, kind="folklore"), 420.0) == ["UNKNOWN_TRANSFORM_KIND:folklore"]
    assert told(spark, None, 1.0) == ["FORMAL_TRANSFORM_RECEIPT_MISSING"]


def test_header_units(spark):
    headers = ["Cement (kg/m³)", "Cement （kg/m3）", "NaOH 10 M [mol/L]", "x (g) (kg) %", "vol. %", "fly ash % by volume", "wt%", "Slag (mass)", "SiO2/Na2O molar ratio", "w/b ratio", "Sand (Vol.)", "d50", None]
    assert apply(spark, lambda c: text.header_unit(c, F.lit("?")), headers) == ["kg/m3", "kg/m3", "mol/L", "%", "vol.%", "vol.%", "wt.%", "mass ratio", "molar ratio", "ratio", "volume ratio", "?", "?"]
    assert apply(spark, text.specimen_key, [" A1 \n", "", None]) == ["A1", None, None]


def test_json(spark):
    assert apply(spark, lambda c: json_paths.read(c, "/a~1b/1"), ['{"a/b": [1, "x"]}', "{}", "broken", None]) == ["x", None, None, None]
    assert apply(spark, json_paths.value_kind, ["1", "1.5", '"a"', "[]", "{}", "true", "null", "{"]) == ["number", "number", "string", "array", "object", "boolean", "null", None]
    one = spark.range(1).select(json_paths.content_id(b=F.lit(1), a=F.lit(None).cast("string")), json_paths.content_id(a=F.lit(None).cast("string"), b=F.lit(1))).first()
    assert one[0] == one[1]


def test_printed_bounds(spark):
    rows = spark.createDataFrame([("g", "10.0"), ("g", "30"), ("g", "60.00")], "g string, t string").withColumn("v", F.col("t").cast("double"))
    found = {r["t"]: r for r in composition.bounds(rows, "g", "v", composition.printed_half_step(F.col("t"))).collect()}
    assert found["30"]["lower"] == pytest.approx(100 * 29.5 / (29.5 + 10.05 + 60.005)) and found["30"]["upper"] == pytest.approx(100 * 30.5 / (30.5 + 9.95 + 59.995))
    assert all(r["lower"] <= r["percent"] <= r["upper"] for r in found.values())
