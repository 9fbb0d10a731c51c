"""Coercion and rejection of single records."""

import json
from decimal import Decimal

import pytest
from helpers import record, rows

from obstar.operators import ingest
from obstar.schemas import OBSERVATION


def parse(spark, *texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return ingest.parse_records(df, "text", **options)


def judged(spark, text, **options):
    row = parse(spark, text, **options).first()
    return row, {(e["field"], e["reason"]) for e in row["errors"]}


@pytest.mark.parametrize(
    ("field", "given", "column", "want"),
    [
        ("humidity", 1.5, "humidity", 1),
        ("humidity", -1.7, "humidity", -1),
        ("humidity", "12", "humidity", 12),
        ("humidity", True, "humidity", 1),
        ("temp_c", "28.3", "temp_c", 28.3),
        ("temp_c", True, "temp_c", 1.0),
        ("temp_c", 28, "temp_c", 28.0),
        ("wind_dir", 5, "wind_dir", "5"),
        ("wind_dir", True, "wind_dir", "true"),
        ("wind_dir", "{N}", "wind_dir", "{N}"),
    ],
)
def test_accepted(spark, field, given, column, want):
    row, errors = judged(spark, record(**{field: given}))
    assert errors == set()
    assert row[column] == want


@pytest.mark.parametrize(
    ("field", "given", "reason"),
    [
        ("humidity", "1.5", "uncoercible"),
        ("humidity", 99999999999, "uncoercible"),
        ("temp_c", "abc", "uncoercible"),
        ("temp_c", "NaN", "not_finite"),
        ("temp_c", 1234.5, "out_of_range"),
        ("temp_c", 999.995, "out_of_range"),
        ("wind_dir", {"x": 1}, "uncoercible"),
        ("wind_dir", ["N"], "uncoercible"),
        ("wind_dir", "north by north-west", "too_long"),
        ("uv", None, "missing"),
    ],
)
def test_rejected(spark, field, given, reason):
    _, errors = judged(spark, record(**{field: given}))
    assert errors == {(field, reason)}


def test_infinite_number_is_rejected(spark):
    _, errors = judged(spark, record().replace('"precip_mm": 0.0', '"precip_mm": 1e400'))
    assert errors == {("precip_mm", "not_finite")}


def test_null_is_missing_and_extra_fields_are_ignored(spark):
    _, errors = judged(spark, record().replace('"cloud": 10', '"cloud": null, "feels_like": 9'))
    assert errors == {("cloud", "missing")}


@pytest.mark.parametrize("text", ["{", "", "not json", record()[:-2], record() + "}"])
def test_malformed(spark, text):
    _, errors = judged(spark, text)
    assert errors == {("$", "malformed")}


def test_repeated_key_is_malformed(spark):
    _, errors = judged(spark, record().replace('"cloud": 10', '"cloud": 10, "cloud": 11'))
    assert errors == {("$", "malformed")}


@pytest.mark.parametrize("text", ['{"error":{}}', "5", "[1]", '{"location":3,"current":"x"}'])
def test_other_json_lacks_every_field(spark, text):
    _, errors = judged(spark, text)
    assert errors == {(f.name, "missing") for f in OBSERVATION}


def test_other_records_are_kept(spark):
    parsed = parse(spark, record(), "broken", record(temp_c="abc", uv=None), record(name="Thies"))
    assert rows(ingest.valid(parsed), "id") == [(0,), (3,)]
    assert rows(ingest.rejects(parsed, ["id"])) == [
        (1, "$", "malformed"), (2, "temp_c", "uncoercible"), (2, "uv", "missing"),
    ]


def test_clamping_on_request(spark):
    text = record(temp_c=1234.5, uv=-99999, wind_dir="north by north-west")
    parsed = parse(spark, text, on_overflow="clamp")
    flat = ingest.flatten(ingest.valid(parsed), on_overflow="clamp").first()
    assert flat["temperature_celsius"] == Decimal("999.99")
    assert flat["indice_uv"] == Decimal("-999.9")
    assert flat["direction_vent"] == "north by n"


def test_flatten_rounds_half_up(spark):
    flat = ingest.flatten(ingest.valid(parse(spark, record(temp_c=28.345, uv=6.25)))).first()
    assert flat["temperature_celsius"] == Decimal("28.35")
    assert flat["indice_uv"] == Decimal("6.3")
    assert (flat["nom"], flat["code_condition"]) == ("Dakar", 1000)


def test_whole_record_round_trip(spark):
    row, _ = judged(spark, record())
    given = json.loads(record())
    assert row["name"] == given["location"]["name"]
    for field in OBSERVATION:
        node = given
        for part in field.path[2:].split("."):
            node = node[part]
        assert row[field.name] == node
