"""Key resolution, facts, checks and the served views on small frames."""

import json
from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from obstar.operators import dims, facts, quality, serving
from obstar.operators.serving import Star
from obstar.plans.counts import load_counts

LIEUX = "id_lieu bigint, nom string, region string, pays string"
OBS = "id bigint, id_lieu bigint, datetime_observation timestamp_ntz, code_condition int, t double"


@pytest.fixture()
def places(spark):
    return spark.createDataFrame([(1, "X", None, "S"), (2, "Y", "r", "A"), (3, "Y", "r", "B")], LIEUX)


@pytest.fixture()
def observed(spark):
    def at(minute, second=0):
        return datetime(2024, 3, 9, 13, minute, second)

    data = [
        (1, 1, at(5, 7), 1000, 1.0),
        (2, 1, at(5, 40), 1000, 2.0),  # same minute: replaces the first
        (3, 2, at(5), 1000, 3.0),  # the dimension keeps Y in B: no such location
        (4, 3, at(6), 1003, 4.0),
        (5, 3, at(7), 9999, 5.0),  # unknown condition
        (6, 77, at(8), 9999, 6.0),  # unknown location and condition
        (7, 1, None, 1000, 7.0),  # no time: not a fact, nor a reject for its keys
    ]
    return spark.createDataFrame(data, OBS)


@pytest.fixture()
def keyed(spark, places, observed):
    kept = places.where("id_lieu <> 2")
    conditions = spark.createDataFrame([(1000, "Sunny"), (1003, "Cloudy")], "code_condition int, texte_condition string")
    dim_condition = dims.dim_condition(conditions)
    dim_time = dims.dim_time(observed, "datetime_observation")
    return facts.resolve(observed, places, dims.dim_location(kept), dim_condition, dim_time)


def test_missing_region_matches_missing_region(spark, places):
    keys = facts.location_keys(places, dims.dim_location(places.where("id_lieu <> 3")))
    assert rows(keys, "id_lieu", "id_dim_lieu_fk") == [(1, 1), (2, 2), (3, None)]


def test_facts_and_rejects(keyed):
    built = facts.fact_rows(keyed, ["t"], ["id"])
    assert rows(built, "id_dim_lieu_fk", "id_dim_temps_fk", "t") == [(1, 1, 2.0), (2, 2, 4.0)]
    assert rows(facts.unresolved(keyed, ["id"])) == [
        (3, "id_dim_lieu_fk"), (5, "id_dim_condition_fk"), (6, "id_dim_lieu_fk,id_dim_condition_fk"),
    ]


def test_counts_add_up(keyed, observed):
    assert rows(load_counts(keyed)) == [(6, 3, 3, 2)]
    assert load_counts(keyed.limit(0)).first().asDict() == dict.fromkeys(
        ["read", "dropped", "prepared", "facts"], 0
    )


def test_left_join_keeps_unknown_locations(observed, places):
    joined = facts.with_location(observed, places)
    assert joined.count() == observed.count()
    assert rows(joined.where("id_lieu = 77"), "id", "nom") == [(6, None)]


def test_constraint_checks(spark, observed, places):
    assert rows(quality.null_counts(observed, ["id", "datetime_observation"])) == [(0, 1)]
    repeated = quality.duplicate_keys(observed, ["id_lieu"])
    assert rows(repeated) == [(1, 3), (3, 2)]
    parents = {"id_lieu": (places, "id_lieu")}
    assert rows(quality.orphans(observed, parents), "id") == [(6,)]
    assert rows(quality.orphan_counts(observed, parents)) == [(7, 1)]


def test_coverage(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "city string")
    seen = spark.createDataFrame([("b",), ("b",), ("z",)], "city string")
    assert rows(quality.coverage(expected, seen, "city")) == [(3, 1, 2)]
    assert rows(quality.missing_keys(expected, seen, "city")) == [("a",), ("c",)]
    assert quality.expected_cities(spark).distinct().count() == 110


@pytest.fixture()
def star(spark):
    times = dims.dim_time(
        spark.createDataFrame(
            [(datetime(2024, 1, 31, 23, 59),), (datetime(2024, 2, 1, 0, 0),), (datetime(2024, 2, 1, 0, 1),)],
            "ts timestamp_ntz",
        ),
        "ts",
    )
    location = spark.createDataFrame(
        [(1, "X", None, "S"), (2, "Y", "r", "B")],
        "id_dim_lieu bigint, nom_ville string, region string, pays string",
    )
    condition = spark.createDataFrame(
        [(1, 1000, "Sunny")], "id_dim_condition bigint, code_condition int, texte_condition string"
    )
    data = [(10, 1, 1, 1, "1.50"), (11, 2, 2, 1, "2.50"), (12, 1, 2, 1, "3.50"), (13, 1, 3, 1, "4.50"),
            (14, 9, 3, 1, "5.50")]  # the last has no such location
    fact = spark.createDataFrame(
        data,
        "id_observation_horaire bigint, id_dim_lieu_fk bigint, id_dim_temps_fk bigint, "
        "id_dim_condition_fk bigint, t string",
    ).withColumn("t", F.col("t").cast("decimal(5,2)"))
    return Star(fact, location, times, condition)


def ids(df):
    return [r["id_observation_horaire"] for r in df.collect()]


def test_newest_first_and_orphans_take_no_place(star):
    assert ids(serving.latest(star)) == [13, 12, 11, 10]
    assert ids(serving.latest(star, n=2)) == [13, 12]
    assert sorted(ids(serving.star_join(star))) == [10, 11, 12, 13]


def test_city_and_period(star):
    assert ids(serving.latest(star, city="X")) == [13, 12, 10]
    assert ids(serving.latest(star, city="X", n=1)) == [13]
    assert ids(serving.latest(star, start=date(2024, 2, 1))) == [13, 12, 11]
    assert ids(serving.latest(star, end=date(2024, 2, 1))) == [10]
    assert ids(serving.latest(star, city="nowhere")) == []


def test_served_record(star):
    served = serving.as_json(serving.nested(serving.latest(star, n=1)))
    assert json.loads(served.first()["json"]) == {
        "id_observation_horaire": 13, "id_dim_lieu_fk": 1, "id_dim_temps_fk": 3,
        "id_dim_condition_fk": 1, "t": 4.5,
        "lieu": {"id_dim_lieu": 1, "nom_ville": "X", "region": None, "pays": "S"},
        "temps": {
            "id_dim_temps": 3, "date": "2024-02-01", "annee": 2024, "mois": 2, "jour": 1,
            "heure": 0, "minute": 1, "jour_semaine": "Thursday", "nom_mois": "February",
        },
        "condition": {"id_dim_condition": 1, "code_condition": 1000, "texte_condition": "Sunny"},
    }


def test_location_names(star):
    assert [r[0] for r in serving.location_names(star.location).collect()] == ["X", "Y"]
