"""The given tables seen as locations, conditions, observations and records.

Events play the observations and customers the locations; line items play the
observations of suppliers where conflicts and volume matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.operators import dims, facts
from obstar.operators.serving import Star
from obstar.schemas import MEASURES
from obstar.session import side_by_side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events and customers -------------------------------------------------------


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("pays")
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    placed = customer.join(places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return placed.select(F.col("c_custkey").alias("id_lieu"), F.col("c_name").alias("nom"), "region", "pays")


def outside_africa(df: DataFrame) -> DataFrame:
    return df.where(F.col("region") != "AFRICA")


def asia_unnamed(df: DataFrame) -> DataFrame:
    """The same places, those in Asia without a region."""
    return df.withColumn("region", F.when(F.col("region") != "ASIA", F.col("region")))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _code() -> Column:
    return (F.lit(1000) + F.ascii("event_type")).cast("int")


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        _code().alias("code_condition"), F.col("event_type").alias("texte_condition")
    ).distinct()


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", _k())
    return events.select(
        F.col("event_id").alias("id_observation_horaire"),
        F.col("user_id").alias("id_lieu"),
        F.col("ts").alias("datetime_observation"),
        F.col("value").cast("decimal(5,2)").alias("temperature_celsius"),
        (F.col("k") / 4).cast("decimal(5,2)").alias("vent_kph"),
        (F.col("k") * 3).alias("vent_degre"),
        F.upper("event_type").alias("direction_vent"),
        (F.col("k") / 8 + 950).cast("decimal(7,2)").alias("pression_millibars"),
        (F.col("k") / 8).cast("decimal(5,2)").alias("precipitation_mm"),
        F.minute("ts").alias("humidite_pourcentage"),
        F.hour("ts").alias("nuages_pourcentage"),
        F.dayofmonth("ts").cast("decimal(5,2)").alias("visibilite_km"),
        (F.col("k") / 10).cast("decimal(4,1)").alias("indice_uv"),
        (F.col("k") / 2).cast("decimal(5,2)").alias("rafales_kph"),
        _code().alias("code_condition"),
    )


def keyed(spark: SparkSession, sf_dir: str, dim_places=outside_africa) -> tuple[DataFrame, Star]:
    """Observations with their keys, and the dimensions (the fact left out)."""
    source, obs = locations(spark, sf_dir), observations(spark, sf_dir)
    dim_location, dim_condition, dim_time = side_by_side(
        lambda: dims.dim_location(dim_places(source)),
        lambda: dims.dim_condition(conditions(spark, sf_dir)),
        lambda: dims.dim_time(obs, "datetime_observation"),
    )
    resolved = facts.resolve(obs, source, dim_location, dim_condition, dim_time)
    return resolved, Star(None, dim_location, dim_time, dim_condition)


def star(spark: SparkSession, sf_dir: str) -> Star:
    rows, parts = keyed(spark, sf_dir, dim_places=lambda df: df)
    built = facts.fact_rows(
        rows, MEASURES, ["id_observation_horaire"], extra=["id_observation_horaire"]
    )
    return Star(built, parts.location, parts.time, parts.condition)


# --- JSON records made from events ----------------------------------------------


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, text): one JSON record per event, damaged according to props.k."""
    events = table(spark, sf_dir, "events").withColumn("k", _k())
    joined = events.join(locations(spark, sf_dir), F.col("user_id") == F.col("id_lieu"))
    k = F.col("k")
    record = F.struct(
        F.struct(F.col("nom").alias("name"), "region", F.col("pays").alias("country")).alias("location"),
        F.struct(
            F.date_format("ts", "yyyy-MM-dd HH:mm").alias("last_updated"),
            F.col("value").cast("decimal(10,2)").alias("temp_c"),
            F.struct(F.col("event_type").alias("text"), _code().alias("code")).alias("condition"),
            (k / 4).alias("wind_kph"),
            (k * 3).alias("wind_degree"),
            F.upper("event_type").alias("wind_dir"),
            (k / 8 + 950).alias("pressure_mb"),
            (k / 8).alias("precip_mm"),
            F.minute("ts").alias("humidity"),
            F.hour("ts").alias("cloud"),
            F.dayofmonth("ts").cast("double").alias("vis_km"),
            F.when(k.between(5, 9), F.lit(None)).otherwise(k / 10).alias("uv"),
            (k / 2).alias("gust_kph"),
        ).alias("current"),
    )
    written = joined.select("event_id", "k", F.to_json(record).alias("text"))
    text = F.col("text")

    def edit(field: str, value: str) -> Column:
        return F.regexp_replace(text, f'"{field}":("[^"]*"|[^,}}]*)', f'"{field}":{value}')

    damaged = (
        F.when(k < 5, F.expr("left(text, length(text) - 2)"))
        .when(k.between(10, 14), edit("temp_c", '"abc"'))
        .when(k.between(15, 19), F.regexp_replace(text, '"temp_c":([^,}]*)', '"temp_c":"$1"'))
        .when(k.between(20, 22), edit("humidity", "1.5"))
        .when(k.between(23, 25), edit("humidity", '"1.5"'))
        .when(k.between(26, 28), edit("wind_dir", '{"x":1}'))
        .when(k.between(29, 30), edit("cloud", '7,"feels_like":{"c":1}'))
        .when(k.between(31, 32), edit("cloud", "null"))
        .when(k == 33, edit("precip_mm", "1e400"))
        .when(k == 34, edit("cloud", "true"))
        .when(k == 35, edit("code", "99999999999"))
        .when(k == 36, edit("wind_kph", "1234.5"))
        .when(k == 37, edit("wind_dir", '"north by north-west"'))
        .otherwise(text)
    )
    return written.select("event_id", damaged.alias("text"))


# --- line items and suppliers ---------------------------------------------------

LINE_KEY = ["l_suppkey", "l_shipdate"]
LINE_ORDER = [
    "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_ORDER)
