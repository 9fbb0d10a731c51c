"""One function per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.functions import measures, times
from obstar.functions.measures import decimals_as_double
from obstar.operators import conflicts, dims, facts, ingest, merge, quality, serving
from obstar.operators.dedupe import first_per_key, last_per_key
from obstar.operators.keys import lookup
from obstar.operators.numbering import dense_ids
from obstar.plans import counts
from obstar.schemas import MEASURES
from obstar.session import materialize
from obstar.sources import runlog
from workload import mappings as M
from workload.runs import RUNS
from workload.mappings import table

CUT_OVER = datetime(1998, 1, 1)
RESENT_FROM = datetime(1997, 1, 1)


# --- records --------------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_records(M.records(spark, sf_dir), "text")


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten(ingest.valid(_parsed(spark, sf_dir)), ["event_id"])


def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.valid(_parsed(spark, sf_dir))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rejects(_parsed(spark, sf_dir), ["event_id"])


def ingest_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with values beyond their columns are kept, the values moved to the ends."""
    parsed = ingest.parse_records(M.records(spark, sf_dir), "text", on_overflow="clamp")
    return decimals_as_double(ingest.flatten(ingest.valid(parsed), ["event_id"], on_overflow="clamp"))


def flatten_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(_flat(spark, sf_dir))


def split_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.locations_of(_flat(spark, sf_dir))


def split_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.conditions_of(_flat(spark, sf_dir))


def staging_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = materialize(_flat(spark, sf_dir), "flat")  # feeds two relations
    name = ["nom", "region", "pays"]
    numbered = dense_ids(ingest.locations_of(flat), name, "id_lieu")
    placed = lookup(flat, numbered, name, ["id_lieu"], nullable=["region"])
    timed = placed.withColumn("datetime_observation", times.parse_strict(F.col("datetime_observation")))
    kept = first_per_key(timed, ["id_lieu", "datetime_observation"], ["event_id"])
    return decimals_as_double(
        kept.select("event_id", "id_lieu", "datetime_observation", *MEASURES, "code_condition")
    )


def measures_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return decimals_as_double(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_quantity").cast("decimal(5,2)").alias("quantity"),
            F.col("l_discount").cast("decimal(4,1)").alias("discount"),
            F.col("l_extendedprice").try_cast("decimal(7,2)").alias("price"),
            measures.fits(F.col("l_extendedprice"), "decimal(7,2)").alias("price_fits"),
        )
    )


def measures_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return decimals_as_double(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            measures.clamp(F.col("l_extendedprice"), "decimal(5,2)").alias("price"),
            measures.clamp(-F.col("l_extendedprice"), "decimal(7,2)").alias("refund"),
            measures.clamp_int(F.col("l_orderkey") * 1_000_000).alias("scaled_key"),
        )
    )


def _time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as text, those of errors with a 13th month."""
    month = F.when(F.col("event_type") == "error", "13").otherwise(F.date_format("ts", "MM"))
    text = F.concat(F.date_format("ts", "yyyy-"), month, F.date_format("ts", "-dd HH:mm:ss"))
    events = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return ingest.coerce_time(events, "text", "ts")


def time_coerce_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_text(spark, sf_dir).dropna(subset=["ts"]).select("event_id", "ts")


def time_coerce_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.coercion_counts(_time_text(spark, sf_dir), "text", "ts")


# --- dimensions and facts -------------------------------------------------------


def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_time(table(spark, sf_dir, "events"), "ts")


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_location(M.locations(spark, sf_dir))


def dim_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_condition(M.conditions(spark, sf_dir))


def obs_with_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = M.outside_africa(M.locations(spark, sf_dir))
    joined = facts.with_location(M.observations(spark, sf_dir), known)
    return joined.select("id_observation_horaire", "id_lieu", "nom", "region", "pays")


def resolve_location_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = M.asia_unnamed(M.locations(spark, sf_dir))
    dim = dims.dim_location(places)
    joined = facts.resolve_location(M.observations(spark, sf_dir), places, dim)
    return joined.select("id_observation_horaire", "id_dim_lieu_fk")


def resolve_condition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dims.dim_condition(M.conditions(spark, sf_dir).where("texte_condition <> 'error'"))
    joined = facts.resolve_condition(M.observations(spark, sf_dir), dim)
    return joined.select("id_observation_horaire", "id_dim_condition_fk")


def resolve_time_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = M.observations(spark, sf_dir)
    dim = dims.dim_time(obs, "datetime_observation")
    joined = facts.resolve_time(obs, dim, "datetime_observation")
    return joined.select("id_observation_horaire", "id_dim_temps_fk")


def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed, _ = M.keyed(spark, sf_dir)
    return decimals_as_double(facts.fact_rows(keyed, MEASURES, ["id_observation_horaire"]))


def fact_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed, _ = M.keyed(spark, sf_dir)
    return facts.unresolved(keyed, ["id_observation_horaire"])


def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed, _ = M.keyed(spark, sf_dir)
    return counts.load_counts(keyed)


# --- write semantics ------------------------------------------------------------


def insert_ignore_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items shipped before the cut-over are there; all are sent again, altered."""
    lines = M.lines(spark, sf_dir)
    target = first_per_key(lines.where(F.col("l_shipdate") < CUT_OVER), M.LINE_KEY, M.LINE_ORDER)
    resent = lines.withColumn("l_quantity", F.col("l_quantity") + 100)
    return merge.insert_ignore(target, resent, M.LINE_KEY, M.LINE_ORDER)


def insert_ignore_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    offered = table(spark, sf_dir, "events").select(
        F.get_json_object("props", "$.k").cast("int").alias("code_condition"),
        F.col("event_type").alias("texte_condition"),
        "event_id",
    )
    target = spark.createDataFrame([], offered.schema)
    return conflicts.insert_ignore_all(
        target, offered, [["code_condition"], ["texte_condition"]], ["event_id"]
    )


def insert_ignore_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two unique keys at volume: order lines offered as (order, part) pairs."""
    offered = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return conflicts.insert_ignore_all(
        spark.createDataFrame([], offered.schema),
        offered,
        [["l_orderkey"], ["l_partkey"]],
        ["l_orderkey", "l_partkey"],
    )


def insert_ignore_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is in the way of the next: one chain of conflicts through all of them."""
    event = F.col("event_id")
    offered = table(spark, sf_dir, "events").select(
        F.floor((event + 1) / 2).alias("a"), F.floor(event / 2).alias("b"), "event_id"
    )
    return conflicts.insert_ignore_all(
        spark.createDataFrame([], offered.schema), offered, [["a"], ["b"]], ["event_id"]
    )


def _moved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Locations of two batches: the second has everybody, builders moved on."""
    customer = table(spark, sf_dir, "customer")
    places = M.places(spark, sf_dir)

    def placed(rows: DataFrame, nation) -> DataFrame:
        return rows.withColumn("_nation", nation).join(
            places, F.col("_nation") == F.col("n_nationkey")
        ).select(F.col("c_name").alias("nom_ville"), "region", "pays", F.col("c_custkey").alias("_order"))

    home = F.col("c_nationkey")
    following = F.when(home == 24, 0).otherwise(home + 1)
    first = placed(customer.where("c_mktsegment <> 'AUTOMOBILE'"), home)
    builder = F.col("c_mktsegment") == "BUILDING"
    second = placed(customer, F.when(builder, following).otherwise(home))
    return first, second


def upsert_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _moved(spark, sf_dir)
    names = ["id_dim_lieu", "nom_ville", "region", "pays"]
    target = dense_ids(first.drop("_order"), ["nom_ville"], "id_dim_lieu").select(*names)
    return merge.upsert(target, second, ["nom_ville"], ["_order"], id_column="id_dim_lieu")


def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _moved(spark, sf_dir)
    target = first.drop("_order")
    actions = merge.upsert_actions(target, second, ["nom_ville"], ["_order"])
    return merge.count_actions(actions)


def upsert_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items up to the cut-over are loaded; the last year of them and all
    later ones arrive, returned ones with another quantity."""
    lines = M.lines(spark, sf_dir)
    loaded = last_per_key(lines.where(F.col("l_shipdate") < CUT_OVER), M.LINE_KEY, M.LINE_ORDER)
    target = dense_ids(loaded, M.LINE_KEY, "id_observation")
    returned = F.col("l_returnflag") == "R"
    arriving = lines.where(F.col("l_shipdate") >= RESENT_FROM).withColumn(
        "l_quantity", F.when(returned, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    return merge.upsert(target, arriving, M.LINE_KEY, M.LINE_ORDER, id_column="id_observation")


def upsert_all_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    pair = ["l_partkey", "l_suppkey"]
    target = lines.where("l_returnflag = 'A'").select(*pair).distinct()
    return merge.upsert(target, lines.select(*pair), pair, pair)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment after another get keys; the first ones keep theirs."""
    customer = table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_mktsegment")
    known = dense_ids(customer.where("c_mktsegment = 'BUILDING'"), ["c_name"], "id_customer")
    return merge.insert_ignore(known, customer, ["c_name"], ["c_custkey"], id_column="id_customer")


# --- checks and counts ----------------------------------------------------------


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = {
        "id_lieu": (M.outside_africa(M.locations(spark, sf_dir)), "id_lieu"),
        "code_condition": (
            M.conditions(spark, sf_dir).where("texte_condition <> 'error'"), "code_condition",
        ),
    }
    rows = M.observations(spark, sf_dir).select("id_observation_horaire", "id_lieu", "code_condition")
    return quality.orphans(rows, parents)


def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").join(
        M.outside_africa(M.places(spark, sf_dir)), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return quality.orphan_counts(
        table(spark, sf_dir, "lineitem"),
        {
            "l_orderkey": (table(spark, sf_dir, "orders"), "o_orderkey"),
            "l_partkey": (table(spark, sf_dir, "part"), "p_partkey"),
            "l_suppkey": (supplier, "s_suppkey"),
        },
    )


def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed, _ = M.keyed(spark, sf_dir)
    return quality.null_counts(keyed, [*facts.FOREIGN_KEYS, "temperature_celsius"])


def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _expected_and_seen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return expected, table(spark, sf_dir, "events")


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage(*_expected_and_seen(spark, sf_dir), "user_id")


def coverage_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_keys(*_expected_and_seen(spark, sf_dir), "user_id")


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log rows: a user is a process, the event type its status."""
    status = (
        F.when(F.col("event_type") == "purchase", runlog.SUCCESS)
        .when(F.col("event_type") == "error", runlog.FAILED)
        .otherwise(runlog.RUNNING)
    )
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("process_name"),
        status.alias("status"),
        F.col("ts").alias("start_time"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("log_id"),
        F.col("props").alias("error_message"),
    )
    return runlog.status(log)


# --- serving --------------------------------------------------------------------


def locations_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = M.locations(spark, sf_dir).select(F.col("nom").alias("nom_ville"))
    return serving.location_names(names)


def latest_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest(M.star(spark, sf_dir))


def latest_observations_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.as_json(serving.nested(serving.latest(M.star(spark, sf_dir))))


def observations_by_city_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest(
        M.star(spark, sf_dir),
        city="Customer#000000007",
        start=date(2024, 1, 5),
        end=date(2024, 1, 25),
    )


def observations_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cities: more rows than the list without a filter has."""
    return serving.latest(M.star(spark, sf_dir), start=date(2024, 1, 5), end=date(2024, 1, 25))


def star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = serving.star_join(M.star(spark, sf_dir))
    return joined.select(
        "id_observation_horaire", "nom_ville", "region", "pays", "date", "heure", "minute",
        "jour_semaine", "nom_mois", "texte_condition",
        F.col("temperature_celsius").cast("double").alias("temperature_celsius"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        ingest_valid, ingest_rejects, flatten_observations, split_locations, split_conditions,
        staging_observations, measures_decimal, measures_clamped, time_coerce_valid,
        time_coerce_stats, dim_time, dim_location, dim_condition, obs_with_location,
        resolve_location_key, resolve_condition_key, resolve_time_key, fact_build, fact_rejects,
        load_stats, insert_ignore_observations, insert_ignore_conditions, insert_ignore_pairs,
        insert_ignore_chain,
        upsert_dim_location, upsert_actions, upsert_fact, upsert_all_key, surrogate_keys,
        fk_orphans, fk_audit, quality_not_null, quality_unique, coverage_report, coverage_missing,
        run_status, locations_list, latest_observations, latest_observations_json,
        observations_by_city_period, observations_by_period, ingest_clamped, star_view,
    )
} | RUNS
