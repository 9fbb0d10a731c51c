"""Fixed schemas of the staging, warehouse and log tables, and the record contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(4,1)": T.DecimalType(4, 1),
    "DECIMAL(5,2)": T.DecimalType(5, 2),
    "DECIMAL(7,2)": T.DecimalType(7, 2),
}


def _schema(columns: str) -> T.StructType:
    """A schema from "name TYPE, …", without a session."""
    pairs = [c.split() for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[sql_type]) for name, sql_type in pairs])


# --- fixed values: column names, types and keys are the data contract ---------

_MEASURES = (
    "temperature_celsius DECIMAL(5,2), vent_kph DECIMAL(5,2), vent_degre INT, "
    "direction_vent STRING, pression_millibars DECIMAL(7,2), precipitation_mm DECIMAL(5,2), "
    "humidite_pourcentage INT, nuages_pourcentage INT, visibilite_km DECIMAL(5,2), "
    "indice_uv DECIMAL(4,1), rafales_kph DECIMAL(5,2)"
)

LIEUX = _schema("id_lieu BIGINT, nom STRING, region STRING, pays STRING")
CONDITIONS_METEO = _schema("code_condition INT, texte_condition STRING")
DONNEES_METEO = _schema(
    "id_observation_horaire BIGINT, id_lieu BIGINT, datetime_observation TIMESTAMP_NTZ, "
    + _MEASURES
    + ", code_condition INT"
)

DIM_TEMPS = _schema(
    "id_dim_temps BIGINT, date DATE, annee INT, mois INT, jour INT, heure INT, minute INT, "
    "jour_semaine STRING, nom_mois STRING"
)
DIM_LIEUX = _schema("id_dim_lieu BIGINT, nom_ville STRING, region STRING, pays STRING")
DIM_CONDITIONS = _schema("id_dim_condition BIGINT, code_condition INT, texte_condition STRING")
FAIT = _schema(
    "id_observation_horaire BIGINT, id_dim_lieu_fk BIGINT, id_dim_temps_fk BIGINT, "
    "id_dim_condition_fk BIGINT, " + _MEASURES
)

RUN_LOG = _schema(
    "log_id BIGINT, process_name STRING, status STRING, start_time TIMESTAMP, "
    "end_time TIMESTAMP, error_message STRING, rows_processed BIGINT, created_at TIMESTAMP"
)

MEASURES = [f.name for f in _schema(_MEASURES).fields]

STAGING = {
    "lieux": LIEUX,
    "conditions_meteo": CONDITIONS_METEO,
    "donnees_meteo": DONNEES_METEO,
}

WAREHOUSE = {
    "DimTemps": DIM_TEMPS,
    "DimLieux": DIM_LIEUX,
    "DimConditionsMeteo": DIM_CONDITIONS,
    "FaitDonneesMeteo": FAIT,
}

TIME_KEY = ["date", "heure", "minute"]
LOCATION_KEY = ["nom_ville"]
CONDITION_KEY = ["code_condition"]
FACT_KEY = ["id_dim_lieu_fk", "id_dim_temps_fk"]


@dataclass(frozen=True)
class Field:
    """One required input field and the staging column it becomes."""

    name: str  # name in the parsed record
    path: str  # JSON path
    kind: str  # string | int | double
    column: str  # staging column
    sql_type: str  # staging type
    max_length: int | None = None


OBSERVATION = (
    Field("name", "$.location.name", "string", "nom", "string", 255),
    Field("region", "$.location.region", "string", "region", "string", 255),
    Field("country", "$.location.country", "string", "pays", "string", 255),
    Field("last_updated", "$.current.last_updated", "string", "datetime_observation", "string"),
    Field("temp_c", "$.current.temp_c", "double", "temperature_celsius", "decimal(5,2)"),
    Field("condition_text", "$.current.condition.text", "string", "texte_condition", "string", 255),
    Field("condition_code", "$.current.condition.code", "int", "code_condition", "int"),
    Field("wind_kph", "$.current.wind_kph", "double", "vent_kph", "decimal(5,2)"),
    Field("wind_degree", "$.current.wind_degree", "int", "vent_degre", "int"),
    Field("wind_dir", "$.current.wind_dir", "string", "direction_vent", "string", 10),
    Field("pressure_mb", "$.current.pressure_mb", "double", "pression_millibars", "decimal(7,2)"),
    Field("precip_mm", "$.current.precip_mm", "double", "precipitation_mm", "decimal(5,2)"),
    Field("humidity", "$.current.humidity", "int", "humidite_pourcentage", "int"),
    Field("cloud", "$.current.cloud", "int", "nuages_pourcentage", "int"),
    Field("vis_km", "$.current.vis_km", "double", "visibilite_km", "decimal(5,2)"),
    Field("uv", "$.current.uv", "double", "indice_uv", "decimal(4,1)"),
    Field("gust_kph", "$.current.gust_kph", "double", "rafales_kph", "decimal(5,2)"),
)

# The keys a complete run is expected to cover, by country.
EXPECTED_CITIES = (
    # Benin
    "Africa/Porto-Novo", "Africa/Cotonou", "Africa/Parakou", "Africa/Abomey-Calavi",
    "Africa/Djougou", "Africa/Bohicon", "Africa/Kandi", "Africa/Natitingou", "Africa/Ouidah",
    "Africa/Lokossa", "Africa/Savalou", "Africa/Sakete", "Africa/Dassa-Zoume",
    "Africa/Malanville", "Africa/Pobe",
    # Burkina Faso
    "Africa/Ouagadougou", "Africa/Bobo-Dioulasso", "Africa/Koudougou", "Africa/Ouahigouya",
    "Africa/Banfora", "Africa/Fada_Ngourma", "Africa/Dedougou", "Africa/Nouna", "Africa/Dori",
    "Africa/Manga", "Africa/Tenkodogo", "Africa/Ziniare",
    # Côte d'Ivoire
    "Africa/Abidjan", "Africa/Yamoussoukro", "Africa/Bouake", "Africa/Daloa", "Africa/Korhogo",
    "Africa/Man", "Africa/San-Pedro", "Africa/Gagnoa", "Africa/Divo", "Africa/Anyama",
    "Africa/Adzope", "Africa/Abengourou", "Africa/Grand-Bassam", "Africa/Aboisso",
    "Africa/Seguela",
    # Guinée-Bissau
    "Africa/Bissau", "Africa/Bafata", "Africa/Gabu", "Africa/Canchungo", "Africa/Cacheu",
    "Africa/Bolama", "Africa/Bissora", "Africa/Farim", "Africa/Catio", "Africa/Buba",
    # Mali
    "Africa/Bamako", "Africa/Sikasso", "Africa/Segou", "Africa/Mopti", "Africa/Kayes",
    "Africa/Koutiala", "Africa/Gao", "Africa/Kati", "Africa/San", "Africa/Timbuktu",
    "Africa/Niono", "Africa/Bougouni", "Africa/Kidal", "Africa/Tessalit",
    # Niger
    "Africa/Niamey", "Africa/Zinder", "Africa/Maradi", "Africa/Tahoua", "Africa/Agadez",
    "Africa/Arlit", "Africa/Dosso", "Africa/Diffa", "Africa/Birni-N'Konni", "Africa/Gaya",
    "Africa/Tillaberi", "Africa/Tera",
    # Sénégal
    "Africa/Dakar", "Africa/Pikine", "Africa/Touba", "Africa/Thies", "Africa/Saint-Louis",
    "Africa/Kaolack", "Africa/Ziguinchor", "Africa/Mbour", "Africa/Rufisque", "Africa/Diourbel",
    "Africa/Tambacounda", "Africa/Louga", "Africa/Kolda", "Africa/Fatick", "Africa/Kaffrine",
    "Africa/Sedhiou", "Africa/Kedougou", "Africa/Matam",
    # Togo
    "Africa/Lome", "Africa/Sokode", "Africa/Kara", "Africa/Kpalime", "Africa/Atakpame",
    "Africa/Dapaong", "Africa/Tsevie", "Africa/Aneho", "Africa/Mango", "Africa/Bassar",
    "Africa/Tchamba", "Africa/Niamtougou", "Africa/Notse", "Africa/Vogan",
)
# --- end of fixed values -------------------------------------------------------
