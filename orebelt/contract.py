"""Fixed values shared by every layer: names, codes, labels, thresholds.

Nothing here is logic. The values are part of the data contract: published
tables, dashboards and stored reports depend on them letter by letter.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: dataset types ------------------------------------------

TAXI_TYPES = ("fhv", "fhvhv", "green", "yellow")

# --- Fixed values: source schemas per dataset type ------------------------

SOURCE_SCHEMAS = {
    "yellow": {
        "VendorID": "int",
        "tpep_pickup_datetime": "timestamp",
        "tpep_dropoff_datetime": "timestamp",
        "passenger_count": "int",
        "trip_distance": "double",
        "RatecodeID": "int",
        "store_and_fwd_flag": "string",
        "PULocationID": "int",
        "DOLocationID": "int",
        "payment_type": "int",
        "fare_amount": "double",
        "extra": "double",
        "mta_tax": "double",
        "tip_amount": "double",
        "tolls_amount": "double",
        "improvement_surcharge": "double",
        "total_amount": "double",
        "congestion_surcharge": "double",
        "airport_fee": "double",
    },
    "green": {
        "VendorID": "int",
        "lpep_pickup_datetime": "timestamp",
        "lpep_dropoff_datetime": "timestamp",
        "store_and_fwd_flag": "string",
        "RatecodeID": "int",
        "PULocationID": "int",
        "DOLocationID": "int",
        "passenger_count": "int",
        "trip_distance": "double",
        "fare_amount": "double",
        "extra": "double",
        "mta_tax": "double",
        "tip_amount": "double",
        "tolls_amount": "double",
        "ehail_fee": "double",
        "improvement_surcharge": "double",
        "total_amount": "double",
        "payment_type": "int",
        "trip_type": "int",
        "congestion_surcharge": "double",
    },
    "fhv": {
        "pickup_datetime": "timestamp",
        "dropoff_datetime": "timestamp",
        "PULocationID": "int",
        "DOLocationID": "int",
        "SR_Flag": "int",
        "Affiliated_base_number": "string",
    },
    "fhvhv": {
        "hvfhs_license_num": "string",
        "dispatching_base_num": "string",
        "originating_base_num": "string",
        "request_datetime": "timestamp",
        "on_scene_datetime": "timestamp",
        "pickup_datetime": "timestamp",
        "dropoff_datetime": "timestamp",
        "PULocationID": "int",
        "DOLocationID": "int",
        "trip_miles": "double",
        "trip_time": "int",
        "base_passenger_fare": "double",
        "tolls": "double",
        "bcf": "double",
        "sales_tax": "double",
        "congestion_surcharge": "double",
        "airport_fee": "double",
        "tips": "double",
        "driver_pay": "double",
        "shared_request_flag": "string",
        "shared_match_flag": "string",
        "access_a_ride_flag": "string",
        "wav_request_flag": "string",
        "wav_match_flag": "string",
        "cbd_congestion_fee": "double",
    },
}

# --- Fixed values: type ranking, widest first -----------------------------

TYPE_WIDTH = (
    "string", "timestamp", "double", "float", "decimal",
    "bigint", "int", "smallint", "tinyint", "boolean",
)

ACCEPTED_TYPES = (
    "tinyint", "smallint", "int", "bigint", "float", "double", "decimal",
    "string", "boolean", "date", "timestamp", "timestamp_ntz",
)

PROFILED_NUMERIC_TYPES = ("double", "float", "int", "bigint")


# --- Fixed values: canonical trip table -----------------------------------


@dataclass(frozen=True)
class Field:
    """One canonical column: name, type and the source names that may feed it."""

    name: str
    dtype: str
    sources: tuple[str, ...] = ()


CANONICAL_FIELDS = (
    Field("pickup_datetime", "timestamp_ntz", ("pickup_datetime", "tpep_pickup_datetime", "lpep_pickup_datetime")),
    Field("dropoff_datetime", "timestamp_ntz", ("dropoff_datetime", "tpep_dropoff_datetime", "lpep_dropoff_datetime")),
    Field("pickup_location_id", "int", ("pickup_location_id", "pulocationid", "pu_location_id", "pu_locationid")),
    Field("dropoff_location_id", "int", ("dropoff_location_id", "dolocationid", "do_location_id", "do_locationid")),
    Field("distancia_millas", "double", ("distancia_millas", "trip_distance", "distance_miles")),
    Field("monto_base", "double", ("monto_base", "fare_amount", "base_passenger_fare")),
    Field("monto_total", "double", ("monto_total", "total_amount", "base_passenger_fare")),
    Field("propina", "double", ("propina", "tip_amount", "tips")),
    Field("peajes", "double", ("peajes", "tolls_amount", "tolls")),
    Field("extra", "double", ("extra",)),
    Field("mta_tax", "double", ("mta_tax",)),
    Field("improvement_surcharge", "double", ("improvement_surcharge",)),
    Field("congestion_surcharge", "double", ("congestion_surcharge",)),
    Field("airport_fee", "double", ("airport_fee", "airportfee")),
    Field("cbd_congestion_fee", "double", ("cbd_congestion_fee",)),
    Field("ehail_fee", "double", ("ehail_fee",)),
    Field("payment_type", "int", ("payment_type", "paymenttype")),
    Field("passenger_count", "double", ("passenger_count", "passengercount")),
    Field("vendor_id", "string", ("vendor_id", "vendorid")),
    Field("ratecode_id", "int", ("ratecode_id", "ratecodeid")),
    Field("trip_type", "int", ("trip_type",)),
    Field("shared_ride_flag", "int", ("shared_ride_flag", "sr_flag")),
)

# Candidates the high-volume files need in addition; off for strict parity.
HIGH_VOLUME_SOURCES = {
    "distancia_millas": ("trip_miles",),
    "shared_ride_flag": ("shared_request_flag",),
}

CANONICAL_ORDER = (
    "tipo_dataset", "anio", "pickup_datetime", "dropoff_datetime",
    "pickup_location_id", "dropoff_location_id", "distancia_millas",
    "duracion_segundos", "duracion_minutos", "monto_base", "monto_total",
    "propina", "peajes", "extra", "mta_tax", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "ehail_fee",
    "payment_type", "passenger_count", "vendor_id", "ratecode_id", "trip_type",
    "shared_ride_flag", "pickup_date", "pickup_hour", "pickup_day_of_week",
    "pickup_month",
)

CANONICAL_EXTRAS = (
    "pickup_zone", "pickup_borough", "pickup_service_zone",
    "dropoff_zone", "dropoff_borough", "dropoff_service_zone",
    "store_and_fwd_flag", "dispatching_base_num", "affiliated_base_number",
)

# --- Fixed values: zone lookup --------------------------------------------

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
ZONE_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")

# --- Fixed values: cleaning -----------------------------------------------

CRITICAL_ROLES = {
    "yellow": ("pickup_datetime", "dropoff_datetime", "monto_total"),
    "green": ("pickup_datetime", "dropoff_datetime", "monto_total"),
    "fhv": ("pickup_datetime",),
    "fhvhv": ("pickup_datetime",),
}
CLEANING_DIMENSIONS = (
    "completitud", "unicidad", "exactitud", "razonabilidad", "validez", "oportunidad",
)
DISTANCE_RANGE = (0.1, 500)
PASSENGER_RANGE = (0, 6)
MAX_TRIP_SECONDS = 86400
PAYMENT_RANGE = (1, 6)
LOCATION_RANGE = (1, 263)
DATE_RANGE = ("2020-01-01", "2028-01-01")
TOTAL_AMOUNT_RANGE = (0, 1000)

# --- Fixed values: quality dimensions -------------------------------------

QUALITY_THRESHOLDS = {
    "completitud": 0.90,
    "precision": 0.85,
    "unicidad": 0.80,
    "validez": 0.90,
    "consistencia": 0.90,
    "overall": 0.85,
}
QUALITY_WEIGHTS = {
    "completitud": 0.30,
    "precision": 0.25,
    "unicidad": 0.15,
    "validez": 0.20,
    "consistencia": 0.10,
}

# --- Fixed values: star schema --------------------------------------------

FACT_KEYS = (
    "time_id", "hora_id", "tipo_dataset", "pickup_location_id",
    "dropoff_location_id", "payment_type", "ratecode_id", "trip_type",
    "shared_ride_flag", "provider_key",
)
FACT_TOTALS = {
    "passenger_count": "total_pasajeros",
    "distancia_millas": "total_distancia_millas",
    "duracion_minutos": "total_duracion_minutos",
    "monto_base": "total_monto_base",
    "monto_total": "total_monto_total",
    "propina": "total_propina",
    "peajes": "total_peajes",
    "extra": "total_extra",
    "mta_tax": "total_mta_tax",
    "improvement_surcharge": "total_improvement_surcharge",
    "congestion_surcharge": "total_congestion_surcharge",
    "airport_fee": "total_airport_fee",
    "cbd_congestion_fee": "total_cbd_congestion_fee",
    "ehail_fee": "total_ehail_fee",
}
FACT_AVERAGES = {
    "distancia_millas": "promedio_distancia_millas",
    "duracion_minutos": "promedio_duracion_minutos",
    "monto_total": "promedio_monto_total",
    "propina": "promedio_propina",
}
NO_DATE = "SIN_FECHA"
NO_PROVIDER = "NO_INFO"
NO_TEXT = "No informado"
NO_KEY = -1

PAYMENT_LABELS = {
    -1: "No informado / No aplica",
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
RATECODE_LABELS = {
    -1: "No informado / No aplica",
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null / unknown",
}
TRIP_TYPE_LABELS = {
    -1: "No informado / No aplica",
    1: "Street-hail",
    2: "Dispatch",
}
SHARED_RIDE_LABELS = {
    -1: "No aplica",
    0: "No compartido / no informado",
    1: "Compartido",
}
TAXI_LABELS = {
    "desconocido": "Tipo desconocido",
    "yellow": "Yellow Taxi",
    "green": "Green Taxi / SHL",
    "fhv": "For-Hire Vehicle",
    "fhvhv": "High-Volume For-Hire Vehicle",
}
VENDOR_LABELS = {
    "1": "Creative Mobile Technologies, LLC",
    "2": "Curb Mobility, LLC",
    "6": "Myle Technologies Inc",
    "7": "Helix",
}
MONTH_NAMES = {
    1: "Enero",
    2: "Febrero",
    3: "Marzo",
    4: "Abril",
    5: "Mayo",
    6: "Junio",
    7: "Julio",
    8: "Agosto",
    9: "Septiembre",
    10: "Octubre",
    11: "Noviembre",
    12: "Diciembre",
}

# --- Fixed values: model tables -------------------------------------------

FORECAST_COLUMNS = (
    "time_id", "tipo_dataset", "pickup_location_id", "viajes_reales",
    "viajes_predichos", "error_absoluto", "error_porcentual", "modelo",
    "rmse_modelo", "mae_modelo", "r2_modelo", "fecha_generacion_utc",
)
SEGMENT_COLUMNS = (
    "tipo_dataset", "pickup_location_id", "cluster_id", "segmento",
    "cantidad_viajes", "ingreso_total", "viajes_por_mes", "ticket_promedio",
    "distancia_promedio", "duracion_promedio", "meses_con_datos", "modelo",
    "silhouette_modelo", "fecha_generacion_utc",
)
CLASS_COLUMNS = (
    "time_id", "hora_id", "tipo_dataset", "pickup_location_id",
    "cantidad_viajes", "clase_demanda_id", "demanda_real",
    "clase_predicha_id", "demanda_predicha", "probabilidad_predicha",
    "prediccion_correcta", "modelo", "accuracy_modelo", "f1_modelo",
    "umbral_bajo", "umbral_alto", "fecha_generacion_utc",
)
DEMAND_LABELS = {0: "Baja", 1: "Media", 2: "Alta"}

# --- Fixed values: audit log ----------------------------------------------

PIPELINE_STATUSES = ("RUNNING", "SUCCESS", "PARTIAL_SUCCESS", "FAILED")
STAGE_STATUSES = ("RUNNING", "SUCCESS", "SKIPPED", "FAILED")
RULE_STATUSES = ("PASSED", "FAILED")
EVENT_TYPES = (
    "PIPELINE_STARTED", "PIPELINE_FINISHED", "STAGE_STARTED", "STAGE_FINISHED",
    "FILE_PROCESSED", "QUALITY_RULE_EVALUATED",
)
