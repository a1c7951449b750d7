"""Domain constants that results depend on."""

# Trip categories.
SERVICES = ("green", "yellow", "fhv", "fhvhv")
TAXI_SERVICES = ("yellow", "green")
APP_SERVICES = ("fhv", "fhvhv")
PRICED_SERVICES = ("yellow", "green", "fhvhv")

# Candidate source names per column role, in order of preference.
PICKUP_NAMES = ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime")
DROPOFF_NAMES = (
    "tpep_dropoff_datetime",
    "lpep_dropoff_datetime",
    "dropoff_datetime",
    "dropOff_datetime",
)
PU_NAMES = ("PULocationID", "PUlocationID")
DO_NAMES = ("DOLocationID", "DOlocationID")
CODE_COLUMNS = ("VendorID", "RatecodeID", "payment_type", "passenger_count")

# Columns that identify a trip, per category.
TRIP_KEYS = {
    "fhv": ("dispatching_base_num", "pickup_datetime", "dropOff_datetime"),
    "fhvhv": ("hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime"),
    "yellow": ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID"),
    "green": ("VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID"),
}

# Columns that may be NULL, per category; all others are required.
NULLABLE = {
    "fhv": ("SR_Flag", "Affiliated_base_number"),
    "fhvhv": (
        "originating_base_num", "on_scene_datetime", "request_datetime",
        "shared_request_flag", "shared_match_flag", "access_a_ride_flag",
        "wav_request_flag", "wav_match_flag", "tolls", "bcf", "sales_tax",
        "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "tips",
    ),
    "yellow": (
        "RatecodeID", "store_and_fwd_flag", "payment_type", "tip_amount",
        "tolls_amount", "extra", "mta_tax", "improvement_surcharge",
        "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    ),
    "green": (
        "RatecodeID", "store_and_fwd_flag", "payment_type", "tip_amount",
        "tolls_amount", "extra", "mta_tax", "ehail_fee", "improvement_surcharge",
        "congestion_surcharge", "cbd_congestion_fee", "trip_type",
    ),
}

# Plausible [low, high] per column and category.
RANGES = {
    "yellow": {
        "passenger_count": (0, 9), "trip_distance": (0, 500), "fare_amount": (-200, 5000),
        "total_amount": (-200, 5000), "tip_amount": (0, 2000), "tolls_amount": (0, 100),
        "improvement_surcharge": (0, 5), "congestion_surcharge": (0, 5),
        "cbd_congestion_fee": (0, 5), "airport_fee": (0, 5), "mta_tax": (0, 5),
        "extra": (-5, 20),
    },
    "green": {
        "passenger_count": (0, 9), "trip_distance": (0, 500), "fare_amount": (-200, 5000),
        "total_amount": (-200, 5000), "tip_amount": (0, 2000), "tolls_amount": (0, 100),
        "ehail_fee": (0, 10), "improvement_surcharge": (0, 5), "congestion_surcharge": (0, 5),
        "cbd_congestion_fee": (0, 5), "mta_tax": (0, 5), "extra": (-5, 20),
    },
    "fhv": {"SR_Flag": (0, 1)},
    "fhvhv": {
        "trip_miles": (0, 500), "trip_time": (0, 86400), "base_passenger_fare": (-200, 5000),
        "driver_pay": (-200, 5000), "tips": (0, 2000), "tolls": (0, 100), "bcf": (0, 5),
        "sales_tax": (0, 5), "congestion_surcharge": (0, 5), "cbd_congestion_fee": (0, 5),
        "airport_fee": (0, 5),
    },
}

# Which column must equal the sum of which components.
AMOUNT_FORMULAS = {
    "yellow": ("total_amount", (
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    )),
    "green": ("total_amount", (
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
        "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee",
    )),
    "fhvhv": ("driver_pay", (
        "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge",
        "airport_fee", "tips",
    )),
}

# Code tables.
RATECODE_NAMES = (
    (1, "Standard rate"), (2, "JFK"), (3, "Newark"), (4, "Nassau/Westchester"),
    (5, "Negotiated fare"), (6, "Group ride"), (99, "Desconocido"),
)
PAYMENT_NAMES = (
    (0, "Flex fare"), (1, "Tarjeta de credito"), (2, "Efectivo"), (3, "Sin cargo"),
    (4, "Disputa"), (5, "Desconocido"), (6, "Viaje anulado"), (99, "Desconocido"),
)

# Regulated flat fares, (ratecode, fiscal year, dollars), and years covered.
FLAT_FARES = ((2, 2023, 70.0), (2, 2024, 70.0), (2, 2025, 70.0))
FISCAL_YEARS = (2023, 2024, 2025)

# Anomaly thresholds.
FLAT_FARE_RATECODE = 2
STANDARD_RATECODE = 1
FLAT_FARE_TOLERANCE = 15.0
MAX_PLAUSIBLE_MPH = 80.0
MAX_COST_PER_MILE = 30.0
LEGAL_FARE_PER_MILE = 4.12

# Federal holidays observed, yyyymmdd.
HOLIDAYS = (
    20230101, 20230116, 20230220, 20230529, 20230619, 20230704,
    20230904, 20231009, 20231111, 20231123, 20231225,
    20240101, 20240115, 20240219, 20240527, 20240619, 20240704,
    20240902, 20241014, 20241111, 20241128, 20241225,
    20250101, 20250120, 20250217, 20250526, 20250619, 20250704,
    20250901, 20251013, 20251111, 20251127, 20251225,
    20260101, 20260119, 20260216, 20260525, 20260619, 20260704,
    20260907, 20261012, 20261111, 20261126, 20261225,
    20270101, 20270118, 20270215, 20270531, 20270618, 20270705,
    20270906, 20271011, 20271111, 20271125, 20271225,
)
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)
AIRPORT_BOROUGHS = ("EWR", "Queens")

# Borough labels in Spanish; any other borough keeps its name.
BOROUGH_ES = (
    ("Bronx", "El Bronx"), ("EWR", "Newark (EWR)"),
    ("Unknown", "Desconocido"), ("N/A", "Desconocido"),
)

# Summed money and distance columns of the financial mart.
FINANCIAL_SUMS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee", "airport_fee",
    "ehail_fee", "total_amount", "base_passenger_fare", "tolls", "bcf", "sales_tax",
    "tips", "driver_pay", "trip_distance", "trip_miles",
)

# Model inputs.
FRAUD_FEATURES = (
    "velocidad_promedio_calculada", "costo_por_distancia", "duracion_viaje_segundos",
    "trip_distance", "fare_amount", "ratio_peaje_tarifa",
)
TAXI_CLUSTER_FEATURES = (
    "borough_pu", "borough_do", "franja_horaria", "dia_categoria",
    "payment_type", "ratecode", "passenger_group",
)
APP_CLUSTER_FEATURES = (
    "borough_pu", "borough_do", "franja_horaria", "dia_categoria", "hvfhs_license_num",
)

# Fields an event must carry, per service.
EVENT_REQUIRED = {
    "yellow": ("service_id", "pickup_datetime", "vendor_id", "pu_location_id"),
    "green": ("service_id", "pickup_datetime", "vendor_id", "pu_location_id"),
    "fhvhv": ("service_id", "pickup_datetime", "hvfhs_license_num", "pu_location_id"),
    "fhv": ("service_id", "pickup_datetime", "pu_location_id"),
}
