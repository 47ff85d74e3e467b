"""Settings and the fixed vocabularies the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to agree with
# the original pipeline (header aliases, required fields, outcome columns,
# leakage keywords, thresholds, category edges and labels).
# ---------------------------------------------------------------------------

SCHEMA_ALIASES: dict[str, list[str]] = {
    "flight_date": ["flight_date", "fl_date", "flightdate", "date", "flight_day", "fl_date_str"],
    "airline": ["airline", "op_unique_carrier", "op_carrier", "carrier", "reporting_airline",
                "airline_code", "unique_carrier"],
    "origin_airport": ["origin_airport", "origin", "origin_airport_id", "origin_code", "orig"],
    "dest_airport": ["dest_airport", "dest", "destination_airport", "dest_airport_id", "destination"],
    "scheduled_dep_time": ["scheduled_dep_time", "crs_dep_time", "scheduled_departure",
                           "sched_dep_time", "crs_departure_time"],
    "actual_dep_time": ["actual_dep_time", "dep_time", "departure_time", "actual_departure"],
    "departure_delay": ["departure_delay", "dep_delay", "dep_delay_new", "dep_delay_minutes"],
    "scheduled_arr_time": ["scheduled_arr_time", "crs_arr_time", "scheduled_arrival",
                           "sched_arr_time", "crs_arrival_time"],
    "actual_arr_time": ["actual_arr_time", "arr_time", "arrival_time", "actual_arrival"],
    "arrival_delay": ["arrival_delay", "arr_delay", "arr_delay_new", "arr_delay_minutes"],
    "distance": ["distance", "dist", "flight_distance", "distance_miles"],
    "cancelled": ["cancelled", "is_cancelled", "cancellation_code", "cancellation"],
    "diverted": ["diverted", "is_diverted"],
    "air_time": ["air_time", "actual_elapsed_time", "flight_time"],
    "taxi_out": ["taxi_out", "taxi_out_time"],
    "taxi_in": ["taxi_in", "taxi_in_time"],
    "wheels_off": ["wheels_off"],
    "wheels_on": ["wheels_on"],
}

REQUIRED_FIELDS: list[str] = [
    "flight_date", "airline", "origin_airport", "dest_airport", "scheduled_dep_time", "arrival_delay",
]

OUTCOME_COLUMNS: list[str] = [
    "arrival_delay", "departure_delay", "actual_departure", "actual_arrival", "actual_dep_time",
    "actual_arr_time", "taxi_out", "taxi_in", "wheels_off", "wheels_on", "air_time", "elapsed_time",
]

LEAKAGE_KEYWORDS: list[str] = [
    "arr_delay", "dep_delay", "actual_dep", "actual_arr", "actual_departure", "actual_arrival",
    "taxi_out", "taxi_in", "wheels_off", "wheels_on", "air_time", "elapsed_time", "cancellation_code",
]

TEMPORAL_LEAKAGE_KEYWORDS: list[str] = ["future_", "full_dataset_", "post_flight_"]

AIRPORT_PATTERN = r"^[A-Za-z]{3}$"

WEATHER_REQUIRED_FIELDS: list[str] = [
    "airport", "timestamp", "temperature", "humidity", "wind_speed", "wind_direction",
    "precipitation", "visibility", "pressure", "cloud_cover", "weather_condition",
]
WEATHER_OPTIONAL_FIELDS: list[str] = ["feels_like", "wind_gust", "precipitation_probability"]

# weather text patterns (lower-cased condition text)
RAIN_PATTERN = "rain|drizzle|shwr"
SNOW_PATTERN = "snow|blizzard|sleet|wintry"
FOG_PATTERN = "fog|mist|haze"
STORM_PATTERN = "storm|thunder|tstm|squall"

# What names each weather measure's column, in order of preference, and its value where it is missing
WEATHER_INPUTS: dict[str, tuple[list[str], object]] = {
    "condition": (["weather_condition", "condition"], None),
    "precipitation": (["precipitation", "precip"], 0.0),
    "temperature": (["temperature", "temp"], 20.0),
    "visibility": (["visibility"], 10.0),
    "wind": (["wind_speed", "wind"], 0.0),
    "snow": (["snow"], 0.0),
}

TIME_OF_DAY_2A = ["overnight", "morning", "afternoon", "evening"]
TIME_OF_DAY_P3 = ["night", "morning", "afternoon", "evening"]
TIME_BUCKETS_4H = ["00-04", "04-08", "08-12", "12-16", "16-20", "20-24"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
HAUL_CATEGORIES = ["short_haul", "medium_haul", "long_haul"]
SEASONS = ["winter", "spring", "summer", "fall"]

CANDIDATE_THRESHOLDS = [0.30, 0.40, 0.50, 0.60, 0.70]
FINE_THRESHOLDS = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]
# calibration edges of 5 uniform bins, as the float values linspace produces
CALIBRATION_EDGES = [0.2, 0.4, 0.6000000000000001, 0.8]

RISK_LOW_UPPER = 0.30
RISK_MEDIUM_UPPER = 0.60
RISK_HIGH_UPPER = 0.80
RISK_TIERS = ["LOW", "MEDIUM", "HIGH", "VERY HIGH"]

# constant columns named by the v6 preparation (only used with fixed_list=True)
V6_FIXED_CONSTANTS = ["cancelled", "diverted", "is_month_end", "quarter", "season"]


# Duplicates of other P3 columns that the v6 registry drops besides the historical aliases
V6_EXTRA_ALIASES = ["route_distance", "route_distance_category", "prior_origin_flight_volume", "prior_dest_flight_volume"]

# Columns of the profiling tables
NUM_PROFILE = ["distance", "scheduled_dep_time", "scheduled_arr_time", "arr_hour_sin", "arr_hour_cos", "dep_minute_sin",
               "dep_minute_cos", "prior_route_frequency", "prior_origin_flight_volume", "prior_dest_flight_volume",
               "prior_airline_flight_count", "prior_origin_flight_count", "prior_dest_flight_count"]
OUTLIER_COLS = ["distance", "prior_route_frequency", "prior_origin_flight_volume", "prior_dest_flight_volume",
                "prior_airline_flight_count", "prior_origin_flight_count", "prior_dest_flight_count"]
RATE_COLS = ["prior_airline_delay_rate", "prior_origin_delay_rate", "prior_dest_delay_rate", "prior_route_delay_rate",
             "prior_airline_dep_hour_delay_rate", "prior_origin_dep_hour_delay_rate"]

# Feature names whose model importance is reported (exact name or one-hot "name_level")
HIGHLIGHT_FEATURES = [
    "prior_airline_flight_count", "prior_airline_delay_rate", "prior_origin_delay_rate", "prior_dest_delay_rate",
    "prior_route_delay_rate", "prior_route_frequency", "prior_airline_dep_hour_delay_rate",
    "prior_origin_dep_hour_delay_rate", "severe_weather_flag", "rain_flag", "snow_flag", "fog_flag", "storm_flag",
    "low_visibility_flag", "time_of_day", "dep_time_bucket", "arr_time_bucket", "season", "haul_category",
]

# Functional domains of the P3 feature table
FEATURE_DOMAINS: dict[str, list[str]] = {
    "Date Features": ["is_month_start", "is_month_end", "quarter", "season"],
    "Time Features": ["scheduled_dep_time", "scheduled_arr_time", "dep_time_of_day", "dep_time_bucket",
                      "dep_minute_sin", "dep_minute_cos", "arr_time_of_day", "arr_time_bucket", "arr_hour_sin",
                      "arr_hour_cos"],
    "Route Features": ["distance", "route_distance", "route", "route_distance_category", "distance_category",
                       "prior_route_frequency"],
    "Airport Historical Features": ["prior_origin_flight_volume", "prior_dest_flight_volume",
                                    "prior_origin_flight_count", "prior_origin_delay_count",
                                    "prior_origin_delay_rate", "origin_prior_flight_count",
                                    "origin_prior_delay_count", "origin_prior_delay_rate", "prior_dest_flight_count",
                                    "prior_dest_delay_count", "prior_dest_delay_rate", "dest_prior_flight_count",
                                    "dest_prior_delay_count", "dest_prior_delay_rate"],
    "Airline Historical Features": ["airline", "prior_airline_flight_count", "prior_airline_delay_count",
                                    "prior_airline_delay_rate", "carrier_prior_flight_count",
                                    "airline_prior_flight_count", "carrier_prior_delay_count",
                                    "airline_prior_delay_count", "carrier_prior_delay_rate",
                                    "airline_prior_delay_rate"],
    "Route Historical Features": ["prior_route_flight_count", "prior_route_delay_count", "prior_route_delay_rate",
                                  "route_prior_flight_count", "route_prior_delay_count", "route_prior_delay_rate"],
    "Time-Interaction Historical Features": ["prior_airline_dep_hour_flight_count",
                                             "prior_airline_dep_hour_delay_count",
                                             "prior_airline_dep_hour_delay_rate",
                                             "carrier_origin_hour_prior_flight_count",
                                             "airline_dep_hour_prior_flight_count",
                                             "carrier_origin_hour_prior_delay_count",
                                             "airline_dep_hour_prior_delay_count",
                                             "carrier_origin_hour_prior_delay_rate",
                                             "airline_dep_hour_prior_delay_rate",
                                             "prior_origin_dep_hour_flight_count",
                                             "prior_origin_dep_hour_delay_count",
                                             "prior_origin_dep_hour_delay_rate"],
    "Weather Features": ["severe_weather_flag", "rain_flag", "snow_flag", "fog_flag", "storm_flag",
                         "low_visibility_flag"],
}


@dataclass(frozen=True)
class Settings:
    """Driver-side parameters (no environment lookups)."""

    arrival_delay_threshold: float = 15.0
    min_history: int = 3
    fallback: str = "global_prior"          # or "nan" or a number as text
    weather_lookback_minutes: int = 120
    train_pct: float = 0.70
    val_pct: float = 0.15
    seed: int = 42
    lr_c: float = 1.0
    rf_trees: int = 100
    rf_depth: int = 6
    gbt_iter: int = 100
    gbt_depth: int = 4
    gbt_step: float = 0.05
    distance_short_max: float = 500.0
    distance_medium_max: float = 1500.0
    route_min_rows_per_level: float = 3.0
    thresholds: tuple = field(default_factory=lambda: tuple(CANDIDATE_THRESHOLDS))


# Tuning grids by estimator; every combination of the lists is a point
TUNING_GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"c": [0.001, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0]},
    "random_forest": {"trees": [50, 100], "depth": [3, 5, 8], "min_leaf": [1, 2, 4]},
    "gradient_boosting": {"iters": [50, 100], "depth": [2, 3, 5], "step": [0.03, 0.05, 0.1], "subsample": [0.8, 1.0],
                          "subset": ["0.8", "all"]},
}

DEFAULT = Settings()

# Columns of the correlation matrices of the P3 and the 2A table
CORRELATION_P3 = ["delay_target", "distance", "scheduled_dep_time", "arr_hour_sin", "arr_hour_cos", "prior_origin_flight_volume",
                  "prior_dest_flight_volume", "prior_airline_delay_rate", "prior_origin_delay_rate", "prior_dest_delay_rate",
                  "prior_route_delay_rate", "prior_origin_dep_hour_delay_rate", "prior_airline_dep_hour_delay_rate",
                  "prior_route_frequency"]
CORRELATION_2A = ["delay_target", "departure_hour", "departure_hour_sin", "departure_hour_cos", "day_of_week", "day_of_week_sin",
                  "day_of_week_cos", "distance", "historical_origin_delay_rate", "historical_airline_delay_rate",
                  "historical_destination_delay_rate"]
