"""Column lists of the raw feeds and of the bronze tables."""

from __future__ import annotations

# Nested values are declared as text: the JSON reader then hands them over as raw JSON.
STATION_PROPERTIES = "id string, name string, district string, updated_at string, measurement string"
COUNTER_PROPERTIES = "id string, name string, route string, updated_at string, directions string"
DISTRICT_PROPERTIES = "id int, name string, slug string, updated_at string"
HISTORY_RECORD = "id string, updated_at string, measurement string"
DETECTION_RECORD = (
    "locations_id string, id string, measured_from string, measured_to string, "
    "value double, value_pedestrians double, measurement_count int"
)
RATE_RECORD = (
    "validFor string, `order` int, country string, currency string, amount int, currencyCode string, rate double"
)
WEATHER_VARIABLES = (
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
    "wind_direction_10m",
)
SERIES_ROW = "ts_utc timestamp, value double, unit string, area_code string"
WEATHER_ROW = (
    "station_id string, requested_latitude double, requested_longitude double, latitude double, longitude double, "
    "elevation double, timezone string, time string, "
    + ", ".join(f"{v} double" for v in WEATHER_VARIABLES)
    + ", hourly_units string"
)

LANDED = ", _loaded_at timestamp, load_date date"
BRONZE = {
    "air_stations": STATION_PROPERTIES + ", geometry string" + LANDED,
    "air_history": HISTORY_RECORD + LANDED,
    "bike_counters": COUNTER_PROPERTIES + ", geometry string" + LANDED,
    "bike_detections": DETECTION_RECORD + LANDED,
    "city_districts": DISTRICT_PROPERTIES + ", geometry string" + LANDED,
    "energy_prices": SERIES_ROW + LANDED,
    "energy_load": SERIES_ROW + LANDED,
    "fx_daily": RATE_RECORD + LANDED,
    "weather_hourly": WEATHER_ROW + LANDED,
}
HOLIDAY_SEED = "holiday_date date, holiday_name string"
