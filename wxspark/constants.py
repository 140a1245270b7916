"""Lookup tables, thresholds and message texts that results depend on."""

from __future__ import annotations

# Cities that can be verified: (city, lat, lon, timezone, label, iso3).
CITIES = [
    ("New York", 40.7128, -74.0060, "America/New_York", "New York, USA", "USA"),
    ("London", 51.5074, -0.1278, "Europe/London", "London, UK", "GBR"),
    ("Tokyo", 35.6762, 139.6503, "Asia/Tokyo", "Tokyo, Japan", "JPN"),
    ("Sydney", -33.8688, 151.2093, "Australia/Sydney", "Sydney, Australia", None),
    ("Mumbai", 19.0760, 72.8777, "Asia/Kolkata", "Mumbai, India", None),
    ("Dhaka", 23.8103, 90.4125, "Asia/Dhaka", "Dhaka, Bangladesh", "BGD"),
]
DEFAULT_CITY = "Dhaka"

# Attributes of a regime observation and their units ("" shows no suffix).
UNITS = {
    "temperature": "°C",
    "humidity": "%",
    "pressure": "hPa",
    "wind_speed": "km/h",
    "precipitation": "mm",
    "cloud_cover": "%",
    "visibility": "km",
    "weather": "",
}
ATTRIBUTES = tuple(name for name in UNITS if name != "weather")

# Uniform bounds per weather type, in the order of ATTRIBUTES.
REGIMES = {
    "Sunny": [(25, 35), (30, 60), (1010, 1025), (3, 15), (0, 0), (0, 20), (8, 15)],
    "Cloudy": [(15, 25), (50, 75), (1000, 1015), (5, 20), (0, 2), (50, 85), (5, 10)],
    "Rain": [(10, 22), (70, 95), (990, 1010), (10, 25), (1, 20), (80, 100), (2, 6)],
    "Thunderstorm": [(10, 25), (80, 100), (975, 995), (30, 80), (15, 60), (90, 100), (0.5, 3)],
    "Fog": [(5, 20), (85, 100), (1005, 1020), (0, 8), (0, 0.5), (70, 95), (0.05, 1)],
}
ROWS_PER_REGIME = 200_000

# Scale presets: name -> (rows, partitions); any other name takes the default.
SCALES = {
    "million": (500_000, 10),
    "half-billion": (500_000_000, 2_000),
    "billion": (2_000_000_000, 10_000),
}
DEFAULT_SCALE = (1_000_000, 20)

STATIONS = 10_000

# Extreme-weather thresholds.
HOT, COLD, GALE, DELUGE = 40, -10, 100, 50

# Forests.
FEATURES = ("month", "day", "hour")
TARGETS = ("temp_celsius", "humidity_percent", "wind_speed_kmh", "precipitation_mm")
CLASSIFIER_TREES, REGRESSOR_TREES, TREE_DEPTH, SEED = 30, 20, 8, 42
TEST_FRACTION = 0.2

# Messages.
BAD_DATE = "Invalid date format"
BAD_CITY = "City not mapped"
NOT_FOUND = "API 7-day query limit exceeded."
VERDICTS = [
    (5, "Excellent Synthetic Match!"),
    (12, "Acceptable variance."),
    (None, "AI deviates heavily from live API."),
]
ALERT_ON, ALERT_OFF = "ALERT ACTIVE", "ALL CLEAR"
NO_TEMPERATURE, NO_WIND = "N/A", "--"
