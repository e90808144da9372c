"""Domain values of the air-quality preset.

Fixed values: they decide results, so they are stated here once and passed to the operators as
parameters. No operator reads this module for anything but its defaults.
"""

ZONE = "Europe/Paris"
STUDY_START = "2018-01-01"
STUDY_END = "2026-09-21"

HEADER_LINES = 6
MIN_HOURS = 18
GUIDELINE = 15.0
TARGET_STATIONS = ["PA01H", "PA04C"]

STATION_TYPES = ["urban_background", "traffic", "rural", "observation"]
EPISODE_LEVELS = ["information", "alert"]
FORECAST_RESULTS = ["correct_detection", "missed_detection", "false_alarm"]

SOURCE_RANK = {"pdf_report": 0, "html_page": 1, "opendata_csv": 2}
UNKNOWN_SOURCE_RANK = 9

EPISODE_POLLUTANTS = ["PM10", "O3", "NO2"]
PAGE_POLLUTANTS = ["PM10", "PM2.5", "O3", "NO2", "SO2"]

# Spellings in the sources -> values in the tables.
ALERT_PREFIX = "Particules "
ALERT_POLLUTANT = {"Ozone": "O3"}
ALERT_LEVEL = {"INFORMATION ET RECOMMANDATION": "information", "ALERTE": "alert"}
REPORT_LEVEL = {"information": "information", "alerte": "alert"}
REPORT_RESULT = {
    "Bonne détection": "correct_detection",
    "Détection manquée": "missed_detection",
    "Fausse détection": "false_alarm",
}
SHORT_POLLUTANT = {"PM": "PM10", "O": "O3", "NO": "NO2"}

# Weather file code -> column.
WEATHER_CODES = {
    "TM": "temp_mean_c",
    "TN": "temp_min_c",
    "TX": "temp_max_c",
    "UM": "humidity_mean_pct",
    "PMERM": "pressure_mean_hpa",
    "RR": "rain_mm",
    "FFM": "wind_mean_ms",
    "FXY": "wind_max_ms",
    "DXY": "wind_dir_deg",
}

# School calendar: accepted headers, after normalisation.
PLACE_HEADERS = ["location", "academies", "academie"]
START_HEADERS = ["start_date", "date_de_debut"]
END_HEADERS = ["end_date", "date_de_fin"]
POPULATION_HEADERS = ["population"]
DESCRIPTION_HEADERS = ["description"]
PLACE = "Paris"
EXCLUDED_POPULATION = "Enseignants"

# Wind classes: the dashboard query is left-closed, the exploration is right-closed.
WIND_EDGES = [2.0, 4.0, 6.0]
WIND_LABELS = [
    "1. calm (< 2 m/s)",
    "2. light (2-4 m/s)",
    "3. moderate (4-6 m/s)",
    "4. strong (>= 6 m/s)",
]
WIND_BINS = [0.0, 2.0, 3.0, 4.0, 5.0, 20.0]
WIND_BIN_LABELS = ["(0, 2]", "(2, 3]", "(3, 4]", "(4, 5]", "(5, 20]"]

# Text compares as in the database: without case and accents.
COLLATION = "UNICODE_CI_AI"

PER_PAGE = 20
PER_PAGE_MAX = 100

# Forecast.
TRAIN_UNTIL = 2023
VALID_YEAR = 2024
TEST_YEAR = 2025
DEMO_YEAR = 2026
THRESHOLDS = [10 + step / 2 for step in range(17)]
MIN_RECALL = 0.80
TREES = 300
SEED = 42
GRID_DEPTH = [None, 8, 12]
GRID_LEAF = [1, 5, 10]
GRID_FEATURES = [1.0, 0.5]
IMPORTANCE_REPEATS = 10
