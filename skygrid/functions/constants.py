"""Names, orders and numbers the results depend on."""

from __future__ import annotations

# ---- fixed values: columns -------------------------------------------------
MEASURES = ["Temperature", "Humidity", "Cloud_Cover", "Pressure", "Wind_Speed"]

FEATURE_ORDER = [
    "Temperature",
    "Humidity",
    "Cloud_Cover",
    "Pressure",
    "Wind_Speed",
    "Hour",
    "Month",
    "Location_Encoded",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
]

SERVING_COLUMNS = [
    "Timestamp",
    "Temperature",
    "Humidity",
    "Cloud_Cover",
    "Pressure",
    "Wind_Speed",
    "Latitude",
    "Longitude",
    "Rain",
    "Hour",
    "Month",
    "Location_Encoded",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
]

#: The training table carries the site name after the measures.
TRAINING_COLUMNS = SERVING_COLUMNS[:6] + ["Location"] + SERVING_COLUMNS[6:]

FORECAST_COLUMNS = [
    "Forecast_Target_Time",
    "Latitude",
    "Longitude",
    "rain_probability",
    "predicted_rain",
]

#: First present wins. The last one is the historic table's name.
TIME_CANDIDATES = [
    "Forecast_Target_Time",
    "Forecast_Time",
    "Fetch_Time",
    "fetch_time",
    "timestamp",
    "Timestamp",
]

DASHBOARD_FEATURES = ["Temperature", "Humidity", "Wind_Speed", "Cloud_Cover", "Pressure", "Rain"]

EDA_FEATURES = [
    "Temperature",
    "Humidity",
    "Cloud_Cover",
    "Pressure",
    "Wind_Speed",
    "Latitude",
    "Longitude",
    "Hour",
    "Month",
]

UNITS = {
    "Temperature": "°C",
    "Humidity": "%",
    "Wind_Speed": "km/h",
    "Cloud_Cover": "%",
    "Pressure": "hPa",
    "Rain": "(0/1)",
}

#: Weather service names -> table names.
API_NAMES = {
    "time": "Forecast_Time",
    "temperature_2m": "Temperature",
    "relative_humidity_2m": "Humidity",
    "surface_pressure": "Pressure",
    "cloud_cover": "Cloud_Cover",
    "wind_speed_10m": "Wind_Speed",
}

#: Table names -> map payload names.
PAYLOAD_NAMES = {
    "Fetch_Time": "fetch_time",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Temperature": "temperature",
    "Humidity": "humidity",
    "Wind_Speed": "wind_speed",
    "Cloud_Cover": "cloud_cover",
    "Pressure": "pressure",
    "Rain": "rain_label",
}

# ---- fixed values: grid and places -----------------------------------------
LAT_RANGE = (-6.36, -6.00)
LON_RANGE = (106.33, 106.77)
GRID_SIDE = 20
REQUEST_BATCH = 50

#: (name, latitude, longitude, code); codes follow the alphabet.
SITES = [
    ("Alam_Sutera", -6.2226, 106.6533, 0),
    ("BSD_City", -6.3006, 106.6538, 1),
    ("Batuceper", -6.1557, 106.6579, 2),
    ("Bintaro", -6.2738, 106.7136, 3),
    ("Cikupa", -6.2427, 106.5173, 4),
    ("Gading_Serpong", -6.2416, 106.6285, 5),
    ("Karawaci", -6.2269, 106.6074, 6),
    ("Pamulang", -6.3407, 106.7371, 7),
    ("Tangerang_Kota", -6.1956, 106.6322, 8),
]

#: Border ring as (longitude, latitude); first vertex repeated at the end.
BORDER = [
    (106.75726867400004, -6.277633093999953),
    (106.75764451500004, -6.277662152999937),
    (106.77986321600008, -6.31652097999995),
    (106.76931535600005, -6.361503122999977),
    (106.72093341700008, -6.362186773999952),
    (106.65098391200007, -6.362190372999976),
    (106.60396562600005, -6.361875494999936),
    (106.57326640300005, -6.338535104999949),
    (106.48289161900004, -6.34939787899998),
    (106.46787608900007, -6.303592913999978),
    (106.42670081800009, -6.347891806999939),
    (106.40094266000006, -6.330301855999949),
    (106.37396266500008, -6.191226348999976),
    (106.39261653600005, -6.152003651999962),
    (106.35056333400007, -6.109625692999941),
    (106.33965328100004, -6.073768),
    (106.36563899500004, -6.039078590999964),
    (106.41179983300009, -6.024219310999968),
    (106.48594623800005, -6.047827849999976),
    (106.54936345500005, -6.023407757999962),
    (106.58767987300007, -6.032291875999931),
    (106.64862159600005, -6.005240743999934),
    (106.71261170600008, -6.040605432999939),
    (106.72498533400005, -6.089564002999964),
    (106.71050724300005, -6.096408219999944),
    (106.68799279200005, -6.097068797999952),
    (106.68681143000003, -6.172372014999951),
    (106.72412891900007, -6.191791579999972),
    (106.73742805700005, -6.22388008799993),
    (106.74819884000004, -6.250081243999944),
    (106.75726867400004, -6.277633093999953),
]

# ---- fixed values: rules ---------------------------------------------------
UTC_OFFSET_HOURS = 7
SERVING_THRESHOLD = 0.4
DEFAULT_THRESHOLD = 0.5
THRESHOLD_RANGE = (0.3, 0.7, 41)
TRAIN_WINDOW_DAYS = 7
DASHBOARD_WINDOW_HOURS = 48
POSSIBLE_RAIN_CLOUD = 60
RETENTION = {"current": 43800, "future": 720, "features": 720, "forecast": 720}
EXPORT_PER_TIER = 10
CYCLE = {"forecasts": 5, "observations": 25, "block": 6}

#: Weight sets tried for the three base probabilities.
BLEND_WEIGHTS = [
    (0.34, 0.33, 0.33),
    (0.40, 0.15, 0.45),
    (0.50, 0.15, 0.35),
    (0.25, 0.20, 0.55),
]

#: Search spaces of the three boosted learners.
SEARCH_SPACES = {
    "xgb": {
        "n_estimators": [200, 300, 500],
        "max_depth": [3, 5, 7, 9],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "subsample": [0.6, 0.8, 1.0],
        "colsample_bytree": [0.6, 0.8, 1.0],
    },
    "lgb": {
        "n_estimators": [200, 300, 500],
        "num_leaves": [31, 50, 70, 100],
        "max_depth": [-1, 5, 10, 15],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "subsample": [0.6, 0.8, 1.0],
        "colsample_bytree": [0.6, 0.8, 1.0],
    },
    "cat": {
        "iterations": [200, 300, 500],
        "depth": [4, 6, 8, 10],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "l2_leaf_reg": [1, 3, 5, 7],
    },
}
