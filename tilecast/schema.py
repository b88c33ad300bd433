"""Names and types shared by every operator."""

from pyspark.sql import types as T

DEMAND = T.StructType(
    [
        T.StructField("geohash6", T.StringType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("demand", T.DoubleType()),
    ]
)

TICK_MINUTES = 15
MINUTES_PER_DAY = 24 * 60

KEYS = ["geohash6", "day", "hour", "minute"]
TIME = ["day", "hour", "minute"]

GEO = ["geohash6"]
GDOW = ["geohash6", "dow"]
GDOWH = ["geohash6", "dow", "hour"]
GDOWHM = ["geohash6", "dow", "hour", "minute"]

CALENDAR_GEO = ["is_weekend", "dow", "lat", "long", "hour_p8", "is_working_hour"]

LAGS = [1, 4, 672]

# The columns every feature table carries, in model order.
CATEGORICAL = ["is_weekend", "dow", "hour", "cluster_gdowh", "is_working_hour", "cluster_geo"]
NUMERICAL = [
    "lat",
    "long",
    "minute",
    "mean_demand_per_geo",
    "median_demand_per_geo",
    "mean_demand_per_gdow",
    "median_demand_per_gdow",
    "mean_enc_demand_tmin1",
    "mean_enc_demand_tmin4",
    "mean_enc_demand_tmin672",
    "demand_gdow_q95",
    "demand_gdow_q10",
    "mean_demand_diff_wt_gdow_q95",
    "mean_demand_diff_wt_gdow_q10",
    "cluster_prob_gdowh",
    "demand_rolling_4",
    "dist_to_center_km",
]
