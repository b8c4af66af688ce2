"""Schemas of the tables this library reads and writes. Reading never infers."""

from __future__ import annotations

WEATHER_HOURLY = "datetime string, rain double, location string"
WEATHER_HOURLY_WIDE = (
    "datetime string, temperature_2m double, rain double, precipitation double, "
    "wind_speed_10m double, wind_gusts_10m double, location string"
)
FLOOD_DAILY = "date string, river_discharge_m3s double, location string"
WEATHER_DAILY = (
    "date string, rain_sum_mm double, precipitation_sum_mm double, temperature_mean_c double, "
    "wind_speed_max_mps double, wind_gust_max_mps double, location string"
)
FORECAST_LONG = "location string, datetime timestamp_ntz, variable string, member int, value double"
API_PAYLOAD = (
    "source string, fetched_at timestamp, latitude double, longitude double, start bigint, end bigint, "
    "interval int, vars array<struct<code:string,altitude:int,member:int,values:array<float>>>"
)
MET_RESULTS = (
    "results array<struct<locationname:string,date:string,datatype:string,value:string,"
    "attributes:struct<unit:string>,latitude:double,longitude:double>>"
)
MET_LOCATIONS = (
    "offset int, results array<struct<locationid:string,locationname:string,locationcategoryid:string,"
    "latitude:double,longitude:double,locationrootid:string,locationrootname:string>>"
)
LOCATIONS = "location string, latitude double, longitude double"

# The two stations, their coordinates and their zone.
STATIONS = (("Petaling", 3.107260, 101.606710), ("Klang", 3.043092, 101.441392))
LOCAL_ZONE = "Asia/Kuala_Lumpur"
