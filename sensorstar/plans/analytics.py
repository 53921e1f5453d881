"""The five benchmark questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorstar.plans.semantic import Cube, Filter

# Fixed values of the questions.
QUESTION_COUNTRY = "CZ"
QUESTION_CLASS = "2"
WEEKEND = (6, 7)
TOP_CITIES = 10


def velocity_by_class(cube: Cube) -> DataFrame:
    return _averages(cube, ["vehicle_class"])


def detections_by_time(cube: Cube, grain: str = "minute") -> DataFrame:
    found = cube.query(["detections"], ["full_date"], grain=None if grain == "minute" else grain, how="inner")
    return found.withColumnRenamed("detections", "number_of_detections").orderBy("full_date")


def fastest_cities(cube: Cube) -> DataFrame:
    """Ten cities with the highest average; equal averages go by name."""
    filters = [
        Filter("country_code", "equals", QUESTION_COUNTRY),
        Filter("vehicle_class", "equals", QUESTION_CLASS),
    ]
    found = _averages(cube, ["city_name"], filters)
    return found.orderBy(F.desc("average_velocity"), "city_name").limit(TOP_CITIES)


def velocity_by_type_and_class(cube: Cube) -> DataFrame:
    return _averages(cube, ["detection_type", "vehicle_class"]).orderBy("detection_type", "vehicle_class")


def weekend_city_ranks(cube: Cube) -> DataFrame:
    """Weekend averages per country, city and class, ranked by detections."""
    groups = ["country_code", "city_name", "vehicle_class"]
    found = cube.query(["avg_velocity_raw", "detections"], groups, [Filter("weekday", "in", WEEKEND)], how="inner")
    rank = F.dense_rank().over(Window.partitionBy("country_code").orderBy(F.desc("detections")))
    return found.select(
        *groups,
        F.round("avg_velocity_raw", 6).alias("average_velocity"),
        rank.alias("city_rank_by_detections"),
    ).orderBy("country_code", "city_rank_by_detections", "city_name", "vehicle_class")


def _averages(cube: Cube, groups: list[str], filters: list[Filter] | None = None) -> DataFrame:
    found = cube.query(["avg_velocity_raw"], groups, filters or [], how="inner")
    return found.select(*groups, F.round("avg_velocity_raw", 6).alias("average_velocity"))
