"""A postal crosswalk from share files: each area goes to the county and place with its largest share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseline.operators import collapse, joins


def largest_share(shares: DataFrame, code: str, name: str) -> DataFrame:
    """Code and name with the largest ``share`` per ``zcta``; equal shares go to the smaller code."""
    filled = shares.where(F.col("zcta").isNotNull() & (F.trim("zcta") != ""))
    return collapse.top_by_weight(filled, ["zcta"], "share", [code], {code: code, name: name})


def build_crosswalk(counties: DataFrame, places: DataFrame, states: DataFrame) -> DataFrame:
    """Crosswalk columns per area. An area outside any place has no place.

    ``counties`` holds zcta, county_fips_code, county and share, ``places`` zcta, place_fips_code,
    place and share, ``states`` state_fips_code and state.
    """
    county = largest_share(counties, "county_fips_code", "county")
    county = county.withColumn("state_fips_code", F.substring("county_fips_code", 1, 2))
    county = joins.many_to_one(county, states, {"state_fips_code": "state_fips_code"}, {"state": "state"})
    place = largest_share(places, "place_fips_code", "place")
    return joins.left_by_key(county, "zcta", place).select(
        "zcta", "state", "state_fips_code", "county", "county_fips_code", "place", "place_fips_code"
    )


def with_territories(main: DataFrame, territories: DataFrame) -> DataFrame:
    """Add the areas of territories, which come from files of their own and override the shares."""
    return main.join(territories.select("zcta"), "zcta", "left_anti").unionByName(territories)
