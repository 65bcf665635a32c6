"""Removal of single-position glitches by speed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.functions.geo import velocity_knots

GROUP = ("file_seq", "mmsi")


def speed_limit(df: DataFrame, limit: float, by_type: dict[str, float] | None, group: tuple, casefold: bool = False) -> Column:
    """The limit of a group: that of its first row's ship type if it has one, matched exactly (or without case), else ``limit``."""
    if not by_type or "ship_type" not in df.columns:
        return F.lit(float(limit))
    first = F.first("ship_type").over(W.partitionBy(*group).orderBy("timestamp").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    known = {k.lower() if casefold else k: float(v) for k, v in by_type.items()}
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(first) if casefold else first), F.lit(float(limit)))


def remove_outliers(df: DataFrame, limit: float, by_type: dict[str, float] | None = None, *, group: tuple = GROUP, casefold: bool = False) -> DataFrame:
    """Drops a row if the speed to it and the speed from it are above the limit while the speed past it is not. The first and last row of a group stay; neighbours are those of the input, so rows are judged independently."""
    w = W.partitionBy(*group).orderBy("timestamp")
    near = df.withColumns({f"_{k}_{c}": f(c).over(w) for c in ("lat", "lon", "timestamp") for k, f in (("p", F.lag), ("n", F.lead))} | {"_limit": speed_limit(df, limit, by_type, group, casefold)})
    at = lambda k: [F.col(f"_{k}_{c}" if k else c) for c in ("lat", "lon", "timestamp")]
    before, after, past = velocity_knots(*at("p"), *at("")), velocity_knots(*at(""), *at("n")), velocity_knots(*at("p"), *at("n"))
    glitch = (before > F.col("_limit")) & (after > F.col("_limit")) & (past <= F.col("_limit"))
    inner = F.col("_p_timestamp").isNotNull() & F.col("_n_timestamp").isNotNull()
    return near.filter(~F.coalesce(inner & glitch, F.lit(False))).select(*df.columns)


def remove_outliers_iterative(df: DataFrame, limit: float, rounds: int = 3, *, group: tuple = GROUP) -> DataFrame:
    """Up to ``rounds`` passes, without ship types. A group in which a pass removes nothing stays the same in the next."""
    for _ in range(rounds):
        df = remove_outliers(df, limit, group=group)
    return df


def consecutive_velocity(df: DataFrame, *, group: tuple = GROUP) -> DataFrame:
    """Adds velocity_knots from the row before; 0 for the first."""
    w = W.partitionBy(*group).orderBy("timestamp")
    before = [F.lag(c).over(w) for c in ("lat", "lon", "timestamp")]
    now = [F.col(c) for c in ("lat", "lon", "timestamp")]
    return df.withColumn("velocity_knots", F.coalesce(velocity_knots(*before, *now), F.lit(0.0)))
