"""Typed readers of the reference tables kept as CSV."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.functions.columns import flag
from ordertide.schemas import ADJACENCY, MATCH_EFFECTS, RESTAURANTS, TRAVEL_MATRIX, ZONES


def _read_csv(spark, path, schema):
    """CSV by header name with trimmed text; a value of the wrong type becomes null."""
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    present = set(text.columns)
    columns = []
    for field in schema.fields:
        value = F.trim(F.col(field.name)) if field.name in present else F.lit(None).cast("string")
        if field.dataType != T.StringType():
            value = value.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return text.select(*columns)


def normalise_weights(zones, tolerance=0.01):
    """Spawn probabilities that sum to one; left alone when they nearly do."""
    total = zones.agg(F.sum("spawn_probability").alias("total")).scalar()
    share = F.when(F.abs(total - 1.0) > F.lit(tolerance), F.col("spawn_probability") / total)
    return zones.withColumn("spawn_probability", F.coalesce(share, F.col("spawn_probability")))


def read_zones(spark, path):
    """Zones with checked and normalised spawn probabilities."""
    zones = _read_csv(spark, path, ZONES)
    if zones.isEmpty():
        raise ValueError("no zones in the zone table")
    p = F.col("spawn_probability")
    problem = F.concat(F.lit("invalid spawn probability for zone "), F.col("zone_id"))
    checked = F.when(p.between(0.0, 1.0), p).otherwise(F.raise_error(problem).cast("double"))
    return normalise_weights(
        zones.withColumns(
            {
                "spawn_probability": checked,
                "centroid_x": F.coalesce("centroid_x", F.lit(0.0)),
                "centroid_y": F.coalesce("centroid_y", F.lit(0.0)),
                "centrality_weight": F.coalesce("centrality_weight", F.lit(1.0)),
            }
        )
    )


def read_restaurants(spark, path, zone_ids=None, categories=None, max_restaurants=None):
    """Restaurants, optionally of some zones or categories, optionally the first by id."""
    rows = _read_csv(spark, path, RESTAURANTS).withColumns(
        {
            "has_consistent_promo": flag("has_consistent_promo"),
            "promo_pattern": F.coalesce("promo_pattern", F.lit("none")),
            "matchday_sensitivity": F.coalesce("matchday_sensitivity", F.lit("medium")),
            "latency_pressure_factor": F.coalesce("latency_pressure_factor", F.lit(1.0)),
        }
    )
    if zone_ids:
        rows = rows.filter(F.col("zone_id").isin(*zone_ids))
    if categories:
        rows = rows.filter(F.col("category").isin(*categories))
    if max_restaurants:
        rows = rows.orderBy("restaurant_id").limit(max_restaurants)
    return rows


def read_travel_matrix(spark, path):
    """One route per zone pair; of repeated pairs the last in the file counts.

    File order is the file name and position given by the reader's metadata.
    """
    text = spark.read.option("header", True).csv(path)
    placed = text.withColumn("_at", F.struct(F.input_file_name(), F.monotonically_increasing_id()))
    columns = {}
    for field in TRAVEL_MATRIX.fields:
        value = F.trim(F.col(field.name))
        columns[field.name] = value if field.dataType == T.StringType() else value.try_cast(field.dataType)
    columns["same_zone"] = flag("same_zone")
    rest = [name for name in TRAVEL_MATRIX.names if name not in ("zone_from", "zone_to")]
    typed = placed.select("_at", *[value.alias(name) for name, value in columns.items()])
    last = typed.groupBy("zone_from", "zone_to").agg(F.max_by(F.struct(*rest), "_at").alias("r"))
    return last.select("zone_from", "zone_to", "r.*")


def read_match_effects(spark, path):
    return _read_csv(spark, path, MATCH_EFFECTS)


def read_adjacency(spark, path):
    """Adjacent districts in both directions, each pair once."""
    edges = _read_csv(spark, path, ADJACENCY)
    reverse = edges.select(F.col("adjacent_district").alias("district"), F.col("district").alias("adjacent_district"))
    return edges.union(reverse).distinct()
