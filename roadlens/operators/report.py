"""Dashboard operators: alerts, overview, KPI cards, per-class profiles,
pivot, histogram, box summary, filters and orderings.

Every operator is a DataFrame -> DataFrame transformation; aggregations run
with partial (map-side) aggregation, and global scalars (a mean, a min/max)
are one-row aggregates joined back by broadcast, whose size is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.functions import derive as D
from roadlens.functions.text import location_label

ROAD_CLASSES = list(fv.ROAD_MULTIPLIER)


def with_global_mean(df: DataFrame, col: str, alias: str = "global_mean") -> DataFrame:
    """Attach the column mean to every row (scalar broadcast of a one-row aggregate)."""
    one_row = df.agg(F.avg(col).alias(alias))
    return df.crossJoin(F.broadcast(one_row))


def speed_violations(df: DataFrame, factor: float = fv.VIOLATION_FACTOR_DASHBOARD,
                     avg="average_speed", limit="posted_speed_limit") -> DataFrame:
    return df.withColumn("speed_violation", D.speed_violation(avg, limit, factor))


def volume_anomalies(df: DataFrame, k: float = fv.VOLUME_ANOMALY_K_SIMPLE,
                     vol: str = "volume_vpd") -> DataFrame:
    """Rows whose volume exceeds k x the global mean volume."""
    return (with_global_mean(df, vol, "mean_volume")
            .filter(F.col(vol) > F.col("mean_volume") * F.lit(float(k))))


def alerts(df: DataFrame, volume_k: float = fv.VOLUME_ANOMALY_K_SIMPLE,
           street="street_name", cross="intersection1", vol="volume_vpd",
           avg="average_speed", limit="posted_speed_limit",
           keep=("record_id",)) -> DataFrame:
    """Union of the alert rules in one pass: a row yields one alert per rule it
    breaks (speed above 1.2 x limit; volume above k x mean)."""
    base = with_global_mean(df, vol, "mean_volume")
    loc = location_label(street, cross)
    speed_rule = F.coalesce(F.col(avg) > F.col(limit) * F.lit(fv.VIOLATION_FACTOR_ALERT), F.lit(False))
    volume_rule = F.coalesce(F.col(vol) > F.col("mean_volume") * F.lit(float(volume_k)), F.lit(False))
    speed_alert = F.when(speed_rule, F.struct(
        F.lit(0).alias("rule_pos"),
        F.lit("Speed Violation").alias("alert_type"), F.lit("High").alias("severity"),
        F.concat(F.lit("Speed "), F.col(avg).cast("string"), F.lit(" km/h exceeds limit "),
                 F.col(limit).cast("string"), F.lit(" km/h")).alias("details")))
    volume_alert = F.when(volume_rule, F.struct(
        F.lit(1).alias("rule_pos"),
        F.lit("Volume Anomaly").alias("alert_type"), F.lit("Medium").alias("severity"),
        F.concat(F.lit("Volume "), F.col(vol).cast("string"),
                 F.lit(" vpd is unusually high")).alias("details")))
    fired = F.filter(F.array(speed_alert, volume_alert), lambda a: a.isNotNull())
    return (base.filter(speed_rule | volume_rule)
            .select(*keep, loc.alias("location"), F.inline(fired))
            .drop("rule_pos"))


def with_congestion_ratio(df: DataFrame, avg="average_speed", limit="posted_speed_limit") -> DataFrame:
    ratio = D.speed_compliance(avg, limit)
    return (df.withColumn("speed_compliance", ratio)
              .withColumn("congestion_level", D.congestion_by_ratio(F.col("speed_compliance"))))


def overview(df: DataFrame, volume_k: float = fv.VOLUME_ANOMALY_K_SIMPLE) -> DataFrame:
    """Count, mean volume (truncated), mean speed (1 dp), share of High
    congestion as percent text, and the number of alerts: one aggregation pass."""
    ratio = D.speed_compliance("average_speed", "posted_speed_limit")
    high = (D.congestion_by_ratio(ratio) == "High").cast("int")
    base = with_global_mean(df, "volume_vpd", "mean_volume")
    n_alerts = (F.coalesce(F.col("average_speed") > F.col("posted_speed_limit")
                           * F.lit(fv.VIOLATION_FACTOR_ALERT), F.lit(False)).cast("int")
                + F.coalesce(F.col("volume_vpd") > F.col("mean_volume") * F.lit(float(volume_k)),
                             F.lit(False)).cast("int"))
    agg = base.agg(
        F.count(F.lit(1)).alias("total_locations"),
        F.avg("volume_vpd").alias("_avg_volume"),
        F.avg("average_speed").alias("_avg_speed"),
        F.sum(high).alias("_n_high"),
        F.sum(n_alerts).alias("anomalies_detected"))
    return agg.select(
        "total_locations",
        F.col("_avg_volume").cast("bigint").alias("average_volume"),
        F.round("_avg_speed", 1).alias("average_speed"),
        F.concat(F.round(F.try_divide(F.col("_n_high") * F.lit(100.0), F.col("total_locations")), 1)
                 .cast("string"), F.lit("%")).alias("congestion_level"),
        F.col("anomalies_detected").cast("bigint").alias("anomalies_detected"))


def filter_condition(road_type: str = "All", status: str = "All", volume_range: tuple | None = None):
    """Optional equality filters ('All' bypasses) and an inclusive volume range.
    NULL volume fails the range test."""
    cond = F.lit(True)
    if road_type != "All":
        cond = cond & (F.col("road_type") == road_type)
    if status != "All":
        cond = cond & (F.col("status") == status)
    if volume_range is not None:
        cond = cond & F.col("volume_vpd").between(*volume_range)
    return F.coalesce(cond, F.lit(False))


def apply_filters(df: DataFrame, road_type: str = "All", status: str = "All",
                  volume_range: tuple | None = None) -> DataFrame:
    """The rows that :func:`filter_condition` keeps."""
    return df.filter(filter_condition(road_type, status, volume_range))


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add constant columns that are absent."""
    missing = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def kpi_cards(df: DataFrame, **filters) -> DataFrame:
    """Count, delta against the unfiltered count, mean and std volume,
    violation and anomaly counts and shares of the filtered rows (dashboard
    rounding), in one pass."""
    d = ensure_columns(df, {"is_anomaly": False}).withColumn("_in", filter_condition(**filters))
    viol = D.speed_violation("average_speed", "posted_speed_limit", fv.VIOLATION_FACTOR_DASHBOARD)

    def inside(x):
        return F.when(F.col("_in"), x)

    agg = d.agg(
        F.count_if("_in").alias("total_locations"), F.count(F.lit(1)).alias("_n_all"),
        F.avg(inside(F.col("volume_vpd"))).alias("_mean"),
        F.stddev_samp(inside(F.col("volume_vpd"))).alias("_std"),
        F.sum(inside(viol.cast("int"))).alias("_viol"),
        F.avg(inside(viol.cast("double"))).alias("_viol_share"),
        F.sum(inside(F.col("is_anomaly").cast("int"))).alias("_anom"),
        F.avg(inside(F.col("is_anomaly").cast("double"))).alias("_anom_share"))
    return agg.select(
        "total_locations",
        (F.col("total_locations") - F.col("_n_all")).alias("delta_from_original"),
        F.round("_mean", 0).alias("average_volume"),
        F.round("_std", 0).alias("volume_std"),
        F.coalesce(F.col("_viol"), F.lit(0)).cast("bigint").alias("speed_violations"),
        F.round(F.col("_viol_share") * 100, 1).alias("violation_pct"),
        F.coalesce(F.col("_anom"), F.lit(0)).cast("bigint").alias("anomalies"),
        F.round(F.col("_anom_share") * 100, 1).alias("anomaly_pct"))


def anomaly_summary(df: DataFrame, key: str = "road_type") -> DataFrame:
    """Per class: locations, anomalies, mean score (3 dp), rate % (1 dp)."""
    g = (df.filter(F.col(key).isNotNull()).groupBy(key)
           .agg(F.count("is_anomaly").alias("total_locations"),
                F.sum(F.col("is_anomaly").cast("int")).cast("bigint").alias("anomalies"),
                F.avg("anomaly_score").alias("_score")))
    return g.select(
        key, "total_locations", "anomalies",
        F.round("_score", 3).alias("avg_anomaly_score"),
        F.round(F.try_divide(F.col("anomalies") * F.lit(100.0), F.col("total_locations")), 1)
         .alias("anomaly_rate"))


def road_profile(df: DataFrame, key: str = "road_type") -> DataFrame:
    """Per class: volume mean/std/min/max, speed mean/std, violation and
    anomaly counts, rounded to 2 dp."""
    d = ensure_columns(df, {"is_anomaly": False})
    viol = D.speed_violation("average_speed", "posted_speed_limit", fv.VIOLATION_FACTOR_DASHBOARD)
    return (d.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.round(F.avg("volume_vpd"), 2).alias("volume_mean"),
        F.round(F.stddev_samp("volume_vpd"), 2).alias("volume_std"),
        F.min("volume_vpd").alias("volume_min"),
        F.max("volume_vpd").alias("volume_max"),
        F.round(F.avg("average_speed"), 2).alias("speed_mean"),
        F.round(F.stddev_samp("average_speed"), 2).alias("speed_std"),
        F.sum(viol.cast("int")).cast("bigint").alias("speed_violations"),
        F.sum(F.col("is_anomaly").cast("int")).cast("bigint").alias("anomalies")))


def _cents(col: str):
    # Exact money arithmetic: sums of DECIMAL do not depend on the order rows arrive in.
    return F.col(col).cast("decimal(18,2)")


def cost_by_class(df: DataFrame, key: str = "road_type", cost: str = "estimated_cost") -> DataFrame:
    """Over positive costs: sum, mean, count per class (0 dp)."""
    g = (df.filter((F.col(cost) > 0) & F.col(key).isNotNull()).groupBy(key)
           .agg(F.sum(_cents(cost)).alias("_sum"), F.count(F.lit(1)).alias("cost_count")))
    total = F.col("_sum").cast("double")
    return g.select(key, F.round(total, 0).alias("cost_sum"),
                    F.round(total / F.col("cost_count"), 0).alias("cost_mean"), "cost_count")


def cost_share(df: DataFrame, key: str = "road_type", cost: str = "estimated_cost") -> DataFrame:
    """Share of the positive cost per class (pie): class sum / sum of all."""
    g = (df.filter((F.col(cost) > 0) & F.col(key).isNotNull()).groupBy(key)
           .agg(F.sum(_cents(cost)).alias("_sum")))
    total = g.agg(F.sum(F.col("_sum").cast("double")).alias("_all"))  # one row
    return g.crossJoin(F.broadcast(total)).select(
        key, F.col("_sum").cast("double").alias("cost_total"),
        (F.col("_sum").cast("double") / F.col("_all")).alias("cost_share"))


def volume_pivot(df: DataFrame, classes=tuple(ROAD_CLASSES)) -> DataFrame:
    """Mean volume, location x road class, missing cells 0.  The pivot values
    are given, so no extra job computes them."""
    loc = location_label("street_name", "intersection1")
    p = (df.filter(F.col("volume_vpd").isNotNull() & F.col("road_type").isNotNull())
           .withColumn("location", loc)
           .groupBy("location").pivot("road_type", list(classes)).agg(F.avg("volume_vpd")))
    return p.na.fill(0.0, subset=list(classes))


def value_counts(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per value, the most frequent first (of equals, by value)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), key))


def histogram(df: DataFrame, value: str = "volume_vpd", key: str = "road_type",
              bins: int = 20) -> DataFrame:
    """Counts per (class, bin) over equal-width bins spanning the global
    [min, max]; the maximum falls in the last bin."""
    rng = df.agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    v = F.col(value).cast("double")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    raw = F.floor(F.try_divide(v - F.col("_lo"), width)) + 1
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(F.least(raw, F.lit(bins)))
    return (df.filter(F.col(value).isNotNull() & F.col(key).isNotNull())
              .crossJoin(F.broadcast(rng))
              .withColumn("bin", b.cast("bigint"))
              .groupBy(key, "bin", "_lo", "_hi")
              .agg(F.count(F.lit(1)).alias("n"))
              .select(key, "bin",
                      (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
                      .alias("bin_start"),
                      "n"))


def quartiles(base: DataFrame, value: str, key: str, qs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Per key: n, min, max and ``q0``, ``q1``, ... by linear interpolation, exact, by radix selection."""
    from roadlens.operators.selection import quantiles
    return quantiles(base, value, key, tuple(qs))


def box_summary(df: DataFrame, value: str = "average_speed", key: str = "road_type") -> DataFrame:
    """Quartiles (linear interpolation), whiskers at the most extreme values
    inside 1.5 IQR, and the count of points outside."""
    from roadlens.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    # Two columns, read by the selection and by the whisker pass: written once.
    base = df.filter(F.col(value).isNotNull() & F.col(key).isNotNull()).select(key, value).checkpoint(eager=True)
    q = quartiles(base, value, key).select(key, "min", F.round("q0", 6).alias("q1"), F.round("q1", 6).alias("median"),
                                           F.round("q2", 6).alias("q3"), "max")
    # One row per class, read by the whisker pass and by the result: write it once.
    from roadlens.operators.quality import _materialised
    q = _materialised(q)
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_fence", F.col("q1") - F.lit(1.5) * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * F.col("iqr")))
    # One row per class: joined back by key (broadcast chosen by size at run time).
    j = base.select(key, value).join(q.select(key, "lower_fence", "upper_fence"), key)
    inside = (F.col(value) >= F.col("lower_fence")) & (F.col(value) <= F.col("upper_fence"))
    w = (j.groupBy(key).agg(
            F.min(F.when(inside, F.col(value))).alias("lower_whisker"),
            F.max(F.when(inside, F.col(value))).alias("upper_whisker"),
            F.count_if(~inside).alias("outliers")))
    return q.join(w, key)


def distinct_bounds(df: DataFrame) -> DataFrame:
    """Filter controls: distinct classes and statuses, volume min and max (long form)."""
    road = df.filter(F.col("road_type").isNotNull()).select(
        F.lit("road_type").alias("control"), F.col("road_type").alias("value")).distinct()
    status = df.filter(F.col("status").isNotNull()).select(
        F.lit("status").alias("control"), F.col("status").alias("value")).distinct()
    mm = df.agg(F.min("volume_vpd").alias("lo"), F.max("volume_vpd").alias("hi"))
    bounds = mm.select(F.inline(F.array(
        F.struct(F.lit("volume_min").alias("control"), F.col("lo").cast("string").alias("value")),
        F.struct(F.lit("volume_max").alias("control"), F.col("hi").cast("string").alias("value")))))
    return road.unionByName(status).unionByName(bounds)


def top_k(df: DataFrame, k: int, order_cols: list) -> DataFrame:
    """The first k rows of a total order (TakeOrderedAndProject: per-partition
    top k, then a k x partitions merge)."""
    return df.orderBy(*order_cols).limit(k)
