"""Data-quality checks fused into few aggregation passes.

Each check returns a small long-form DataFrame (one row per column, rule or
issue).  The wide input is scanned once per check at most, with all counters
of a check inside one ``agg``; results are combined by cross joins of
one-row (or few-row) frames, never by collecting to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens import fixed_values as fv
from roadlens.functions import coerce as C
from roadlens.session import written

MAX_BROADCAST_ROWS = 100_000
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def _long(one_row: DataFrame, entries: list[tuple[str, list]], names: list[str]) -> DataFrame:
    """Turn a one-row frame into long form: one struct per entry."""
    structs = [F.struct(F.lit(key).alias(names[0]), F.lit(pos).alias("position"),
                        *[e.alias(n) for e, n in zip(exprs, names[1:])])
               for pos, (key, exprs) in enumerate(entries)]
    return one_row.select(F.inline(F.array(*structs)))


def completeness(df: DataFrame) -> DataFrame:
    """Per column: total, non-null, null count, completeness %, complete (>= 95%)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(f"`{c}`")).alias(f"__nn{i}") for i, c in enumerate(cols)])
    entries = [(c, [F.col("__n"), F.col(f"__nn{i}")]) for i, c in enumerate(cols)]
    out = _long(agg, entries, ["column", "total_values", "non_null_values"])
    pct = F.try_divide(F.col("non_null_values") * F.lit(100.0), F.col("total_values"))
    return out.select(
        "column", "position", "total_values", "non_null_values",
        (F.col("total_values") - F.col("non_null_values")).alias("null_count"),
        pct.alias("completeness_percentage"),
        (pct >= F.lit(fv.COMPLETE_PCT)).alias("is_complete"))


def duplicates(df: DataFrame) -> DataFrame:
    """Rows repeating an earlier identical row (NULLs equal): count, %, acceptable.

    Rows are grouped by two 64-bit hashes first, so only these are shuffled;
    the groups with several rows are then counted by their real columns.  The
    hashes of these groups are written once: few are broadcast, so the other
    rows stay where they are.  Partial aggregation collapses hot groups before
    either shuffle."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.withColumns({"__h1": F.xxhash64(*cols), "__h2": F.xxhash64(F.lit(1), *reversed(cols))})
    groups = hashed.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__c"))
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    several = written(groups.filter(F.col("__c") > 1).select("__h1", "__h2"), "several")
    if several.count() <= MAX_BROADCAST_ROWS:
        several = F.broadcast(several)
    exact = hashed.join(several, ["__h1", "__h2"], "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    agg = exact.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).alias("count")).crossJoin(total)
    share = F.try_divide(F.col("count"), F.col("__n"))
    return agg.select(F.col("count").cast("bigint").alias("count"), (share * 100).alias("percentage"),
                      (share < F.lit(fv.DUPLICATE_ACCEPTABLE_SHARE)).alias("is_acceptable"))


def type_consistency(df: DataFrame) -> DataFrame:
    """Text columns: 'numeric_string' when every non-null value parses as a
    number, else 'text'.  Other columns: their type name."""
    fields = df.schema.fields
    str_cols = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    aggs = []
    for i, c in enumerate(str_cols):
        aggs.append(F.count(F.col(f"`{c}`")).alias(f"__n{i}"))
        # '12d' is no number, though a cast takes it; '' is a missing one.
        aggs.append(F.count_if(F.col(f"`{c}`").rlike(C.NUMBER) | (F.col(f"`{c}`") == "")).alias(f"__p{i}"))
    one = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    entries = []
    for f in fields:
        if isinstance(f.dataType, T.StringType):
            i = str_cols.index(f.name)
            kind = F.when(F.col(f"__n{i}") == F.col(f"__p{i}"), "numeric_string").otherwise("text")
        else:
            kind = F.lit(f.dataType.simpleString())
        entries.append((f.name, [kind]))
    return _long(one, entries, ["column", "kind"])


def _rules_for(df: DataFrame, column_map: dict | None):
    column_map = column_map or {"volume": "volume_vpd"}
    out = []
    for rule_col, rules in fv.QUALITY_RULES.items():
        c = column_map.get(rule_col, rule_col)
        if c in df.columns:
            out.append((rule_col, c, rules))
    return out


def column_rules(df: DataFrame, column_map: dict | None = None) -> DataFrame:
    """Per ruled column: required NULLs, below min, above max, short strings,
    pattern misses; the number of failing checks and a valid flag."""
    dtypes = dict(df.dtypes)
    rules = _rules_for(df, column_map)
    aggs, entries = [], []
    for i, (rule_col, c, r) in enumerate(rules):
        x = F.col(c)
        is_text = dtypes[c] == "string"
        checks = {
            "required_nulls": F.count_if(x.isNull()) if r.get("required") else None,
            "below_min": F.count_if(x < F.lit(r["min_value"])) if "min_value" in r else None,
            "above_max": F.count_if(x > F.lit(r["max_value"])) if "max_value" in r else None,
            "short_strings": (F.count_if(F.length(x) < F.lit(r["min_length"]))
                              if "min_length" in r and is_text else None),
            "pattern_misses": (F.count_if(~F.coalesce(x.rlike(r["pattern"]), F.lit(False)))
                               if "pattern" in r and is_text else None),
        }
        exprs = []
        for k, e in checks.items():
            if e is None:
                exprs.append(F.lit(None).cast("bigint"))
            else:
                aggs.append(e.alias(f"__{k}{i}"))
                exprs.append(F.col(f"__{k}{i}"))
        entries.append((c, exprs))
    one = df.agg(*aggs)
    names = ["column", "required_nulls", "below_min", "above_max", "short_strings", "pattern_misses"]
    out = _long(one, entries, names)
    issue_count = reduce(lambda a, b: a + b,
                         [F.coalesce((F.col(n) > 0).cast("int"), F.lit(0)) for n in names[1:]])
    return out.withColumn("issue_count", issue_count.cast("bigint")) \
              .withColumn("is_valid", F.col("issue_count") == 0)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def zscore_outliers(df: DataFrame, cols: list[str] | None = None, table: str = "") -> DataFrame:
    """Per numeric column with data: count of |z| > 3 (sample std), %, severity;
    and a 'no_variation' entry when the std is 0.  Two passes: moments, counts."""
    cols = cols or numeric_columns(df)
    stats = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(F.col(c).cast("double")).alias(f"__m{i}"),
        F.stddev_samp(F.col(c).cast("double")).alias(f"__s{i}"),
        F.count(F.col(c)).alias(f"__n{i}"))])
    stats = _materialised(stats)   # read twice: by the count pass and by the result
    joined = df.select(*cols).crossJoin(F.broadcast(stats))
    counts = []
    for i, c in enumerate(cols):
        z = F.abs(F.try_divide(F.col(c).cast("double") - F.col(f"__m{i}"), F.col(f"__s{i}")))
        counts.append(F.count_if(F.coalesce(z > F.lit(fv.ZSCORE_LIMIT), F.lit(False))).alias(f"__o{i}"))
    one = joined.agg(*counts).crossJoin(stats)
    entries = []
    for i, c in enumerate(cols):
        n, o, s = F.col(f"__n{i}"), F.col(f"__o{i}"), F.col(f"__s{i}")
        entries.append((c, [n, o, s]))
    long = _long(one, entries, ["column", "n", "outliers", "std"])
    outl = long.filter((F.col("n") > 0) & (F.col("outliers") > 0)).select(
        "column", "position", F.lit("statistical_outlier").alias("type"),
        F.col("outliers").alias("count"),
        (F.col("outliers") * F.lit(100.0) / F.col("n")).alias("percentage"),
        F.when(F.col("outliers") > F.col("n") * F.lit(fv.OUTLIER_HIGH_SHARE), "high")
         .otherwise("medium").alias("severity"))
    flat = long.filter((F.col("n") > 0) & (F.col("std") == 0)).select(
        "column", "position", F.lit("no_variation").alias("type"), F.col("n").alias("count"),
        F.lit(100.0).alias("percentage"), F.lit("high").alias("severity"))
    out = outl.unionByName(flat)
    return out.withColumn("table", F.lit(table)) if table else out


def volume_ranges(spark) -> DataFrame:
    """Expected volume range per road class (a four-row configuration table)."""
    return spark.createDataFrame([(k, float(lo), float(hi)) for k, (lo, hi) in fv.VOLUME_RANGES.items()],
                                 "road_type string, min_volume double, max_volume double")


def business_rules(df: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Speed above 1.2 x limit (medium), volume outside its class range (low,
    one issue per class), p85 below average speed (high); only counts > 0.

    One pass over the data: an equi-join with the (few-row, broadcast) range
    table, then a grouped count per class, then a sum over the classes."""
    ranges = ranges if ranges is not None else volume_ranges(df.sparkSession)
    order = {k: i for i, k in enumerate(fv.VOLUME_RANGES)}
    # A rule whose columns are absent finds nothing (absent reads as NULL).
    needed = {"road_type": "string", "volume_vpd": "double", "average_speed": "double",
              "posted_speed_limit": "double", "percentile_speed_85": "double"}
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in needed.items() if c not in df.columns})
    # The range table is configuration (one row per class); it is broadcast only
    # after its size is checked, otherwise the planner chooses the join.
    small = ranges.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    side = F.broadcast(ranges) if small else ranges
    j = df.select("road_type", "volume_vpd", "average_speed", "posted_speed_limit",
                  "percentile_speed_85").join(side, "road_type", "left")
    per_class = j.groupBy("road_type").agg(
        F.count_if(F.col("average_speed") > F.col("posted_speed_limit") * F.lit(fv.VIOLATION_FACTOR_ALERT))
         .alias("speed"),
        F.count_if(F.col("percentile_speed_85") < F.col("average_speed")).alias("p85"),
        F.count_if(F.col("min_volume").isNotNull()
                   & ((F.col("volume_vpd") < F.col("min_volume")) | (F.col("volume_vpd") > F.col("max_volume"))))
         .alias("vol"))
    per_class = _materialised(per_class)   # one row per class, read twice below
    totals = per_class.agg(F.sum("speed").alias("speed"), F.sum("p85").alias("p85"))
    speed = totals.select(
        F.lit(0).alias("position"), F.lit("speed_limit_violation").alias("rule"),
        F.lit("Average speed exceeds posted limit by >20%").alias("description"),
        F.col("speed").cast("bigint").alias("count"), F.lit("medium").alias("severity"))
    pos = F.lit(None).cast("int")
    for k, i in order.items():
        pos = F.when(F.col("road_type") == k, F.lit(1 + i)).otherwise(pos)
    vol = per_class.filter(F.col("road_type").isin(list(order))).select(
        pos.alias("position"), F.lit("volume_range_violation").alias("rule"),
        F.concat(F.lit("Volume outside expected range for "), F.col("road_type")).alias("description"),
        F.col("vol").cast("bigint").alias("count"), F.lit("low").alias("severity"))
    p85 = totals.select(
        F.lit(1 + len(order)).alias("position"), F.lit("percentile_speed_violation").alias("rule"),
        F.lit("85th percentile speed lower than average speed").alias("description"),
        F.col("p85").cast("bigint").alias("count"), F.lit("high").alias("severity"))
    return speed.unionByName(vol).unionByName(p85).filter(F.col("count") > 0)


def _severity_deduction(col) -> F.Column:
    d = fv.SEVERITY_DEDUCTION
    return (F.when(col == "high", F.lit(d["high"])).when(col == "medium", F.lit(d["medium"]))
             .otherwise(F.lit(d["low"])))


def profile(df: DataFrame, numeric: list[str] | None = None) -> DataFrame:
    """Every global counter of the quality checks in ONE aggregation pass:
    row and non-null counts, column-rule counts, moments of the numeric
    columns, and the business-rule counts (class ranges from the fixed
    configuration).  Sections derived from this one-row frame share it, so a
    report built on it scans the data once (plus the z-score and duplicate
    passes)."""
    cols = df.columns
    numeric = numeric if numeric is not None else numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"__nn{i}") for i, c in enumerate(cols)]
    dtypes = dict(df.dtypes)
    for i, (_, c, r) in enumerate(_rules_for(df, None)):
        x = F.col(c)
        text = dtypes[c] == "string"
        if r.get("required"):
            aggs.append(F.count_if(x.isNull()).alias(f"__required_nulls{i}"))
        if "min_value" in r:
            aggs.append(F.count_if(x < F.lit(r["min_value"])).alias(f"__below_min{i}"))
        if "max_value" in r:
            aggs.append(F.count_if(x > F.lit(r["max_value"])).alias(f"__above_max{i}"))
        if "min_length" in r and text:
            aggs.append(F.count_if(F.length(x) < F.lit(r["min_length"])).alias(f"__short_strings{i}"))
        if "pattern" in r and text:
            aggs.append(F.count_if(~F.coalesce(x.rlike(r["pattern"]), F.lit(False))).alias(f"__pattern_misses{i}"))
    for i, c in enumerate(numeric):
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"__m{i}"), F.stddev_samp(v).alias(f"__s{i}"), F.count(v).alias(f"__cn{i}")]
    have = set(cols)
    if {"average_speed", "posted_speed_limit"} <= have:
        aggs.append(F.count_if(F.col("average_speed") > F.col("posted_speed_limit")
                               * F.lit(fv.VIOLATION_FACTOR_ALERT)).alias("__b_speed"))
    if {"percentile_speed_85", "average_speed"} <= have:
        aggs.append(F.count_if(F.col("percentile_speed_85") < F.col("average_speed")).alias("__b_p85"))
    if {"road_type", "volume_vpd"} <= have:
        for j, (k, (lo, hi)) in enumerate(fv.VOLUME_RANGES.items()):
            aggs.append(F.count_if((F.col("road_type") == k)
                                   & ((F.col("volume_vpd") < F.lit(float(lo)))
                                      | (F.col("volume_vpd") > F.lit(float(hi))))).alias(f"__b_vol{j}"))
    return df.agg(*aggs)


def _materialised(one_row: DataFrame) -> DataFrame:
    """The profile row is read by every section; write it once (one row) to
    the checkpoint folder so the data pass behind it runs once."""
    from roadlens.session import checkpoint_dir
    checkpoint_dir(one_row.sparkSession)
    return one_row.checkpoint(eager=True)


def _sections_from_profile(df: DataFrame, prof: DataFrame, numeric: list[str]):
    cols = df.columns
    # completeness
    comp = _long(prof, [(c, [F.col("__n"), F.col(f"__nn{i}")]) for i, c in enumerate(cols)],
                 ["column", "total_values", "non_null_values"])
    pct = F.try_divide(F.col("non_null_values") * F.lit(100.0), F.col("total_values"))
    comp = comp.select("column", "position", "total_values", pct.alias("completeness_percentage"),
                       (pct >= F.lit(fv.COMPLETE_PCT)).alias("is_complete"))
    # column rules
    names = ["required_nulls", "below_min", "above_max", "short_strings", "pattern_misses"]
    entries = []
    for i, (_, c, _r) in enumerate(_rules_for(df, None)):
        entries.append((c, [F.col(f"__{n}{i}") if f"__{n}{i}" in prof.columns else F.lit(None).cast("bigint")
                            for n in names]))
    rules = _long(prof, entries, ["column"] + names)
    issue_count = reduce(lambda a, b: a + b, [F.coalesce((F.col(n) > 0).cast("int"), F.lit(0)) for n in names])
    rules = rules.withColumn("issue_count", issue_count.cast("bigint"))
    # z-scores: a second pass against the broadcast moments
    counts = []
    for i, c in enumerate(numeric):
        z = F.abs(F.try_divide(F.col(c).cast("double") - F.col(f"__m{i}"), F.col(f"__s{i}")))
        counts.append(F.count_if(F.coalesce(z > F.lit(fv.ZSCORE_LIMIT), F.lit(False))).alias(f"__o{i}"))
    moments = prof.select(*[F.col(f"__{k}{i}") for i in range(len(numeric)) for k in ("m", "s", "cn")])
    zc = df.select(*numeric).crossJoin(F.broadcast(moments)).agg(*counts)
    zl = _long(zc.crossJoin(moments), [(c, [F.col(f"__cn{i}"), F.col(f"__o{i}"), F.col(f"__s{i}")])
                                        for i, c in enumerate(numeric)], ["column", "n", "outliers", "std"])
    anom = zl.filter((F.col("n") > 0) & (F.col("outliers") > 0)).select(
        F.when(F.col("outliers") > F.col("n") * F.lit(fv.OUTLIER_HIGH_SHARE), "high").otherwise("medium")
         .alias("severity")).unionByName(
        zl.filter((F.col("n") > 0) & (F.col("std") == 0)).select(F.lit("high").alias("severity")))
    # business rules
    parts = []
    if "__b_speed" in prof.columns:
        parts.append(prof.select(F.col("__b_speed").alias("count"), F.lit("medium").alias("severity")))
    for j in range(len(fv.VOLUME_RANGES)):
        if f"__b_vol{j}" in prof.columns:
            parts.append(prof.select(F.col(f"__b_vol{j}").alias("count"), F.lit("low").alias("severity")))
    if "__b_p85" in prof.columns:
        parts.append(prof.select(F.col("__b_p85").alias("count"), F.lit("high").alias("severity")))
    biz = reduce(lambda a, b: a.unionByName(b), parts).filter(F.col("count") > 0) if parts else None
    return comp, rules, anom, biz


def quality_score(df: DataFrame, anomalies: DataFrame | None = None,
                  numeric: list[str] | None = None) -> DataFrame:
    """Dataset score: 1 - completeness, duplicate, column-issue, anomaly and
    business-rule deductions, clamped to [0, 1] (one row).

    Built on :func:`profile`: one aggregation pass for the counters, one for
    the z-score counts and one grouping pass for duplicates."""
    numeric = numeric if numeric is not None else numeric_columns(df)
    prof = _materialised(profile(df, numeric))
    comp, rules, anom, biz = _sections_from_profile(df, prof, numeric)
    if anomalies is not None:
        anom = anomalies.select("severity")
    dup = duplicates(df)
    c = comp.agg(F.sum(F.when(~F.coalesce("is_complete", F.lit(True)),
                              (F.lit(100.0) - F.col("completeness_percentage")) / F.lit(1000.0))
                       .otherwise(F.lit(0.0))).alias("d_completeness"),
                 F.max("total_values").alias("total_records"))
    d = dup.select(F.when(~F.coalesce("is_acceptable", F.lit(True)), F.col("percentage") / F.lit(100.0))
                   .otherwise(F.lit(0.0)).alias("d_duplicates"))
    r = rules.agg(F.sum("issue_count").alias("column_issues"))
    a = anom.agg(F.coalesce(F.sum(F.when(F.col("severity") == "high", F.lit(0.1))
                                  .when(F.col("severity") == "medium", F.lit(0.05))
                                  .otherwise(F.lit(0.0))), F.lit(0.0)).alias("d_anomalies"))
    if biz is not None:
        b = biz.agg(F.coalesce(F.sum(_severity_deduction(F.col("severity"))), F.lit(0.0)).alias("d_business"))
    else:
        b = prof.select(F.lit(0.0).alias("d_business"))
    one = c.crossJoin(d).crossJoin(r).crossJoin(a).crossJoin(b)
    d_cols = F.least(F.lit(fv.COLUMN_ISSUE_CAP),
                     F.try_divide(F.col("column_issues").cast("double"), F.col("total_records").cast("double")))
    raw = (F.lit(1.0) - F.col("d_completeness") - F.col("d_duplicates") - F.coalesce(d_cols, F.lit(0.0))
           - F.col("d_anomalies") - F.col("d_business"))
    return one.select(
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 6).alias("quality_score"),
        F.col("total_records"),
        F.round("d_completeness", 6).alias("d_completeness"),
        F.round("d_duplicates", 6).alias("d_duplicates"),
        F.col("column_issues").cast("bigint").alias("column_issues"),
        F.round("d_anomalies", 6).alias("d_anomalies"),
        F.round("d_business", 6).alias("d_business"))


def recommendations(df: DataFrame, anomalies: DataFrame | None = None,
                    numeric: list[str] | None = None) -> DataFrame:
    """Improvement texts from the sections, in their fixed order (built on
    :func:`profile`, like the score)."""
    numeric = numeric if numeric is not None else numeric_columns(df)
    prof = _materialised(profile(df, numeric))
    comp, _rules, anom, biz = _sections_from_profile(df, prof, numeric)
    if anomalies is not None:
        anom = anomalies.select("severity")
    dup = duplicates(df)
    inc = comp.filter(~F.col("is_complete")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))),
                                 lambda s: s["column"]), ", ").alias("cols"),
        F.count(F.lit(1)).alias("n"))
    r1 = inc.filter(F.col("n") > 0).select(
        F.lit(1).alias("seq"), F.concat(F.lit("Improve data completeness for columns: "), "cols").alias("recommendation"))
    r2 = dup.filter(~F.col("is_acceptable")).select(
        F.lit(2).alias("seq"), F.concat(F.lit("Remove "), F.col("count").cast("string"),
                                        F.lit(" duplicate records")).alias("recommendation"))
    ha = anom.filter(F.col("severity") == "high").agg(F.count(F.lit(1)).alias("n"))
    r3 = ha.filter(F.col("n") > 0).select(
        F.lit(3).alias("seq"), F.concat(F.lit("Investigate "), F.col("n").cast("string"),
                                        F.lit(" high-severity data anomalies")).alias("recommendation"))
    out = r1.unionByName(r2).unionByName(r3)
    if biz is not None:
        hb = biz.filter(F.col("severity") == "high").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(hb.filter(F.col("n") > 0).select(
            F.lit(4).alias("seq"), F.concat(F.lit("Address "), F.col("n").cast("string"),
                                            F.lit(" high-severity business rule violations")).alias("recommendation")))
    return out
