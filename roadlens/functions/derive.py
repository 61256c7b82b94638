"""Derived traffic measures as Column expressions.

NULL handling follows the pandas behaviour being reproduced: comparisons with
a missing value are false, so every flag is coalesced to false, and every
division is ``try_divide`` (NULL instead of inf/NaN or an ANSI error).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlens import fixed_values as fv


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def speed_violation(avg="average_speed", limit="posted_speed_limit",
                    factor: float = fv.VIOLATION_FACTOR_DASHBOARD) -> Column:
    return F.coalesce(_c(avg) > _c(limit) * F.lit(float(factor)), F.lit(False))


def speed_compliance(avg="average_speed", limit="posted_speed_limit") -> Column:
    return F.try_divide(_c(avg).cast("double"), _c(limit).cast("double"))


def congestion_by_ratio(ratio: Column) -> Column:
    """< 0.8 High, < 1.0 Medium, otherwise (and NULL) Low."""
    return (F.when(ratio < F.lit(fv.CONGESTION_RATIO_HIGH), "High")
             .when(ratio < F.lit(fv.CONGESTION_RATIO_MEDIUM), "Medium")
             .otherwise("Low"))


def congestion_by_speed(avg="average_speed", limit="posted_speed_limit",
                        labels=("High", "Medium", "Low")) -> Column:
    """speed < 0.7 x limit High, < 0.9 x limit Medium, else (and NULL) Low."""
    hi, med, low = labels
    a, lim = _c(avg), _c(limit)
    return (F.when(a < lim * F.lit(fv.CONGESTION_SPEED_HIGH), hi)
             .when(a < lim * F.lit(fv.CONGESTION_SPEED_MEDIUM), med)
             .otherwise(low))


def volume_category(vol="volume_vpd") -> Column:
    """Right-closed bins (0,1000] (1000,3000] (3000,5000] (5000,inf); <= 0 and NULL -> NULL."""
    v = _c(vol)
    b, lab = fv.VOLUME_BINS, fv.VOLUME_LABELS
    expr = F.when((v > b[0]) & (v <= b[1]), lab[0])
    for i in range(1, len(lab)):
        hi = b[i + 1]
        cond = (v > b[i]) if math.isinf(hi) else ((v > b[i]) & (v <= hi))
        expr = expr.when(cond, lab[i])
    return expr


def road_multiplier(road="road_type") -> Column:
    r = _c(road)
    expr = None
    for k, m in fv.ROAD_MULTIPLIER.items():
        expr = F.when(r == k, F.lit(m)) if expr is None else expr.when(r == k, F.lit(m))
    return expr.otherwise(F.lit(fv.DEFAULT_MULTIPLIER))


def time_factor(hour: int = fv.HEURISTIC_HOUR) -> float:
    """1 + 0.2 sin(2 pi h / 24), evaluated once at plan time."""
    import numpy as np
    return float(1.0 + fv.TIME_FACTOR_AMPLITUDE * np.sin(2 * np.pi * hour / 24))


def heuristic_volume(vol="volume_vpd", road="road_type", hour: int = fv.HEURISTIC_HOUR) -> Column:
    """volume x class multiplier x time factor, truncated; NULL volume -> NULL."""
    prod = _c(vol).cast("double") * road_multiplier(road) * F.lit(time_factor(hour))
    return prod.try_cast("bigint")


def change_percent(pred, actual, digits: int = 1) -> Column:
    raw = F.try_divide((_c(pred) - _c(actual)).cast("double"), _c(actual).cast("double")) * F.lit(100.0)
    return F.round(raw, digits)


def change_percent_raw(pred, actual) -> Column:
    return F.try_divide((_c(pred) - _c(actual)).cast("double"), _c(actual).cast("double")) * F.lit(100.0)


def scoring_columns(vol="volume_vpd", avg="average_speed", limit="posted_speed_limit") -> dict:
    """Batch form of the scoring request: prediction, confidence, score, flag."""
    score = F.when(F.coalesce(_c(avg) > _c(limit) * F.lit(fv.VIOLATION_FACTOR_ALERT), F.lit(False)),
                   F.lit(fv.SCORING_SCORE_VIOLATION)).otherwise(F.lit(fv.SCORING_SCORE_NORMAL))
    return {
        "predicted_volume": _c(vol).cast("double") * F.lit(fv.SCORING_VOLUME_FACTOR),
        "confidence": F.lit(fv.SCORING_CONFIDENCE),
        "anomaly_score": score,
        "is_anomaly": score < F.lit(fv.SCORING_ANOMALY_BELOW),
    }


def row_quality_score(record_id="record_id", street="street_name", vol="volume_vpd",
                      avg="average_speed", limit="posted_speed_limit") -> Column:
    """1 - 0.2 per missing critical field (empty, NULL or zero count as missing)
    - 0.1 per negative measure, clamped to [0, 1]."""
    def missing_text(x):
        return F.coalesce(_c(x) == "", F.lit(True)).cast("int")

    def missing_num(x):
        return F.coalesce(_c(x) == 0, F.lit(True)).cast("int")

    def negative(x):
        return F.coalesce(_c(x) < 0, F.lit(False)).cast("int")

    missing = missing_text(record_id) + missing_text(street) + missing_num(vol) + missing_num(avg)
    neg = negative(vol) + negative(avg) + negative(limit)
    score = (F.lit(1.0) - missing.cast("double") * F.lit(fv.ROW_MISSING_DEDUCTION)
             - neg.cast("double") * F.lit(fv.ROW_NEGATIVE_DEDUCTION))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def hour_and_weekday(ts) -> tuple[Column, Column]:
    """Hour of day and Monday-based weekday (Monday = 0)."""
    return F.hour(_c(ts)), F.weekday(_c(ts))


def agreement_confidence(a, b) -> Column:
    """1 - |a - b| / max(a, b, 1)."""
    return F.lit(1.0) - F.abs(_c(a) - _c(b)) / F.greatest(_c(a), _c(b), F.lit(1.0))


def road_type_code(road="road_type") -> Column:
    r = _c(road)
    expr = None
    for k, code in fv.ROAD_TYPE_CODE.items():
        expr = F.when(r == k, F.lit(code)) if expr is None else expr.when(r == k, F.lit(code))
    return expr
