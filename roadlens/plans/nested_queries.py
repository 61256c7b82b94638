"""Upsert, event envelope, nested export and attachment queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.functions import text as X
from roadlens.operators import attachments as A
from roadlens.operators import etl as E
from roadlens.operators import nested as N
from roadlens.operators import upsert as U
from roadlens.plans.dashboard_queries import KEY, KEY_SQL
from roadlens.plans.etl_queries import _canonical_sql, sql_date, sql_lit, sql_standardise
from roadlens.plans.quality_queries import DEVICE_COLS
from roadlens.plans.registry import register, with_views
from roadlens.sinks.writers import keyed_envelope
from roadlens.sources import tables as T

ORDER = ["received_analysis_date", "src_orderkey", "priority_ranking", "src_partkey", "src_suppkey", "src_price"]
_REST = [c for c in DEVICE_COLS if c not in ORDER and c != "record_id"]
_ORDER_SQL = ", ".join(f"{c} DESC NULLS LAST" for c in ORDER + _REST)
_COLS_SQL = ", ".join(DEVICE_COLS)
SPLIT_DATE = "1998-01-01"
AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)


def _latest_sql(where: str = "") -> str:
    return (f"SELECT {_COLS_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY {_ORDER_SQL}) AS rn "
            f"FROM devices {where}) x WHERE rn = 1")


@register("upsert_latest", ("W2", "K2"), with_views(_latest_sql(), "devices"))
def q_upsert_latest(spark, sf):
    return U.latest_per_key(T.devices(spark, sf), "record_id", ORDER)


_PAYLOAD = [c for c in DEVICE_COLS if c != "record_id"]


@register("upsert_merge", ("K2", "K3", "W2"), with_views(f"""
WITH t AS ({_latest_sql(f"WHERE received_analysis_date < DATE '{SPLIT_DATE}'")}),
s AS ({_latest_sql(f"WHERE received_analysis_date >= DATE '{SPLIT_DATE}'")})
SELECT coalesce(s.record_id, t.record_id) AS record_id,
  {", ".join(f"CASE WHEN s.record_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _PAYLOAD)},
  CASE WHEN s.record_id IS NOT NULL AND t.record_id IS NOT NULL THEN 'update'
       WHEN s.record_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS op
FROM t FULL OUTER JOIN s ON t.record_id = s.record_id
""", "devices"))
def q_upsert_merge(spark, sf):
    d = T.devices(spark, sf)
    split = F.lit(SPLIT_DATE).cast("date")
    target = U.latest_per_key(d.filter(F.col("received_analysis_date") < split), "record_id", ORDER)
    source = d.filter(F.col("received_analysis_date") >= split)
    return U.merge(target, source, "record_id", ORDER, audit=False)


@register("upsert_counts", ("K3",), with_views(f"""
WITH t AS (SELECT DISTINCT record_id FROM devices WHERE received_analysis_date < DATE '{SPLIT_DATE}'),
s AS (SELECT DISTINCT record_id FROM devices WHERE received_analysis_date >= DATE '{SPLIT_DATE}')
SELECT count(*) AS upserted, count(*) FILTER (WHERE t.record_id IS NULL) AS inserted,
  count(*) FILTER (WHERE t.record_id IS NOT NULL) AS updated
FROM s LEFT JOIN t ON s.record_id = t.record_id
""", "devices"))
def q_upsert_counts(spark, sf):
    return U.merge_counts(q_upsert_merge(spark, sf))


@register("upsert_merge_wide", ("K2", "K3", "W2"), with_views(f"""
WITH t AS (SELECT x.*, 'kept ' || record_id AS local_note, TIMESTAMP '2023-05-01 00:00:00' AS created_at,
             TIMESTAMP '2023-06-01 00:00:00' AS updated_at
           FROM ({_latest_sql(f"WHERE received_analysis_date < DATE '{SPLIT_DATE}'")}) x),
s AS ({_latest_sql(f"WHERE received_analysis_date >= DATE '{SPLIT_DATE}'")})
SELECT coalesce(s.record_id, t.record_id) AS record_id, t.local_note,
  CASE WHEN s.record_id IS NOT NULL THEN s.volume_vpd ELSE t.volume_vpd END AS volume_vpd,
  CASE WHEN s.record_id IS NOT NULL AND t.record_id IS NOT NULL THEN 'update'
       WHEN s.record_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS op,
  coalesce(t.created_at, TIMESTAMP '{AS_OF}') AS created_at,
  CASE WHEN s.record_id IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE t.updated_at END AS updated_at
FROM t FULL OUTER JOIN s ON t.record_id = s.record_id
""", "devices"))
def q_upsert_merge_wide(spark, sf):
    """A target with a column and audit times of its own: they survive the merge."""
    d = T.devices(spark, sf)
    split = F.lit(SPLIT_DATE).cast("date")
    target = U.latest_per_key(d.filter(F.col("received_analysis_date") < split), "record_id", ORDER).withColumns({
        "local_note": F.concat(F.lit("kept "), "record_id"),
        "created_at": F.lit("2023-05-01 00:00:00").cast("timestamp_ntz"),
        "updated_at": F.lit("2023-06-01 00:00:00").cast("timestamp_ntz")})
    source = d.filter(F.col("received_analysis_date") >= split)
    return U.merge(target, source, "record_id", ORDER, as_of=AS_OF).select(
        "record_id", "local_note", "volume_vpd", "op", "created_at", "updated_at")


_CAMEL = {v: k for k, v in fv.CAMEL_TO_CANONICAL.items()}
_ENV_TS = AS_OF.isoformat()


@register("event_envelope", ("K4", "N8", "F33", "F13"), with_views(f"""
WITH c AS ({_canonical_sql()})
SELECT record_id AS "key", CAST(to_json({{
  'event_id': record_id, 'timestamp': '{_ENV_TS}', 'location': street_name || ' & ' || intersection1,
  'event_type': '{fv.ENVELOPE_EVENT_TYPE}', 'severity': {fv.ENVELOPE_SEVERITY}, 'volume': volume_vpd,
  'speed': average_speed, 'confidence': CAST({fv.ENVELOPE_DEFAULT_CONFIDENCE!r} AS DOUBLE),
  'metadata': {{{", ".join(f"'{_CAMEL[n]}': " + (f"coalesce(CAST({n} AS VARCHAR), '')" if k == "d" else n) for n, k in E.CANONICAL)}}}
}}) AS VARCHAR) AS "value"
FROM c
""", "devices"))
def q_event_envelope(spark, sf):
    c = E.canonicalize(E.raw_inventory(T.devices(spark, sf)))
    return keyed_envelope(N.event_envelope(c, F.lit(_ENV_TS)), "event_id")


@register("envelope_roundtrip", ("K4", "S7", "N7", "R1", "F29"), with_views(f"""
WITH c AS ({_canonical_sql()})
SELECT record_id AS event_id, TIMESTAMP '{AS_OF}' AS ts, street_name || ' & ' || intersection1 AS location,
  CAST(volume_vpd AS DOUBLE) AS volume, average_speed,
  CASE WHEN average_speed < CAST(50.0 AS DOUBLE) * CAST(0.7 AS DOUBLE) THEN 'high'
       WHEN average_speed < CAST(50.0 AS DOUBLE) * CAST(0.9 AS DOUBLE) THEN 'medium' ELSE 'low' END AS congestion_level,
  TIMESTAMP '{AS_OF}' + INTERVAL 5 SECOND AS processed_at
FROM c
""", "devices"))
def q_envelope_roundtrip(spark, sf):
    """The consumer reads every envelope of the producer."""
    from roadlens.streaming import stream as S
    envelopes = q_event_envelope(spark, sf)
    return S.enrich(S.parse_messages(envelopes), F.lit(str(AS_OF + dt.timedelta(seconds=5))).cast("timestamp_ntz"))


# --- nested export (oracle side helpers) -------------------------------------

_CLEAN = sql_lit(X.CLEAN_CLASS)
_EMPTY = "''"          # an empty text in SQL
_HASH = "'#'"


def _s_text(c):
    return f"regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), {_CLEAN}, '', 'g')"


def _s_nonempty(c):
    return f"coalesce(length({c}) > 0, false)"


def _s_date_or(c, other):
    d = sql_date(c)
    return f"(CASE WHEN {c} IS NULL THEN '' WHEN {d} IS NOT NULL THEN CAST({d} AS VARCHAR) ELSE {other} END)"


def _s_device_items():
    keys = [X.device_type_key(k) for _, k in fv.LEGACY_DEVICE_FIELDS]
    items = ", ".join(f"{{'type': '{k}', 'value': CAST(coalesce({c}, 0) AS BIGINT)}}"
                      for k, c in zip(keys, N.LEGACY_COUNT_COLS))
    return f"list_filter([{items}], lambda x: x.value > 0)"


def _s_total():
    return f"CAST(coalesce(list_sum(list_transform({_s_device_items()}, lambda x: x.value)), 0) AS BIGINT)"


def _s_report(cols):
    f = [f"'bylawApprovalDate': {_s_date_or('bylaw_approval_date', _EMPTY)}",
         f"'bylawNumber': {_s_text('bylaw_number')}", "'ccReportType': ''", "'councilDeclined': ''"]
    for key, c in zip(fv.REPORT_KEYS, cols):
        plain = f"regexp_replace(replace({c}, {_HASH}, {_EMPTY}), {_CLEAN}, {_EMPTY}, 'g')"
        f.append(f"'{key}': {_s_date_or(c, plain)}")
    return "{" + ", ".join(f) + "}"


def _s_reports():
    anyf = " OR ".join(_s_nonempty(c) for c in N.REPORT1_COLS + N.REPORT2_COLS)
    two = f"[{_s_report(N.REPORT2_COLS)}, {_s_report(N.REPORT1_COLS)}]"
    return f"(CASE WHEN {anyf} THEN {two} ELSE list_filter({two}, lambda x: false) END)"


def _s_removal():
    f = ["'removalLocation': ''", "'removalType': ''"]
    f += [f"'{k}': {_s_date_or(c, f'CAST({c} AS VARCHAR)')}" for c, k in zip(N.REMOVAL_COLS, N.REMOVAL_KEYS)]
    one = "[{" + ", ".join(f) + "}]"
    anyf = " OR ".join(_s_nonempty(c) for c in N.REMOVAL_COLS)
    return f"(CASE WHEN {anyf} THEN {one} ELSE list_filter({one}, lambda x: false) END)"


def _s_maintenance():
    one = ("[{'maintenanceReason': '', 'reinstallationContractNumber': coalesce(reinstallation_contract_num, ''), "
           f"'reinstallationDate': {_s_date_or('reinstallation_date', _EMPTY)}, "
           "'reinstallationLocation': '', 'reinstallationType': ''}]")
    filled = f"{_s_nonempty('reinstallation_contract_num')} OR {_s_nonempty('reinstallation_date')}"
    return f"(CASE WHEN {filled} THEN {one} ELSE list_filter({one}, lambda x: false) END)"


def _s_legacy_data():
    f = [f"'{k}': coalesce(CAST({c} AS VARCHAR), '0')" for (_, k), c in zip(fv.LEGACY_DEVICE_FIELDS, N.LEGACY_COUNT_COLS)]
    # The view's old columns are dates where their name says so; the other texts hold no date.
    f += [f"'oldDB_{n.replace(' ', '')}': {_s_text(f'old_{i}')}" for i, n in enumerate(fv.LEGACY_OLD_FIELDS)]
    return "{" + ", ".join(f) + "}"


def _s_export():
    f = [f"'status': {_s_text('status')}", f"'recordId': {_s_text('record_id')}"]
    for key, c in (("streetName", "street_name"), ("intersection1", "intersection1"), ("intersection2", "intersection2")):
        f.append(f"'{key}': regexp_replace({sql_standardise(c)}, {_CLEAN}, '', 'g')")
    f += [f"'roadType': {_s_text('road_type')}",
          f"'requestedAnalysisInfoDate': {_s_date_or('requested_analysis_date', _EMPTY)}",
          f"'receivedAnalysisInfoDate': {_s_date_or('received_analysis_date', _EMPTY)}",
          f"'streetOperation': {_s_text('street_operation')}",
          f"'volume': {_s_text('volume_vpd')}", f"'postedSpeedLimit': {_s_text('posted_speed_limit')}",
          f"'averageSpeed': {_s_text('average_speed')}", f"'percentileSpeed85': {_s_text('percentile_speed_85')}",
          f"'analysisRecommended': {_s_text('analysis_recommended')}", f"'planNumber': {_s_text('plan_number')}",
          f"'estimatedCost': {_s_text('estimated_cost')}", f"'comments': {_s_text('comments')}",
          "'numSpeedHumps': coalesce(CAST(num_speed_humps AS VARCHAR), '0')",
          "'numSpeedBumps': coalesce(CAST(num_speed_bumps AS VARCHAR), '0')"]
    f += [f"'{k}': ''" for k in fv.EXPORT_BLANK_FIELDS]
    f += [f"'otherDeviceTotal': {_s_total()}", f"'otherDeviceTypes': {_s_device_items()}",
          "'priorityRanking': coalesce(CAST(priority_ranking AS VARCHAR), '')",
          f"'legacy_data': {_s_legacy_data()}", f"'ccReportItems': {_s_reports()}",
          "'initialInstallationDate': coalesce(CAST(signage_installed_date AS VARCHAR), '')",
          "'initialSignageRequestNumber': ''",
          "'initialCompletionDate': coalesce(CAST(TRY_CAST(construction_completion_date AS DATE) AS VARCHAR), '')",
          "'initialInstallationContractNumber': coalesce(installation_contract_num, '')",
          f"'removalItems': {_s_removal()}", f"'maintenanceItems': {_s_maintenance()}"]
    f += [f"'{k}': list_filter([''], lambda x: false)" for k in ("appendItems", "uploadDraftPlan")]
    f += [f"'{k}': ''" for k in ("requestTrackingNumberDescription", "eligibility", "eligibilityReasons", "eligibilityOther")]
    return "{" + ", ".join(f) + "}"


@register("nested_devices", ("N1", "A24", "F16"), with_views(f"""
SELECT {KEY_SQL}, {_s_total()} AS other_device_total,
  CAST(to_json({_s_device_items()}) AS VARCHAR) AS other_device_types
FROM legacy_records
""", "legacy_records"))
def q_nested_devices(spark, sf):
    types, total = N.device_list()
    return T.legacy_records(spark, sf).select(*KEY, total.alias("other_device_total"),
                                              F.to_json(types).alias("other_device_types"))


@register("nested_reports", ("N3", "N4", "N5", "U3", "F12"), with_views(f"""
SELECT {KEY_SQL}, CAST(to_json({_s_reports()}) AS VARCHAR) AS cc_report_items,
  CAST(to_json({_s_removal()}) AS VARCHAR) AS removal_items,
  CAST(to_json({_s_maintenance()}) AS VARCHAR) AS maintenance_items
FROM legacy_records
""", "legacy_records"))
def q_nested_reports(spark, sf):
    return N.stage(T.legacy_records(spark, sf)).select(
        *KEY, F.to_json(N.council_reports()).alias("cc_report_items"),
        F.to_json(N.removal_items()).alias("removal_items"),
        F.to_json(N.maintenance_items()).alias("maintenance_items"))


@register("nested_export", ("N6", "N2", "P13", "P4", "F7", "F11"), with_views(f"""
SELECT {KEY_SQL}, CAST(to_json({_s_export()}) AS VARCHAR) AS json
FROM legacy_records
WHERE coalesce(length(street_name) > 0, false) AND coalesce(length(intersection1) > 0, false)
  AND coalesce(length(intersection2) > 0, false)
""", "legacy_records"))
def q_nested_export(spark, sf):
    return N.export(T.legacy_records(spark, sf), KEY)


# --- attachments ------------------------------------------------------------

@register("attachments_semi", ("J3",), with_views("""
SELECT DISTINCT record_id FROM devices WHERE record_id IN (SELECT record_id FROM attachments)
""", "devices", "attachments"))
def q_attachments_semi(spark, sf):
    return A.records_with_files(T.devices(spark, sf), T.attachments(spark, sf))


@register("attachments_anti", ("J4",), with_views("""
SELECT DISTINCT record_id FROM devices WHERE record_id NOT IN (SELECT record_id FROM attachments)
""", "devices", "attachments"))
def q_attachments_anti(spark, sf):
    return A.records_without_files(T.devices(spark, sf), T.attachments(spark, sf))


@register("suffix_match", ("J5",), with_views("""
SELECT a.record_id, a.file_name, a.doc_id, u.bin_id, u.returned_name
FROM attachments a LEFT JOIN upload_response u
  ON a.record_id = u.record_id AND ends_with(u.returned_name, a.file_name)
""", "attachments", "upload_response"))
def q_suffix_match(spark, sf):
    local = T.attachments(spark, sf).select("record_id", "file_name", "doc_id")
    returned = T.upload_response(spark, sf)
    return A.suffix_matches(local, returned).select("record_id", "file_name", "doc_id", "bin_id", "returned_name")


@register("first_8_files", ("W1",), with_views(f"""
SELECT record_id, file_name, file_rank FROM (
  SELECT record_id, file_name, row_number() OVER (PARTITION BY record_id ORDER BY file_name) AS file_rank
  FROM attachments) x WHERE file_rank <= {fv.MAX_FILES_PER_RECORD}
""", "attachments"))
def q_first_8_files(spark, sf):
    return A.first_files(T.attachments(spark, sf).select("record_id", "file_name"))


def _s_content_type(c):
    ext = f"lower(regexp_extract({c}, '\\.([^.]*)$', 1))"
    whens = " ".join(f"WHEN {ext} = '{k}' THEN '{v}'" for k, v in fv.CONTENT_TYPES.items())
    return f"(CASE {whens} ELSE '{fv.DEFAULT_CONTENT_TYPE}' END)"


@register("files_per_record", ("A25", "F15", "W1"), with_views(f"""
WITH f AS (SELECT record_id, file_name FROM (
  SELECT record_id, file_name, row_number() OVER (PARTITION BY record_id ORDER BY file_name) AS r
  FROM attachments) x WHERE r <= {fv.MAX_FILES_PER_RECORD})
SELECT record_id, count(*) AS n_files,
  CAST(to_json(list({{'filename': file_name, 'contentType': {_s_content_type('file_name')}}} ORDER BY file_name)) AS VARCHAR) AS uploads
FROM f GROUP BY record_id
""", "attachments"))
def q_files_per_record(spark, sf):
    first = A.first_files(T.attachments(spark, sf).select("record_id", "file_name"))
    return A.uploads_per_record(first)


@register("upload_results", ("A25", "J5", "F15"), with_views(f"""
WITH f AS (SELECT record_id, file_name FROM (
  SELECT record_id, file_name, row_number() OVER (PARTITION BY record_id ORDER BY file_name) AS r
  FROM attachments) x WHERE r <= {fv.MAX_FILES_PER_RECORD}),
m AS (SELECT f.record_id, f.file_name,
    coalesce(list({{'bin_id': u.bin_id, 'file_name': u.returned_name}} ORDER BY u.bin_id, u.returned_name)
      FILTER (WHERE u.bin_id IS NOT NULL), list_filter([{{'bin_id': '', 'file_name': ''}}], lambda x: false)) AS bins
  FROM f LEFT JOIN upload_response u ON f.record_id = u.record_id AND ends_with(u.returned_name, f.file_name)
  GROUP BY f.record_id, f.file_name)
SELECT record_id, CAST(to_json(list({{'filename': file_name, 'contentType': {_s_content_type('file_name')}, 'BIN_ID': bins}}
  ORDER BY file_name)) AS VARCHAR) AS uploads
FROM m GROUP BY record_id
""", "attachments", "upload_response"))
def q_upload_results(spark, sf):
    first = A.first_files(T.attachments(spark, sf).select("record_id", "file_name"))
    return A.upload_results(first, T.upload_response(spark, sf))


@register("attachments_expand", ("S9",), with_views("""
SELECT record_id, file_name, CAST(strlen(content) AS BIGINT) AS n_bytes FROM attachments
""", "attachments"))
def q_attachments_expand(spark, sf):
    """A multi-valued column (the files of one document group) back to a row per file."""
    att = T.attachments(spark, sf)
    packed = att.groupBy("record_id", (F.col("doc_id") % 997).alias("part")).agg(
        F.collect_list(F.struct("file_name", F.octet_length("content").cast("bigint").alias("n_bytes"))).alias("attachments"))
    return A.explode_attachments(packed)
