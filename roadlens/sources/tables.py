"""Driver tables and the views derived from them.

The oracle only knows the driver's tables, so the device inventory, the
event stream and the wide legacy record are derived by SQL that Spark and
DuckDB both accept.  The very same text runs on both sides: Spark binds the
``{lineitem}``-style placeholders to DataFrames, the oracle to table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens import fixed_values as fv

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


#: Tables up to this size are dealt to all cores; larger ones have splits enough.
SPREAD_BYTES = 256 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table to at least one partition per core.

    A file written as a single row group is read by one task however many
    splits it has, and every row-local step after it inherits that task.  Only
    tables up to SPREAD_BYTES are dealt anew; a larger one is read as it lies
    and costs no shuffle, whatever the number of cores."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    target = df.sparkSession.sparkContext.defaultParallelism
    if int(str(size)) <= SPREAD_BYTES and df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


# Device inventory: one row per lineitem, shaped like the canonical record.
DEVICES_SQL = """
select
  chr(64 + l_linenumber) || '-' || lpad(cast(l_orderkey % 1000 as varchar(20)), 3, '0') as record_id,
  p_name || case p_size % 6 when 0 then ' st' when 1 then ' Ave.' when 2 then ' blvd w' when 3 then ' Road' when 4 then ' cres' else '' end as street_name,
  case when l_orderkey % 53 = 0 then '' else p_brand || ' Ave' end as intersection1,
  p_type || ' St' as intersection2,
  case l_partkey % 4 when 0 then 'Residential' when 1 then 'Collector' when 2 then 'Arterial' else 'Highway' end as road_type,
  case o_orderstatus when 'F' then 'Completed' when 'P' then 'Pending' else 'Active' end as status,
  cast(o_orderdate as date) as requested_analysis_date,
  cast(l_shipdate as date) as received_analysis_date,
  case when l_linestatus = 'O' then 'One-way' else 'Two-way' end as street_operation,
  case when l_orderkey % 97 = 0 then null else cast(floor(l_extendedprice * l_extendedprice / 1000000) as bigint) end as volume_vpd,
  30 + 10 * (l_suppkey % 5) as posted_speed_limit,
  case when l_orderkey % 89 = 0 then null else (30 + 10 * (l_suppkey % 5)) * (60 + 6 * cast(round(l_discount * 100) as int) + cast(round(l_tax * 100) as int)) / 100 end as average_speed,
  (30 + 10 * (l_suppkey % 5)) * (60 + 6 * cast(round(l_discount * 100) as int) + cast(round(l_tax * 100) as int)) * (190 + cast(l_quantity as int)) / 20000 as percentile_speed_85,
  case when l_returnflag = 'R' then cast(0 as double) else l_extendedprice end as estimated_cost,
  case when l_linenumber = 1 then null else o_orderpriority end as comments,
  l_linenumber % 3 as num_speed_humps,
  l_partkey % 2 as num_speed_bumps,
  l_linenumber as priority_ranking,
  l_orderkey as src_orderkey, l_partkey as src_partkey, l_suppkey as src_suppkey, l_extendedprice as src_price
from {lineitem} join {part} on l_partkey = p_partkey join {orders} on l_orderkey = o_orderkey
"""

# Event stream: keyed by location, with the speed fields the consumer reads.
TRAFFIC_EVENTS_SQL = """
select event_id, ts, 'loc-' || cast(user_id as varchar(20)) as location, event_type,
  cast(floor(value * 10) as bigint) as volume,
  case when event_id % 41 = 0 then null else value end as average_speed,
  case when user_id % 5 = 0 then null else 30 + 10 * (user_id % 5) end as speed_limit,
  props
from {events}
"""

# Wide legacy record (the nested export's input): device counts, council
# report, removal and maintenance fields derived from the device inventory.
LEGACY_SQL = """
select record_id, status, street_name, intersection1, intersection2, road_type,
  requested_analysis_date, received_analysis_date, volume_vpd, posted_speed_limit,
  num_speed_humps, num_speed_bumps, priority_ranking,
  src_orderkey, src_partkey, src_suppkey, src_price,
  cast(src_orderkey % 3 as bigint) as chicanes,
  cast(src_partkey % 2 as bigint) as gateways,
  cast(src_suppkey % 4 as bigint) - 1 as intersection_narrowings,
  cast((src_orderkey + src_partkey) % 3 as bigint) as midblock_pinch_points,
  cast(priority_ranking % 2 as bigint) as raised_center_medians,
  cast(src_orderkey % 5 as bigint) - 2 as raised_crosswalks,
  cast(src_suppkey % 2 as bigint) as raised_intersections,
  case when src_orderkey % 7 = 0 then null else cast(src_partkey % 3 as bigint) end as traffic_circles,
  case when src_orderkey % 4 = 0 then 'CC' || cast(src_orderkey % 100 as varchar(20)) || '.' || cast(priority_ranking as varchar(20)) else null end as clause_number1,
  case when src_orderkey % 4 = 0 then status else '' end as council_approval1,
  case when src_orderkey % 4 = 0 and src_partkey % 2 = 0 then 'Yes' else null end as recommendation_amended1,
  case when src_orderkey % 4 = 0 then cast(requested_analysis_date as varchar(20)) else null end as report_date1,
  case when src_orderkey % 4 = 0 then 'http://reports/' || record_id || '/1' else null end as report_link1,
  case when src_orderkey % 6 = 0 then 'CC' || cast(src_partkey % 100 as varchar(20)) else null end as clause_number2,
  case when src_orderkey % 6 = 0 then 'Approved' else null end as final_approval,
  case when src_orderkey % 6 = 0 then 'No' else null end as recommendation_amended2,
  case when src_orderkey % 6 = 0 then cast(received_analysis_date as varchar(20)) else null end as report_date2,
  case when src_orderkey % 6 = 0 then 'http://reports/' || record_id || '/2' else null end as report_link2,
  case when src_orderkey % 4 = 0 then cast(received_analysis_date as varchar(20)) else null end as bylaw_approval_date,
  case when src_orderkey % 4 = 0 then 'BL-' || cast(src_orderkey as varchar(20)) else null end as bylaw_number,
  case when src_partkey % 9 = 0 then 'RC-' || cast(src_partkey as varchar(20)) else null end as removal_contract_num,
  case when src_partkey % 9 = 0 then cast(received_analysis_date as varchar(20)) else null end as removal_date,
  case when src_partkey % 9 = 0 then 'Resident request' else null end as removal_reason,
  case when src_partkey % 9 = 0 then 'Yes' else null end as removed,
  case when src_suppkey % 11 = 0 then 'Worn' else null end as maintenance_reason,
  case when src_suppkey % 11 = 0 then 'MC-' || cast(src_suppkey as varchar(20)) else null end as reinstallation_contract_num,
  case when src_suppkey % 11 = 0 then cast(requested_analysis_date as varchar(20)) else null end as reinstallation_date,
  street_operation, average_speed, percentile_speed_85, estimated_cost,
  case when src_orderkey % 3 = 0 then null else 'Staff ' || cast(src_suppkey % 10 as varchar(20)) end as analysis_recommended,
  case when src_partkey % 8 = 0 then null else 'PD-' || cast(src_partkey as varchar(20)) end as plan_number,
  case when src_orderkey % 5 = 0 then received_analysis_date else null end as signage_installed_date,
  case when src_orderkey % 10 = 0 then cast(requested_analysis_date as varchar(20)) when src_orderkey % 10 = 5 then 'soon' else null end as construction_completion_date,
  case when src_suppkey % 7 = 0 then 'IC-' || cast(src_suppkey as varchar(20)) else null end as installation_contract_num,
  {old_fields},
  comments
from {devices}
"""


def _old_field(i: int, name: str) -> str:
    """An old database column: a date where its name says so, else text (with a tab now and then) or a number."""
    if "Date" in name:
        return f"case when src_orderkey % {3 + i % 5} = 0 then received_analysis_date else null end as old_{i}"
    if "Number" in name:
        return f"cast((src_suppkey + {i}) % 100 as bigint) as old_{i}"
    return (f"case when src_partkey % {4 + i % 7} = 0 then null when src_orderkey % 11 = 0 then 'v' || chr(9) || '{i}' "
            f"else 'v' || cast((src_suppkey + {i}) % 100 as varchar(20)) end as old_{i}")


LEGACY_SQL = LEGACY_SQL.replace("{old_fields}", ",\n  ".join(_old_field(i, n) for i, n in enumerate(fv.LEGACY_OLD_FIELDS)))

# Attachments: each document is a file of one of 30 device records (so that
# records hold many files); the source is the folder, the extension follows
# doc_id % 4, and names like 12.pdf / 312.pdf share a suffix within a record.
ATTACHMENTS_SQL = """
select chr(65 + cast(doc_id % 3 as int)) || '-' || lpad(cast(doc_id % 10 as varchar(20)), 3, '0') as record_id,
  source as folder,
  cast(doc_id as varchar(20)) || case doc_id % 4 when 0 then '.pdf' when 1 then '.PNG' when 2 then '.jpeg' else '.txt' end as file_name,
  doc_id, text as content
from {documents}
"""

# Names returned by the upload service: a bin id and a prefixed file name,
# for all but every fifth file.
UPLOAD_RESPONSE_SQL = """
select record_id, 'BIN-' || cast(doc_id as varchar(20)) as bin_id,
  'uploads/' || folder || '/' || file_name as returned_name
from {attachments}
where doc_id % 5 <> 0
"""

# Reference street names: the distinct part names as streets.
STREET_REFS_SQL = """
select distinct p_name || ' Street' as ref_name from {part}
"""


def _bind(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(sql, **frames)


def oracle_text(sql: str, **names: str) -> str:
    """The fixture SQL with placeholders bound to table or CTE names."""
    return sql.format(**names)


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, DEVICES_SQL,
                 lineitem=read_table(spark, sf_dir, "lineitem"),
                 part=read_table(spark, sf_dir, "part"),
                 orders=read_table(spark, sf_dir, "orders"))


def traffic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, TRAFFIC_EVENTS_SQL, events=read_table(spark, sf_dir, "events"))


def legacy_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, LEGACY_SQL, devices=devices(spark, sf_dir))


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, ATTACHMENTS_SQL, documents=read_table(spark, sf_dir, "documents"))


def upload_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, UPLOAD_RESPONSE_SQL, attachments=attachments(spark, sf_dir))


def street_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bind(spark, STREET_REFS_SQL, part=read_table(spark, sf_dir, "part"))
