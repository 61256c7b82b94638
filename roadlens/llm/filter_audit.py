"""How text filters act together: sorted posting lists of failing documents, merged by galloping.

1. every text is scanned once: which filters it fails, and its digest.  Whether
   a text is that of a smaller id is found by the least id of each digest;
2. rows are numbered in ascending id and cut into ranges of RANGE_ROWS; for each
   part (language) and range, every filter has the sorted list of the numbers
   that fail it, and each label the list of its numbers;
3. per part and range, for every set of filters and every further filter, unions
   and differences are merged by galloping, and only their sizes go on; Spark
   sums them over the ranges.  An order of the filters is a chain of such sets,
   so all orders are read off the sums.

A range is bounded whatever the size of a part or of a class of equal texts.

Defined cases: a null text is empty and a null language the part ''; a row with
a null id is no copy of a smaller id, nor has labels; of rows with one id and
one text none is a copy of the other; a label is 1 for an id if any of its rows
says so; repeated rows count each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import discard, join_by_class, ship, stored, tasks_for

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 100, 80, 10
SIGNS = b"#$%&*|"
LABELS = ("good", "toxic")
#: Rows of a range of numbers: what a merge holds at most.
RANGE_ROWS = 20_000
#: Ranges that a task merges, on average.
RANGES_PER_TASK = 8

_SIGN = re.compile(b"[#$%&*|]")
_UPPER = bytes(range(0x41, 0x5B))
_LATER = bytes(range(0x80, 0xC0))          # UTF-8 bytes that begin no character


def failed(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 0 to 3."""
    words = text.split()
    points = len(text.translate(None, _LATER))
    upper = len(text) - len(text.translate(None, _UPPER))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
            | (100 * upper > MAX_UPPER_PERCENT * points) << 2 | (_SIGN.search(text) is not None) << 3)


# --- galloping merges of sorted lists ---

def gallop(items: list[int], x: int, low: int) -> int:
    """The first place from ``low`` on whose item is not below ``x``: steps double until they pass it, then halve."""
    n, step = len(items), 1
    high = low
    while high < n and items[high] < x:
        low = high + 1
        high += step
        step *= 2
    high = min(high, n)
    while low < high:
        mid = (low + high) // 2
        if items[mid] < x:
            low = mid + 1
        else:
            high = mid
    return low


def union(lists: list[list[int]]) -> list[int]:
    """The sorted union of sorted lists: the list with the least head gives its whole run below the next head."""
    heads = [[x[0], i, 0] for i, x in enumerate(lists) if x]
    out: list[int] = []
    while len(heads) > 1:
        heads.sort()
        _, i, at = heads[0]
        limit = heads[1][0]
        items = lists[i]
        if items[at] == limit:                       # the other one gives it
            end = at + 1
        else:
            end = gallop(items, limit, at + 1)
            out += items[at:end]
        if end < len(items):
            heads[0] = [items[end], i, end]
        else:
            heads.pop(0)
    if heads:
        _, i, at = heads[0]
        out += lists[i][at:]
    return out


def difference(items: list[int], others: list[int]) -> list[int]:
    """The sorted items that are not among the sorted others."""
    out: list[int] = []
    at = k = 0
    while at < len(items):
        k = gallop(others, items[at], k)
        if k == len(others):
            out += items[at:]
            break
        end = gallop(items, others[k], at)           # up to the next of the others: a whole run stays
        out += items[at:end]
        at = end + (end < len(items) and items[end] == others[k])
    return out


def audit_range(postings: dict[str, list[int]], filters: str = FILTERS) -> list[tuple[str, str, int, int, int]]:
    """For every set of filters and every filter outside it: what the filter removes after the set, and how much of
    it each label has."""
    out = []
    for size in range(len(filters)):
        for before in combinations(filters, size):
            gone = union([postings[f] for f in before])
            for f in filters:
                if f not in before:
                    removed = difference(postings[f], gone)
                    marked = [len(removed) - len(difference(removed, postings[label])) for label in LABELS]
                    out.append(("".join(before), f, len(removed), *marked))
    return out


# --- the jobs ---

def flag_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, digest, fails): what every text fails of A to D, and its digest."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v.as_py() or b"" for v in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([failed(t) for t in texts], pa.int32())], ["id", "part", "digest", "fails"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, part string, digest binary, fails int")


def _with_copies(rows: DataFrame, total: int) -> DataFrame:
    """The rows with bit 4 set if a smaller id has the same text."""
    classes = (rows.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    joined = join_by_class(rows, classes, "digest", "n", total, "left")
    copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return joined.select("id", "part", F.col("fails").bitwiseOR(F.when(copy, 1 << 4).otherwise(0)).alias("fails"))


def posting_lists(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(numbers, postings): numbers (row, id, part) of every row; postings (part, range, name, rows, n): per part and range
    of row numbers, the sorted rows that fail each filter (name: its letter) or have a label, and under the name ''
    all of the part's rows of the range (a count only).

    Row numbers ascend with the id inside a partition, and partitions are id ranges, so a list is sorted by id."""
    flags = stored(flag_rows(docs, id_col, text_col, part_col), "flags")
    total = flags.count()
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    flagged = _with_copies(flags, total).join(marks, F.col("id") == marks["doc_id"], "left").drop("doc_id")
    # An id on any share of the rows: the rows of one id are dealt by a second key.
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    ordered = (flagged.withColumn("_s", spread).repartitionByRange(tasks_for(total, 100_000), "id", "_s")
               .sortWithinPartitions("id", "_s"))
    names = [*FILTERS, *LABELS]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([rows, *batch.columns], ["row", "id", "part", "fails", *LABELS])

    kind = flagged.schema["id"].dataType.simpleString()
    numbers = stored(ordered.select("id", "part", "fails", *LABELS).mapInArrow(
        number, f"row long, id {kind}, part string, fails int, good int, toxic int"), "numbers")
    cut = (1 << 40) // RANGE_ROWS * RANGE_ROWS      # ranges never reach over a partition's numbers

    def lists(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        row, fails = rows["row"].to_numpy(), rows["fails"].to_numpy()
        marked = [rows[c].to_numpy(zero_copy_only=False) == 1 for c in LABELS]
        found = [row[(fails >> i & 1) == 1] for i in range(len(FILTERS))] + [row[m] for m in marked]
        return pa.table({
            "part": pa.array([rows["part"][0].as_py()] * (len(names) + 1), pa.string()),
            "range": pa.array([rows["range"][0].as_py()] * (len(names) + 1), pa.int64()),
            "name": pa.array([*names, ""]), "rows": pa.array([*found, None], pa.list_(pa.int64())),
            "n": pa.array([*map(len, found), len(row)], pa.int64())})

    place = F.col("row").bitwiseAND(F.lit((1 << 40) - 1))
    ranged = numbers.withColumn("range", F.shiftright("row", 40) * F.lit(cut // RANGE_ROWS) + F.floor(place / RANGE_ROWS))
    postings = stored(ranged.groupBy("part", "range").applyInArrow(
        lists, "part string, range long, name string, rows array<long>, n long"), "postings")
    discard(flags)
    return numbers.select("row", "id", "part"), postings


def audit_steps(postings: DataFrame) -> DataFrame:
    """(part, before, filter, removed, good_lost, toxic_lost): sums over the ranges, for every set of filters before
    (its letters in order) and every further filter."""
    def merge(rows: pa.Table) -> pa.Table:
        lists = {n: r for n, r in zip(rows["name"].to_pylist(), rows["rows"].to_pylist(), strict=True)}
        out = audit_range(lists)
        cols = list(zip(*out, strict=True))
        return pa.table({"part": pa.array([rows["part"][0].as_py()] * len(out), pa.string()), "before": pa.array(cols[0], pa.string()),
                         "filter": pa.array(cols[1], pa.string()),
                         **{n: pa.array(c, pa.int64()) for n, c in zip(("removed", "good_lost", "toxic_lost"), cols[2:], strict=True)}})

    # The lists are small beside the work on them: tasks by the number of ranges, not by bytes.
    ranges = postings.where("name = ''").count()
    sizes = postings.repartition(max(12, ranges // RANGES_PER_TASK), "part", "range").groupBy("part", "range").applyInArrow(
        merge, "part string, before string, filter string, removed long, good_lost long, toxic_lost long")
    return sizes.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in ("removed", "good_lost", "toxic_lost")])


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    _, postings = posting_lists(docs, labels, id_col, text_col, part_col)
    steps = stored(audit_steps(postings), "steps")
    sizes = postings.where("name = ''").groupBy("part").agg(F.sum("n").alias("rows"))
    orders = spark.createDataFrame(
        [("".join(o), k + 1, f, "".join(sorted(o[:k]))) for o in permutations(FILTERS) for k, f in enumerate(o)],
        "filter_order string, step int, filter string, before string")              # 600 rows
    fails = steps.where("before = ''").select("part", "filter", F.col("removed").alias("fails"))
    alone = steps.where(F.length("before") == len(FILTERS) - 1).select("part", "filter", F.col("removed").alias("unique_fails"))
    all_orders = steps.join(F.broadcast(orders), ["before", "filter"])
    shapley = all_orders.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return (all_orders.join(fails, ["part", "filter"]).join(alone, ["part", "filter"]).join(shapley, ["part", "filter"]).join(sizes, "part")
            .select("part", "filter_order", "step", (F.col("rows") - F.sum("removed").over(so_far)).alias("kept"), "removed",
                    (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"))


def op13_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return filter_audit(docs, labels)


_WORD = r"[^ \t\n\x0B\f\r]+"
_ORDERS = ", ".join(f"('{''.join(o)}')" for o in permutations(FILTERS))

ORACLE = f"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
             regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
m as (select t, min(doc_id) as least from d group by t),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
f as (select part, len(w) < {MIN_WORDS} as a, 100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w) as b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_UPPER_PERCENT} * length(t) as c,
        regexp_matches(t, '[#$%&*|]') as d, coalesce(doc_id > least, false) as e,
        coalesce(good, false) as good, coalesce(toxic, false) as toxic
      from d join m using (t) left join l using (doc_id)),
g as (select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as x, count(*) as n,
        count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by all),
o as (select * from (values {_ORDERS}) as v(filter_order)),
s as (select filter_order, unnest([1, 2, 3, 4, 5]) as step from o),
b as (select filter_order, step::int as step, 1 << (ascii(substr(filter_order, step, 1)) - 65) as k from s),
r as (select *, coalesce(sum(k) over (partition by filter_order order by step rows between unbounded preceding and 1 preceding), 0)::int as gone from b),
z as (select part, filter_order, step, k, sum(n) filter (x & (k | gone) = 0) as kept,
        sum(n) filter (x & k > 0 and x & gone = 0) as removed, sum(n) filter (x & k > 0 and x & gone > 0) as redundant,
        sum(n) filter (x = k) as unique_fails, sum(good) filter (x & k > 0 and x & gone = 0) as good_lost,
        sum(toxic) filter (x & k > 0 and x & gone = 0) as toxic_lost
      from r, g group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  (sum(coalesce(removed, 0)) over (partition by part, k))::bigint as shapley from z"""
