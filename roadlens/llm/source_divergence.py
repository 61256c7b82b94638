"""How the sources of a language differ in their vocabulary, by a minimal acyclic transducer.

1. document frequencies: each task counts, per language, in how many of its
   documents a term stands; sums over tasks keep the terms of at least
   ``MIN_DOCUMENTS`` documents;
2. the kept terms are sorted (a range of languages and terms per task) and cut
   into slices of bounded bytes; each slice becomes a minimal acyclic transducer
   that maps a term to its lexicographic ordinal;
3. whole texts stream through the transducers and are recounted per language,
   source and ordinal.  Transducers go out in rounds of bounded bytes, one pass
   over the texts per round;
4. shares are whole numbers, p = 1 + floor(1e9 (count + 5) / (N + 5 V)), computed
   on decimals.  Pairs of sources are compared in blocks of sources and of
   ordinals; the ordinal breaks ties between terms.

No step holds a language's or a source's rows in one task: counts are summed
with map-side combining, pairs are cut into blocks, and the first terms of a
group are kept per task before they meet.

Defined cases: null texts, languages and sources are empty; a group without
kept terms has its pairs (value 0 if the language keeps no term) and no terms;
a source alone in its language has no pairs; repeated rows count each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm import transducer
from roadlens.llm.common import free_shuffles, ship, stored, tasks_for

MIN_DOCUMENTS = 30
TOP_TERMS = 50
SCALE, ADDED = 1_000_000_000, 5
#: Text bytes that a task looks at together; a longer text is cut between terms.
PIECE_BYTES = 2 << 20
#: Different terms that a task holds before it hands them over.
HELD_TERMS = 500_000
#: Bytes of terms in a transducer, and of the tables of transducers that go out together.
SLICE_BYTES = 256 << 10
ROUND_BYTES = 192 << 20
#: Counters that a task holds before it hands them over.
HELD_COUNTERS = 8_000_000
#: Sources, and ordinals, of a block when pairs are compared.
SOURCE_BLOCK, TERM_BLOCK = 64, 4096

# A term: a run of letters A to Z of either case and characters beyond ASCII.
_IS_TERM = np.zeros(256, bool)
_IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SPACED = bytes(_LOWER[b] if _IS_TERM[b] else 0x20 for b in range(256))


def _inputs(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about PIECE_BYTES, cut between terms."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        end = at + PIECE_BYTES
        while end < len(text) and _IS_TERM[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def document_frequencies(inputs: DataFrame) -> DataFrame:
    """(lang, term, n): in how many documents of the language each term stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}

        def rows():
            for lang, terms in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(terms), np.int64))),
                     pa.array(list(terms), pa.binary()), pa.array(list(terms.values()), pa.int64())], ["lang", "term", "n"])

        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
                counts = held.setdefault(lang, {})
                seen = set()
                for piece in _pieces(value.as_py()):
                    seen.update(piece.translate(_SPACED).split())
                for term in seen:
                    counts[term] = counts.get(term, 0) + 1
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from rows()
                held = {}
        yield from rows()

    parts = inputs.mapInArrow(run, "lang string, term binary, n long")
    return parts.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def build_slices(kept: DataFrame, total: int) -> DataFrame:
    """(lang, first, terms, size, ...): a transducer per slice of the sorted terms of a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms, size = None, [], 0

        def row():
            built = transducer.build(terms)
            return pa.RecordBatch.from_pylist([{"lang": lang, "first": terms[0], "terms": terms, **built}], schema=kind)

        for batch in batches:
            for its, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if terms and (its != lang or size + len(term) > SLICE_BYTES):
                    yield row()
                    terms, size = [], 0
                lang = its
                terms.append(term)
                size += len(term)
        if terms:
            yield row()

    kind = pa.schema([("lang", pa.string()), ("first", pa.binary()), ("terms", pa.list_(pa.binary())), ("arcs", pa.binary()),
                      ("ends", pa.binary()), ("states", pa.int64()), ("width", pa.int64()), ("longest", pa.int64()), ("size", pa.int64())])
    ordered = kept.select("lang", "term").repartitionByRange(tasks_for(total, 20_000), "lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(run, "lang string, first binary, terms array<binary>, arcs binary, ends binary, "
                               "states long, width long, longest long, size long")


def recount(inputs: DataFrame, slices: list[tuple[str, int, dict]]) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of the terms of some slices, given as (lang, first ordinal, transducer)."""
    sent = inputs.sparkSession.sparkContext.broadcast(slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, list] = {}
        for lang, base, built in sent.value:
            by_lang.setdefault(lang, []).append((base, transducer.load(built)))
        held: dict[tuple[str, str, int], np.ndarray] = {}
        counters = 0

        def rows():
            for (lang, source, base), counts in held.items():
                where = np.flatnonzero(counts)
                same = pa.array(np.zeros(len(where), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(same), pa.array([source]).take(same), pa.array(where + base), pa.array(counts[where])],
                    ["lang", "source", "ordinal", "n"])

        def read(lang, names, texts):
            """Counts texts of one language; ``names``: their sources."""
            nonlocal counters
            different = sorted(set(names))
            number = {s: i for i, s in enumerate(different)}
            data = np.frombuffer(b" ".join(texts).translate(_LOWER), np.uint8)
            edges = np.flatnonzero(np.diff(np.r_[False, _IS_TERM[data], False]))
            starts, ends = edges[::2], edges[1::2]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            text_of = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
            group = np.array([number[s] for s in names], np.int64)[text_of]
            for base, machine in by_lang[lang]:
                which, ordinals = machine.ordinals(data, starts, ends)
                if not len(which):
                    continue
                keys = group[which] * machine.size + ordinals
                if len(different) * machine.size <= 4 * PIECE_BYTES:
                    sums = np.bincount(keys, minlength=len(different) * machine.size).reshape(-1, machine.size)
                    some = ((i, slice(None), sums[i]) for i in np.flatnonzero(sums.any(axis=1)))
                else:
                    key, n = np.unique(keys, return_counts=True)
                    cuts = np.flatnonzero(np.diff(key // machine.size)) + 1
                    some = ((k[0] // machine.size, k % machine.size, m)
                            for k, m in zip(np.split(key, cuts), np.split(n, cuts), strict=True))
                for i, at, n in some:
                    counts = held.get((lang, different[i], base))
                    if counts is None:
                        counts = held[lang, different[i], base] = np.zeros(machine.size, np.int64)
                        counters += machine.size
                    counts[at] += n

        waiting: dict[str, tuple[list, list]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, source, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           batch.column(2).cast(pa.binary()), strict=True):
                if lang not in by_lang:
                    continue
                for piece in _pieces(value.as_py()):
                    names, texts = waiting.setdefault(lang, ([], []))
                    names.append(source)
                    texts.append(piece)
                    sizes[lang] = sizes.get(lang, 0) + len(piece)
                    if sizes[lang] >= PIECE_BYTES:
                        read(lang, *waiting.pop(lang))
                        sizes[lang] = 0
                if counters > HELD_COUNTERS:
                    yield from rows()
                    held, counters = {}, 0
        for lang, (names, texts) in waiting.items():
            read(lang, names, texts)
        yield from rows()

    parts = inputs.mapInArrow(run, "lang string, source string, ordinal long, n long")
    return parts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _share(n, total, kept):
    """1 + floor(SCALE (n + 5) / (total + 5 kept)), exact: decimals up to the division."""
    d = "decimal(20,0)"
    whole = (F.lit(SCALE).cast("decimal(10,0)") * (n + ADDED).cast(d))
    return F.lit(1).cast("long") + F.call_function("div", whole, (total + F.lit(ADDED) * kept).cast(d))


def vocabulary_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, vocabulary, counts): groups (lang, source, total, kept) of every occurring group, the sum over its
    counts and the number of kept terms of its language; vocabulary (lang, ordinal, term); counts (lang, source,
    ordinal, n) with n > 0."""
    spark = docs.sparkSession
    ship(spark)
    inputs = _inputs(docs, text_col, lang_col, source_col)
    kept = stored(document_frequencies(inputs).where(F.col("n") >= min_documents), "kept-terms")
    slices = stored(build_slices(kept, kept.count()), "transducers")
    # A slice's first ordinal: the terms of the slices before it.  A row per SLICE_BYTES of terms reaches the driver.
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    slots = slices.select("lang", "first", (F.col("states") * F.col("width") * 8).alias("bytes"),
                          F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    listed = sorted(((r["lang"], bytes(r["first"]), r["base"], r["bytes"]) for r in slots.collect()))
    rounds, room = [], 0
    for lang, first, _, size in listed:
        if size > room or not rounds:
            rounds.append([])
            room = ROUND_BYTES
        rounds[-1].append((lang, first))
        room -= size
    bases = {(lang, first): base for lang, first, base, _ in listed}
    counts = None
    for some in rounds:
        lowest, highest = (F.struct(F.lit(x[0]).alias("lang"), F.lit(bytearray(x[1])).alias("first")) for x in (some[0], some[-1]))
        key = F.struct("lang", "first")
        sent = [(r["lang"], bases[r["lang"], bytes(r["first"])], {n: r[n] for n in ("arcs", "ends", "states", "longest", "size")})
                for r in slices.where((key >= lowest) & (key <= highest)).drop("terms").collect()]       # less than ROUND_BYTES
        part = recount(inputs, sent)
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    counts = stored(counts, "term-counts")
    free_shuffles(spark)
    vocabulary = (slices.select("lang", "first", F.posexplode("terms").alias("k", "term")).join(slots, ["lang", "first"])
                  .select("lang", "term", (F.col("base") + F.col("k")).alias("ordinal")))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (inputs.select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
              .na.fill(0, ["kept", "total"]))
    return groups, vocabulary, counts


def term_divergence(groups: DataFrame, counts: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, ordinal, value, rank): the terms that a group has more of than its language, the first ``top``."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kept").alias("kept"))
    overall = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    overall = overall.join(langs, "lang").select("lang", "ordinal", q.alias("q"))
    p = _share(F.col("n"), F.col("total"), F.col("kept"))
    own = counts.join(groups, ["lang", "source"]).select("lang", "source", "ordinal", p.alias("p"))
    more = own.join(overall, ["lang", "ordinal"]).where("p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    return more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def pair_divergence(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): for each group every other source of its language, all differences summed."""
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = stored(groups.withColumn("i", number).withColumn("p0", F.when(F.col("kept") > 0, _share(
        F.lit(0).cast("long"), F.col("total"), F.when(F.col("kept") > 0, F.col("kept")).otherwise(1))))
        .withColumn("blocks", F.ceil((F.max("i").over(Window.partitionBy("lang")) + 1) / F.lit(SOURCE_BLOCK)).cast("long")), "sources")
    mine = F.floor(F.col("i") / SOURCE_BLOCK).cast("long")

    def dealt(df):
        """A row for every pair of source blocks that has the row's own."""
        return df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
            "lang", F.least(mine, "other").alias("x"), F.greatest(mine, "other").alias("y"), "tb", "i", "o", "p", "width")

    width = F.least(F.lit(TERM_BLOCK).cast("long"), F.col("kept") - F.col("tb") * TERM_BLOCK)
    # Every source stands in every block with the share of a term that it does not have.
    heads = (sources.where("kept > 0").withColumn("tb", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("kept") - 1) / TERM_BLOCK))))
        .withColumns({"o": F.lit(-1).cast("long"), "p": F.col("p0"), "width": width}))
    cells = (counts.join(sources, ["lang", "source"]).withColumn("tb", F.floor(F.col("ordinal") / TERM_BLOCK))
             .withColumns({"o": F.col("ordinal") - F.col("tb") * TERM_BLOCK, "width": width,
                           "p": _share(F.col("n"), F.col("total"), F.col("kept"))}))

    def compare(rows: pa.Table) -> pa.Table:
        i, o, p = (rows[c].to_numpy() for c in ("i", "o", "p"))
        head = o < 0
        ids, at = np.unique(i[head], return_index=True)
        shares = np.repeat(p[head][at][:, None], rows["width"][0].as_py(), axis=1)
        shares[np.searchsorted(ids, i[~head]), o[~head]] = p[~head]
        x, y = rows["x"][0].as_py(), rows["y"][0].as_py()
        a, b, value = [], [], []
        right = np.flatnonzero(ids // SOURCE_BLOCK == y)
        for k in np.flatnonzero(ids // SOURCE_BLOCK == x):
            others = right[ids[right] > ids[k]]
            a.append(np.full(len(others), ids[k]))
            b.append(ids[others])
            value.append(np.abs(shares[others] - shares[k]).sum(axis=1))
        n = sum(map(len, a))
        cat = lambda v: np.concatenate(v) if v else np.zeros(0, np.int64)
        return pa.table({"lang": pa.array([rows["lang"][0].as_py()] * n, pa.string()), "a": cat(a).astype(np.int64),
                         "b": cat(b).astype(np.int64), "value": cat(value).astype(np.int64)})

    sums = (dealt(heads).unionByName(dealt(cells)).groupBy("lang", "x", "y", "tb").applyInArrow(
        compare, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    own = sources.select("lang", "source", F.col("i").alias("a"))
    item = sources.select("lang", F.col("source").alias("item"), F.col("i").alias("b"))
    found = both.join(own, ["lang", "a"]).join(item, ["lang", "b"]).select("lang", "source", "item", "value")
    # A language that keeps no term: its sources do not differ.
    bare = sources.where("kept = 0").select("lang", "source")
    same = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = found.unionByName(same.withColumn("value", F.lit(0).cast("long")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(order))


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, text_col: str = "text",
                      lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part (pair or term), item, value and rank, for every group of language and source."""
    groups, vocabulary, counts = vocabulary_counts(docs, min_documents, text_col, lang_col, source_col)
    groups = stored(groups, "groups")
    terms = term_divergence(groups, counts, top).join(vocabulary, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    pairs = pair_divergence(groups, counts).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)


def op11_query(docs: DataFrame) -> DataFrame:
    return source_divergence(docs)


ORACLE = f"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ts from documents),
t as (select r, lang, source, unnest(ts) as term from d),
k as (select lang, term from t group by lang, term having count(distinct r) >= {MIN_DOCUMENTS}),
v as (select lang, count(*) as v from k group by lang),
c as (select lang, source, term, count(*) as n from t join k using (lang, term) group by lang, source, term),
s as (select lang, source, sum(n) as total from c group by lang, source),
g as (select lang, source, coalesce(total, 0) as total, coalesce(v, 0) as v
      from (select distinct lang, source from d) left join v using (lang) left join s using (lang, source)),
p as (select lang, source, term, coalesce(n, 0) as n,
        1 + ({SCALE}::hugeint * (coalesce(n, 0) + {ADDED})) // (total + {ADDED} * v)::hugeint as p
      from g join k using (lang) left join c using (lang, source, term)),
q as (select lang, term, 1 + ({SCALE}::hugeint * (sum(n) + {ADDED})::hugeint) // (max(nn) + {ADDED} * max(v))::hugeint as q
      from c join (select lang, sum(total) as nn, max(v) as v from g group by lang) using (lang) group by lang, term),
pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
          from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
tm as (select p.lang, p.source, p.term as item, p.p - q.q as value,
         row_number() over (partition by p.lang, p.source order by p.p - q.q desc, p.term) as rank
       from p join q on p.lang = q.lang and p.term = q.term where p.n > 0 and p.p > q.q)
select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value,
  row_number() over (partition by a.lang, a.source order by coalesce(value, 0) desc, b.source)::int as rank
from g a join g b on a.lang = b.lang and a.source <> b.source
  left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
union all
select lang, source, 'term', item, value::bigint, rank::int from tm where rank <= {TOP_TERMS}"""
