"""Quality rules by distribution divergence.

Each text gives two histograms: characters by class, and common function
words, with all other words as one more bin.  A language's reference is the sum of the histograms of its documents
that pass the base rules.  A text is kept if it passes the base rules and if,
for both histograms, its Jensen-Shannon distance to the closest reference is
within a limit.  A histogram of too little material is not judged (the guard).

Everything is built from DataFrame functions; the references are a handful of
rows, one per language, whatever the size of the corpus.

Defined cases: a null text is an empty one and fails the base rules; an empty
table gives an empty result; without any reference (no document passes) only
the base rules judge; repeated rows are judged alike; columns other than the
id, text and language are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import SPACE, WORD, let, stored

# Frequent function words of the four languages.
COMMON_WORDS = (
    "the of and to in is that it for was on with as be by this are at from "
    "der die und den von zu das mit sich des auf ist nicht dem "
    "de la le et les en un du une que pour est par qui dans "
    "el y los se del las con por no su para es"
).split()

LANGUAGES = ("en", "de", "fr", "es")

# The character classes, each removed from what the ones before have left.
CLASSES = (("lower", "[a-z]+"), ("space", f"{SPACE}+"), ("upper", "[A-Z]+"), ("beyond_ascii", r"[^\x00-\x7F]+"),
           ("stops", "[.,;:?'\"-]+"), ("digits", "[0-9]+"))
CLASS_COUNT = len(CLASSES) + 1                       # and the rest

#: Distances (0 to 1) up to which a text is kept.
MAX_CLASS_DISTANCE = 0.3
#: A text without any common word is at 0.36 from its language, as a quarter of the words are missing.
MAX_WORD_DISTANCE = 0.34
#: A histogram is judged from so many characters, and so many words, on.
MIN_CHARS = 200
MIN_JUDGED_WORDS = 50
#: Base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _class_counts(text: Column) -> Column:
    """array<long>: characters per class.  Each class is taken out of the rest, so that the rest shrinks."""
    def step(rest, classes, counts):
        if not classes:
            return F.array(*counts, F.length(rest).cast("long"))
        return let(F.regexp_replace(rest, classes[0][1], ""), lambda left: step(
            left, classes[1:], [*counts, (F.length(rest) - F.length(left)).cast("long")]))
    return step(text, CLASSES, [])


def _common_counts(words: Column) -> Column:
    """array<long>: occurrences of each common word, lower-cased and without a stop at its end."""
    plain = F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))
    listed = F.filter(plain, lambda w: w.isin(COMMON_WORDS))
    # Each word between spaces of its own, so that neighbours share none.
    line = F.concat(F.lit(" "), F.array_join(listed, "  "), F.lit(" "))
    return let(line, lambda s: F.array(*[
        ((F.length(s) - F.length(F.replace(s, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long")
        for w in COMMON_WORDS]))


def _repeat_words(words: Column) -> Column:
    """Words inside a window of three that occurs at least twice.

    The windows' 64-bit hashes are sorted with their places; equal neighbours
    are repeats.  Each repeated place covers three words, less what the next
    one covers too.
    """
    def covered(places):
        return F.aggregate(
            F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(windows):
        def same(w, k):
            return F.coalesce(F.get(windows, k - 1)["h"] == w["h"], F.lit(False)) | \
                F.coalesce(F.get(windows, k + 1)["h"] == w["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(windows, same), lambda w: w["p"]))

    windows = F.transform(
        F.slice(words, 3, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, p: F.struct(F.xxhash64(F.get(words, p), F.get(words, p + 1), w).alias("h"), p.alias("p")))
    return let(F.sort_array(windows), lambda s: let(repeated(s), covered))


def measures(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the kept columns in a struct, language, the base counts and the two histograms."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def of(t):
        return let(F.regexp_extract_all(t, F.lit(f"({WORD})"), F.lit(1)), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            _repeat_words(w).alias("n_repeat_words"),
            _class_counts(t).alias("classes"),
            _common_counts(w).alias("common")))

    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept_row"), F.col(lang_col).alias("lang"), let(text, of).alias("m"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("kept_row", "lang", "m.*", "n_dup_lines").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Per language, the shares of each class and of each common word (and of all others together) over its documents that pass the base rules."""
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(CLASS_COUNT)]
    sums += [F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(len(COMMON_WORDS))]
    rows = (measured.where(~F.col("base_failed") & F.col("lang").isin(*LANGUAGES))
            .groupBy("lang").agg(*sums, F.sum("n_words").alias("words")).collect())                       # a row per language
    out = {}
    for r in sorted(rows, key=lambda r: r["lang"]):
        classes = [r[f"c{i}"] for i in range(CLASS_COUNT)]
        common = [r[f"w{i}"] for i in range(len(COMMON_WORDS))]
        if sum(classes) and sum(common):
            words = [*common, r["words"] - sum(common)]          # the last bin: words that are not common
            out[r["lang"]] = ([x / sum(classes) for x in classes], [x / r["words"] for x in words])
    return out


def js_distance(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram to a reference distribution.

    With m the mean of p and q, the divergence is the mean of p*log2(p/m) and
    q*log2(q/m) summed over the bins; the distance is its root.
    """
    def distance(n):
        def term(x, q):
            p = x / n
            m = (p + q) / 2
            return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

        terms = F.zip_with(counts, F.array(*[F.lit(float(q)) for q in reference]), term)
        return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) / 2, F.lit(0.0)))

    # Bound, or the optimizer would put the sum's expression into every term.
    return let(total, distance)


def _closest(counts: str, size: str, references: list[list[float]]) -> Column:
    """The least distance over the references; null without any."""
    if not references:
        return F.lit(None).cast("double")
    ds = [js_distance(F.col(counts), F.col(size).cast("double"), r) for r in references]
    return F.least(*ds) if len(ds) > 1 else ds[0]


def judge(measured: DataFrame, refs: dict) -> DataFrame:
    """Adds class_distance, word_distance (null where the guard leaves them out) and kept."""
    def total(c):
        return F.aggregate(F.col(c), F.lit(0).cast("long"), lambda a, x: a + x)

    out = measured.withColumns({"n_chars_judged": total("classes"), "n_common": total("common")})
    out = out.withColumn("words", F.concat("common", F.array(F.col("n_words") - F.col("n_common"))))
    out = out.withColumns({
        "class_distance": F.when(F.col("n_chars_judged") >= MIN_CHARS,
                                 _closest("classes", "n_chars_judged", [r[0] for r in refs.values()])),
        "word_distance": F.when(F.col("n_words") >= MIN_JUDGED_WORDS,
                                _closest("words", "n_words", [r[1] for r in refs.values()]))})
    return out.withColumn("kept", ~F.col("base_failed")
                          & (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= MAX_CLASS_DISTANCE)
                          & (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= MAX_WORD_DISTANCE))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: its kept columns (in the struct kept_row), measures, distances and the verdict.

    The measures are written once to the shared folder: the references and the
    verdicts both read them, and texts are scanned once.
    """
    measured = stored(measures(docs, text_col, lang_col, keep), "quality")
    return judge(measured, references(measured))


def passing(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    return quality_rules(docs, text_col, lang_col, tuple(docs.columns)).where("kept").select("kept_row.*")


def op1_query(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).select(
        "kept_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    """The same in DuckDB's SQL, over unnested words and windows instead of arrays."""
    blank = r"[ \t\n\x0B\f\r]"
    word = r"[^ \t\n\x0B\f\r]+"
    classes, rest = [], "t"
    for name, pattern in CLASSES:
        left = f"regexp_replace({rest}, '{pattern.replace(SPACE, blank).replace(chr(39), chr(39) * 2)}', '', 'g')"
        classes.append((name, f"length({rest}) - length({left})"))
        rest = left
    class_cols = [n for n, _ in classes] + ["others"]
    class_sql = ", ".join(f"{e} as {n}" for n, e in classes) + f", length({rest}) as others"
    common_sql = ", ".join(f"count(*) filter (p = '{w}') as k{i}" for i, w in enumerate(COMMON_WORDS))
    word_cols = [f"k{i}" for i in range(len(COMMON_WORDS))]

    def distance(cols, ref):
        total = " + ".join(f"f.{c}" for c in cols)
        of = " + ".join(f"{ref}.{c}" for c in cols)
        terms = []
        for c in cols:
            p, q = f"(f.{c} / ({total})::double)", f"({ref}.{c} / ({of})::double)"
            terms.append(f"case when f.{c} > 0 then {p} * log2({p} / (({p} + {q}) / 2)) else 0 end")
            terms.append(f"case when {ref}.{c} > 0 then {q} * log2({q} / (({p} + {q}) / 2)) else 0 end")
        return f"sqrt(greatest(({' + '.join(terms)}) / 2, 0))"

    chars = " + ".join(f"f.{c}" for c in class_cols)
    commons = " + ".join(word_cols)
    return f"""
with d as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as t from documents),
w as (select r, unnest(l) as w, generate_subscripts(l, 1) as i
      from (select r, regexp_extract_all(t, '{word}') as l from d)),
win as (select r, i, w || ' ' || lead(w) over o || ' ' || lead(w, 2) over o as g
        from w window o as (partition by r order by i)),
rep as (select r, i from (select r, i, count(*) over (partition by r, g) as c from win where g is not null) where c > 1),
cov as (select r, count(distinct i + k) as n_repeat_words from rep, (select unnest([0, 1, 2]) as k) group by r),
per as (select r, count(*) as n_words, sum(length(w)) as word_chars, {common_sql}
        from (select r, w, rtrim(lower(w), '.,;:!?') as p from w) group by r),
lin as (select r, count(*) - count(distinct l) as n_dup_lines
        from (select r, unnest(string_split(t, chr(10))) as l from d) where regexp_matches(l, '{word}') group by r),
f as (select d.r, doc_id, lang, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0)::bigint as word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
        {', '.join(f'coalesce({c}, 0) as {c}' for c in word_cols)}, {class_sql}
      from d left join per using (r) left join lin using (r) left join cov using (r)),
b as (select *, n_words - ({commons}) as k_other, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from f),
ref as (select lang, {', '.join(f'sum({c}) as {c}' for c in class_cols + [*word_cols, 'k_other'])} from b
        where not base_failed and lang in ('en', 'de', 'fr', 'es') group by lang
        having {' + '.join(f'sum({c})' for c in word_cols)} > 0),
near as (select f.r,
           min(case when {chars} >= {MIN_CHARS} then {distance(class_cols, 'ref')} end) as cd,
           min(case when f.n_words >= {MIN_JUDGED_WORDS} then {distance([*word_cols, 'k_other'], 'ref')} end) as wd
         from b as f, ref group by f.r)
select doc_id, n_words, word_chars, n_symbols::bigint as n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(cd, 0) <= {MAX_CLASS_DISTANCE} and coalesce(wd, 0) <= {MAX_WORD_DISTANCE} as kept
from b left join near using (r)"""


ORACLE = _oracle()
