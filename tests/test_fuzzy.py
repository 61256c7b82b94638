"""Fuzzy matching: difflib ratios, and the Spark plan equals a brute-force scan."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from roadlens.operators import fuzzy as Z


def expected(name, refs, threshold=0.7, lower=True):
    """From the specification: score every reference, take the greatest ratio and of those the earliest
    reference, and keep the name if that ratio is below the threshold."""
    if not name:
        return name
    same = str.lower if lower else str
    ratios = [SequenceMatcher(None, same(name), same(r)).ratio() for r in refs]
    top = max(ratios, default=0)
    return refs[ratios.index(top)] if ratios and top >= threshold else name


def test_ratio_cases():
    r = lambda a, b: round(SequenceMatcher(None, a, b).ratio(), 4)
    assert r("main st", "main street") == 0.7778
    assert r("oak ave", "oak avenue") == 0.8235
    assert r("first ave", "second ave") == 0.5263
    assert r("tide", "diet") == 0.25 and r("diet", "tide") == 0.5


def _refs_df(spark, refs):
    return spark.createDataFrame([(r, i) for i, r in enumerate(refs)], "ref_name string, ref_pos int")


def test_against_brute_force(spark):
    rng = random.Random(7)
    words = ["main", "oak", "pine", "elm", "cedar", "queen", "king", "first", "second", "park"]
    sufs = ["st", "street", "ave", "avenue", "rd", "road", "blvd", "Street", "AVE", ""]
    refs = sorted({f"{rng.choice(words)} {rng.choice(sufs)}".strip() for _ in range(40)})
    names = [f"{rng.choice(words)}{rng.choice([' ', '  ', ''])}{rng.choice(sufs)}" for _ in range(120)]
    names += ["", "x", "MAIN STREET", "queen st."]
    got = {r.name: r.matched for r in Z.best_matches(
        spark.createDataFrame([(n,) for n in names], "name string"), _refs_df(spark, refs)).collect()}
    for n in set(names):
        assert got[n] == expected(n, refs), n


def test_case_sensitive_and_ties(spark):
    refs = ["Main Street", "main street", "Main Streets"]
    names = spark.createDataFrame([("Main Stret",), ("main stret",)], "name string")
    ci = {r.name: r.matched for r in Z.best_matches(names, _refs_df(spark, refs)).collect()}
    cs = {r.name: r.matched for r in Z.best_matches(names, _refs_df(spark, refs), lower=False).collect()}
    for n in ("Main Stret", "main stret"):
        assert ci[n] == expected(n, refs, lower=True)
        assert cs[n] == expected(n, refs, lower=False)
    assert ci["main stret"] == "Main Street"   # tie after lower-casing: earliest reference wins


def test_apply_matches(spark):
    refs = _refs_df(spark, ["Main Street", "Oak Avenue"])
    df = spark.createDataFrame([("1", "main st", "oak ave", ""), ("2", "zzz", "Main Street", "x")],
                               "id string, a string, b string, c string")
    out = {r.id: (r.a, r.b, r.c) for r in Z.apply_matches(df, ["a", "b", "c"], refs).collect()}
    assert out["1"] == ("Main Street", "Oak Avenue", "")
    assert out["2"] == ("zzz", "Main Street", "x")


def test_positional(spark, tmp_dir):
    from roadlens.sources.files import read_positional_lines
    good = f"{tmp_dir}/good.txt"
    bad = f"{tmp_dir}/bad.txt"
    open(good, "w").write("Main Street\nOak Avenue\n\nPine Road\n")
    open(bad, "w").write("Main Stret\n\nqqqq\nOak Avenu\n")
    b = read_positional_lines(spark, bad)
    g = read_positional_lines(spark, good)
    rows = Z.positional_replace(b, g).collect()
    assert [r.row_id for r in rows] == [371, 372, 373, 374]
    assert [r.output for r in rows] == ["Main Street", "N/A", "qqqq", "Oak Avenue"]
    _ = F


def test_prefix_filter_stress(spark):
    """Small alphabet, many near-threshold pairs: the filtered plan still equals brute force."""
    rng = random.Random(11)
    alpha = "abcde "
    refs = sorted({"".join(rng.choice(alpha) for _ in range(rng.randint(3, 12))) for _ in range(60)})
    names = ["".join(rng.choice(alpha) for _ in range(rng.randint(1, 14))) for _ in range(150)]
    refs, names = refs + ["é日本😀", "a", "😀😀😀b", "aaaaaaaaaaaa"], names + ["é日本", "A", "😀😀b", "aaaaaaaa", "😀"]
    got = {r.name: r.matched for r in Z.best_matches(
        spark.createDataFrame([(n,) for n in names], "name string"), _refs_df(spark, refs)).collect()}
    for n in set(names):
        assert got[n] == expected(n, refs), n


def test_fixture_names_against_brute_force(spark):
    from roadlens.plans.fuzzy_queries import _refs
    from roadlens.sources import tables as T
    sf = "/root/testdata/sf0.001"
    refs = [r.ref_name for r in _refs(spark, sf).orderBy("ref_pos").collect()]
    got = {r.name: r.matched for r in
           Z.best_matches(T.devices(spark, sf).select(F.col("street_name").alias("name")), _refs(spark, sf)).collect()}
    for n, m in got.items():
        assert m == expected(n, refs), n


def test_few_rows_are_joined(spark):
    """The rows that the join gives are the pairs of a full scan that can reach the threshold, each once: less than a
    tenth of names times references."""
    from collections import Counter

    from roadlens.plans.fuzzy_queries import _refs
    from roadlens.sources import tables as T
    sf = "/root/testdata/sf0.01"
    names = T.devices(spark, sf).select(F.lower("street_name").alias("a")).filter("a <> ''").distinct()
    refs = _refs(spark, sf).select(F.lower("ref_name").alias("b")).distinct()
    n, r = [x.a for x in names.collect()], [x.b for x in refs.collect()]
    joined = [(x.a, x.b) for x in Z.candidate_pairs(names, refs, 0.7).collect()]
    assert len(joined) <= 0.1 * len(n) * len(r)
    overlap = lambda a, b: sum((Counter(a) & Counter(b)).values())
    assert sorted(joined) == sorted((a, b) for a in n for b in r if 2 * overlap(a, b) >= 0.7 * (len(a) + len(b)) - 1e-9)


def test_names_of_all_columns_in_one_pass(spark, monkeypatch):
    """What is behind the rows is planned once for the names, however many columns are matched."""
    seen = []
    best = Z.best_matches

    def spy(names, *args, **kw):
        seen.append(names)
        return best(names, *args, **kw)
    monkeypatch.setattr(Z, "best_matches", spy)
    rows = spark.range(4).selectExpr("id", "'main st' AS a", "CASE WHEN id = 1 THEN NULL ELSE 'oak st' END AS b", "'' AS c")
    refs = spark.createDataFrame([("Main St", 0), ("Oak St", 1)], "ref_name string, ref_pos int")
    out = Z.apply_matches(rows, ["a", "b", "c"], refs)
    assert sorted((r.id, r.a, r.b, r.c) for r in out.collect()) == [
        (0, "Main St", "Oak St", ""), (1, "Main St", None, ""), (2, "Main St", "Oak St", ""), (3, "Main St", "Oak St", "")]
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 4") == 1
