"""Each operator against brute force, on small tables with every awkward row."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash

from roadlens.llm import (decontamination, lm_scoring, packing, quality_rules, sharding, simhash_dedup, suffix_dedup,
                          token_counts, token_files, url_filters)

SF = "/root/testdata/sf0.001"
CLASHING = "id string, fp long, key binary, words string, kept boolean, n int, row long, own int, low int, `_b` int, token string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
EXTRA = ("x", 1, b"k", "w", False, 2, 3, 4, 5, 6, "t")

PROSE = ("The first of the houses was built on a hill, and it is said that the river was then as wide as the valley. "
         "Those who came for the harvest went back in the autumn with bread and salt, by the road that leads to the sea. ")


def _rows():
    rng = random.Random(4)
    words = [w.strip(".,") for w in PROSE.split()]
    texts = [PROSE * 2, PROSE * 2, None, "", " \n\t ", "one", "one two", "One TWO three", "é" * 90, "a b c " * 60,
             "line\nline\n\nline\nother", "日本語 テスト 😀", "<|endoftext|> <s> x", "#$% |<>|", "a  b   c ", " ".join(words * 40),
             "word" * 3000, "▁a ▁▁b", "tab\tand\r\nline", PROSE.upper()]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(40)]
    texts += [texts[-1], texts[-1], PROSE + texts[-2], texts[-3] + " " + PROSE]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, "one two"), (None, None), (3, ""), (7, "One TWO three"), (7, "One TWO three"), (7, "another of id seven")]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *EXTRA) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, want):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == sorted(want, key=str)


def words_of(text):
    return (text or "").encode().lower().split()


def test_quality_base(docs, rows, empty):
    def base(text):
        w = [x.decode() for x in (text or "").encode().split()]
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
                len(w) < 50 or 100 * len(covered) > 50 * len(w))

    out = quality_rules.op1_query(docs)
    same(out.drop("kept"), [(i, *base(t)) for i, t in rows])
    assert out.where("kept and base_failed").count() == 0
    assert quality_rules.op1_query(empty).count() == 0
    assert quality_rules.passing(docs).columns == docs.columns


def test_quality_distances(spark, docs):
    reference = [0.5, 0.25, 0.25, 0.0]
    frame = spark.createDataFrame([([2, 1, 1, 0],), ([0, 0, 0, 7],), ([1, 0, 0, 3],)], "c array<long>")
    from pyspark.sql import functions as F
    total = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x).cast("double")
    got = [r[0] for r in frame.select(quality_rules.js_distance(F.col("c"), total, reference)).collect()]

    def js(p, q):
        kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b, strict=True) if x)
        m = [(x + y) / 2 for x, y in zip(p, q, strict=True)]
        return math.sqrt(max((kl(p, m) + kl(q, m)) / 2, 0))
    want = [js([x / sum(c) for x in c], reference) for c in ([2, 1, 1, 0], [0, 0, 0, 7], [1, 0, 0, 3])]
    assert got == pytest.approx(want) and got[1] == 1.0
    # Prose stays; the same words in capitals, with signs, or without any function word go.
    texts = [PROSE + f"And {w} was the last of it." for w in ("this", "bread", "salt", "wheat")]
    texts += [texts[0].upper(), texts[1].replace(" ", "### "), " ".join(f"bra{chr(97 + i % 26)}{chr(97 + i // 26)}on" for i in range(90))]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    out = quality_rules.quality_rules(frame).collect()
    judged = {r["kept_row"]["doc_id"]: (r["base_failed"], r["kept"]) for r in out}
    assert [judged[i] for i in range(6)] == [(False, True)] * 4 + [(False, False)] * 2
    # Words that are not common are a bin of their own, so a text without function words is judged too.
    assert all(r["class_distance"] is not None and r["word_distance"] is not None for r in out)
    # It goes for that alone if its characters are those of prose.  The guard: few words are judged by the base rules only.
    names = [f"bra{chr(97 + i % 26)}{chr(97 + i // 26)}on" for i in range(90)]
    lines = ". ".join(" ".join(names[i:i + 15]).capitalize() for i in range(0, 90, 15)) + "."
    more = spark.createDataFrame([(8, lines, "en"), (9, "bread and salt", "en")], "doc_id long, text string, lang string")
    out = {r["kept_row"]["doc_id"]: r for r in quality_rules.quality_rules(frame.union(more)).collect()}
    assert (out[8]["base_failed"], out[8]["kept"]) == (False, False)
    assert out[8]["class_distance"] <= quality_rules.MAX_CLASS_DISTANCE
    assert out[8]["word_distance"] > quality_rules.MAX_WORD_DISTANCE
    assert out[9]["word_distance"] is None and all(out[i]["kept"] for i in range(4))


def test_lm_scores(docs, rows, empty):
    texts = [(i, words_of(t) + [b""], zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0) for i, t in rows]
    c, pairs = collections.Counter(), collections.Counter()
    for _, w, held in texts:
        if not held:
            c.update(w)
            pairs.update(zip([b""] + w[:-1], w))
    n, v, k = sum(c.values()), len(c), lm_scoring.PRIOR
    p = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    want = [(i, held, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(p(x)) for x in w),
             sum(math.log10((pairs[h, x] + k * p(x)) / (c[h] + k)) for h, x in zip([b""] + w[:-1], w))) for i, w, held in texts]
    got = [tuple(r) for r in lm_scoring.op2_query(docs).collect()]
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    assert lm_scoring.op2_query(empty).count() == 0


def test_lm_blocks_do_not_matter(docs, monkeypatch):
    whole = sorted(map(tuple, lm_scoring.op2_query(docs).collect()), key=str)
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 500)
    monkeypatch.setattr(lm_scoring, "BUCKET_ENTRIES", 50)
    cut = sorted(map(tuple, lm_scoring.op2_query(docs).collect()), key=str)
    for a, b in zip(whole, cut, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_sharding(docs, rows, empty):
    out = sharding.op3_query(docs).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = collections.defaultdict(list)
    homes = collections.defaultdict(set)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        homes[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in homes.values()) and set(slots) <= set(range(40))
    assert sharding.op3_query(empty).count() == 0


def test_differencing():
    assert sharding.difference(np.array([], np.int64), 3).tolist() == []
    assert sharding.difference(np.array([5], np.int64), 3).tolist() == [0]
    items = np.array([8, 7, 6, 5, 4], np.int64)         # differencing two ways leaves 2 between the halves
    halves = np.bincount(sharding.difference(items, 2), weights=items)
    assert abs(halves[0] - halves[1]) == 2
    rng = np.random.default_rng(1)
    items = np.sort(rng.integers(1, 10**6, 3000))[::-1].copy()
    sums = np.bincount(sharding.difference(items, 40), weights=items, minlength=40)
    assert sums.max() - sums.min() < 1000 and len(sums) == 40


def _fingerprint(text, k=3):
    w = words_of(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), seed=42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps):
    root = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if bin(fps[i] ^ fps[j]).count("1") <= 2 and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def test_simhash(docs, rows, empty):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [_fingerprint(t) for _, t in rows]
    roots = _components(fps)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min([x for x in (i, least.get(r)) if x is not None], default=None)
    same(simhash_dedup.op4_query(docs), [(i, f"{f:016x}", least[r]) for (i, _), f, r in zip(rows, fps, roots, strict=True)])
    assert simhash_dedup.op4_query(empty).count() == 0
    stay = simhash_dedup.one_of_each(docs)
    assert stay.columns == docs.columns and stay.count() == len(set(roots))
    assert simhash_dedup.one_of_each(empty).count() == 0


@pytest.mark.parametrize("pairwise", [512, 2])
def test_buckets_of_close_fingerprints(spark, monkeypatch, pairwise):
    """Chains of fingerprints, with buckets linked by pairs and by sorting."""
    monkeypatch.setattr(simhash_dedup, "PAIRWISE", pairwise)
    rng = random.Random(pairwise)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
    fps = sorted(fps)
    from roadlens.llm.components import components
    frame = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    got = {r["node"] % 2**64: r["root"] % 2**64 for r in components(simhash_dedup.bucket_links(frame, total=len(fps))).collect()}
    groups = collections.defaultdict(set)
    for f in fps:
        groups[got.get(f, f)].add(f)
    want = collections.defaultdict(set)
    for f, r in zip(fps, _components(fps), strict=True):
        want[r].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    from roadlens.llm.components import components
    links = spark.createDataFrame([(i + 1, i) for i in range(50)] + [(100, 200), (7, 7)], "a long, b long")
    same(components(links), [(i, 0) for i in range(1, 51)] + [(200, 100)])
    assert components(links.where("a < 0")).count() == 0


@pytest.fixture(scope="module")
def byte_ids(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [(i, e.ids) for (i, _), e in zip(rows, t.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True)]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_pieces(byte_ids, rows):
    from roadlens.llm.token_ids import TokenIds
    encoder = TokenIds(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a  b", " lead", "tail ", "x\n\n y", "w\n", "\nA b", "a.'s b", "ab1 2.3,4", "a÷b ×", "\x85 a", "x\n\n\ny z", ". .. a..b",
           "é.\nB |", "\xa0 b", "don't I'm", "a <|endoftext|>b", "ñ\x97 Ǆɀ Ș.", "　x y", "a​b c", "é f"]
    texts = [t or "" for _, t in rows] + odd
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):                                  # anew, and from memory
        got = [part.tolist() for ids, sizes in encoder.batches(texts) for part in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == want


def test_packing(docs, byte_ids, empty):
    out = packing.op5_query(docs).collect()
    whole = collections.Counter((str(i), len(ids) + 1) for i, ids in byte_ids)
    known = {(str(i), len(ids) + 1, s): _crc((ids + [0])[s:s + 1024]) for i, ids in byte_ids for s in range(0, len(ids) + 1, 1024)}
    same_key = collections.defaultdict(set)
    for i, ids in byte_ids:
        for s in range(0, len(ids) + 1, 1024):
            same_key[str(i), len(ids) + 1, s].add(_crc((ids + [0])[s:s + 1024]))
    assert all(r["ids_crc32"] in same_key[str(r["doc_id"]), r["doc_tokens"], r["start"]] for r in out) and known
    assert collections.Counter((str(r["doc_id"]), r["doc_tokens"]) for r in out if r["start"] == 0) == whole
    assert sum(r["length"] for r in out) == sum(len(ids) + 1 for _, ids in byte_ids)
    packs = collections.defaultdict(list)
    for r in out:
        packs[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in packs.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 1024
    assert set(packs) == set(range(len(packs)))
    assert packing.op5_query(empty).count() == 0


def test_patterns():
    rng = random.Random(2)
    histogram = {n: rng.randint(1, 3000) for n in rng.sample(range(1, 1025), 400)}
    packs = packing.patterns(histogram)
    used = collections.Counter()
    for lengths, count in packs:
        assert sum(lengths) <= 1024 and list(lengths) == sorted(lengths, reverse=True)
        for n in lengths:
            used[n] += count
    assert used == histogram
    total = sum(n * c for n, c in histogram.items())
    assert total / (1024 * sum(c for _, c in packs)) > 0.95 and len(packs) < 2 * 1024
    ranges = collections.defaultdict(int)
    for length, low, high, _, _ in packing.rank_ranges(packs):
        assert low == ranges[length]
        ranges[length] = high + 1
    assert ranges == histogram and packing.patterns({}) == []


@pytest.mark.parametrize("hot", [1, 5, 20, 40, 100, 300, 400])
def test_patterns_of_a_hot_length(hot):
    """A third of all pieces, or all of them, have one length: packs are filled with it."""
    lengths = np.random.default_rng(1).lognormal(5, 1, 20_000).astype(int).clip(1, 1024).tolist()
    mixed = collections.Counter(lengths + [hot] * 10_000)
    for histogram, least in ((mixed, 0.97), ({hot: 10_000}, 10_000 * hot / 1024 / -(-10_000 // (1024 // hot)))):
        packs, used = packing.patterns(histogram), collections.Counter()
        for pattern, count in packs:
            assert sum(pattern) <= 1024 and count > 0
            for n in pattern:
                used[n] += count
        assert used == histogram
        assert sum(n * c for n, c in histogram.items()) / (1024 * sum(c for _, c in packs)) >= least


MUTATED = "abcdefghij "


def _mutate(rng, text, rate):
    out = []
    for c in text:
        u = rng.random()
        out.append("" if u < rate / 3 else rng.choice(MUTATED) if u < 2 * rate / 3 else c + rng.choice(MUTATED) if u < rate else c)
    return "".join(out)


def test_decontamination(spark, docs, empty):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()] + [(None, "x"), (900, None), (901, ""), (902, "a short one here")]
    rng = random.Random(1)
    planted = {1000 + k: (i, PROSE + _mutate(rng, t, rate) + " " + PROSE) for k, (i, t, rate) in enumerate(
        (i, t, rate) for rate in (0, 0.02, 0.05) for i, t in items[:20])}
    planted[2000] = (items[0][0], items[0][1].upper().replace(" ", "\n "))
    planted[2001] = (902, "Here is A SHORT one  here, too")
    frame = spark.createDataFrame([(i, t, "en", "s", 0, *EXTRA) for i, (_, t) in planted.items()] * 2, SCHEMA).unionByName(docs)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.contaminated(frame, benchmark).collect()
    normal = {i: decontamination.normal(t) for i, (_, t) in planted.items()}
    texts = dict(items)
    hits = set()
    for r in out:
        if r["doc_id"] in planted:
            item = decontamination.normal(texts[r["item_id"]])
            assert r["edits"] == min(_distances(item, normal[r["doc_id"]][r["start"]:r["end"]])) <= 0.2 * len(item)
            hits.add((r["doc_id"], r["item_id"]))
    found = sum((i, item) in hits for i, (item, _) in planted.items())
    assert found >= 0.97 * len(planted) and (2000, items[0][0]) in hits and (2001, 902) in hits
    clean = decontamination.without_contaminated(frame, benchmark)
    assert clean.columns == frame.columns
    assert sorted(str(r[0]) for r in clean.select("doc_id").collect() if (r[0] or 0) < 1000) == sorted(
        str(r[0]) for r in docs.select("doc_id").collect() if r[0] not in {o["doc_id"] for o in out})
    assert decontamination.contaminated(empty, benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.where("1 = 0")).count() == 0


def test_decontamination_all_over_an_item():
    """Items of 30 to 400 characters, behind a quote, up to 20 % edits; and where only words or none are left whole."""
    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinshrdlu", weights=range(13, 1, -1), k=rng.randint(2, 9))) for _ in range(3000)]
    line = lambda n: " ".join(rng.choices(words, k=90))[:n].strip()                     # noqa: E731
    texts = [line(n) for low, high in ((30, 60), (60, 100), (100, 400)) for n in (rng.randint(low, high) for _ in range(60))]
    items = decontamination.Items(list(enumerate(texts)))
    for rate in (0, 0.05, 0.1, 0.15, 0.2):
        near = [decontamination.normal(f'{line(300)} "Q:{_mutate(rng, t, rate)}" {line(300)}') for t in texts]
        wanted = {(k, k) for k, t in enumerate(texts) if min(_distances(t, near[k])) <= 0.2 * len(t)}
        found = {m[:2] for m in items.matches(near)}
        assert len(wanted & found) >= (0.95 if rate else 1) * len(wanted) > 0
    han = "".join(map(chr, rng.sample(range(0x4E00, 0x9FA5), 40)))
    head, tail = "x" * 18 + texts[-1][18:120], texts[-1][:102] + "x" * 18
    items = decontamination.Items([(1, han), (2, texts[-1][:120])])
    assert {m[:2] for m in items.matches(["漢字" * 30 + han + "文字" * 30, line(80) + head + line(80), line(80) + tail + line(80)])} == {(0, 0), (1, 1), (2, 1)}


def test_decontamination_without_a_whole_gram(spark):
    """Every sixth or seventh character replaced, so that no gram of 8 is left whole; and spaces written otherwise."""
    texts = [decontamination.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    other = lambda t, k: "".join("#" if i % k == k - 1 else c for i, c in enumerate(t))       # noqa: E731
    items = decontamination.Items(list(enumerate(texts)))
    short = [t[:40] for t in texts]
    for searched, cases in ((items, [[other(t, 6) for t in texts], [other(t, 7) for t in texts], [t.replace(" ", "_") for t in texts]]),
                            (decontamination.Items(list(enumerate(short))), [[other(t, 7) for t in short]])):
        for near in cases:
            wanted = {(k, k) for k, t in enumerate(near) if min(_distances(searched.texts[k], t)) <= searched.limits[k]}
            assert len(wanted & {m[:2] for m in searched.matches([f"{PROSE} {t} {PROSE}" for t in near])}) >= 0.9 * len(wanted) > 0


def _distances(pattern, text):
    """Least edit distances of the pattern to parts of the text that end at each place, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (p != c)))
        row = new
    return row


def test_alignment():
    rng = random.Random(7)
    for _ in range(200):
        pattern = "".join(rng.choices("abc", k=rng.randint(1, 12)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 20)))
        want = _distances(pattern, text)
        assert decontamination._ends(pattern, text) == want
        edits, start, end = decontamination.aligned(pattern, text)
        assert edits == min(want) == _distances(pattern, text[start:end])[-1]


def test_token_counts(docs, rows, empty):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    count = lambda t: len(model.encode(t, num_threads=1))
    out = token_counts.op7_query(docs)
    same(out.select("doc_id", "n_bytes", "n_tokens", "over_limit"),
         [(i, len((t or "").encode()), count(t or ""), count(t or "") > 4096) for i, t in rows])
    tables = token_counts.prefix_counts(docs.where("length(text) < 400"), budgets=(3,), with_counts=True)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in tables.collect():
        text = next(t for t in texts[r["doc_id"]] if len(t) + 1 == len(r["counts"]) and count(t) == r["n_tokens"])
        want = [count(text[:k]) for k in range(len(text) + 1)]
        assert r["counts"] == want and r["chars_3"] == max(k for k, c in enumerate(want) if c <= 3)
    assert token_counts.op7_query(empty).count() == 0


def test_url_filters(spark):
    urls = [None, "", "no scheme", "http://", "http://a.com", "http://A.Com/x", "https://www.example.com/en/1?q#f", "http://example.com/en/",
            "http://example.com/eng", "http://x.net/es/1", "http://net/fr/", "http://xnet/es/", "http://a.b.net/en/#/es/", "ftp://adult-x.org/a",
            "http://cheap-pills.example.org/x", "http://my.org/casino/", "http://my.org/Casino/", "http://q.org/free-download/1", "http://com/",
            "http://a.com?x=://b.net/es/", "http://a.org/spam/x", "http://ü.net/fr/ü", "http://a.org/login"]
    extra = "host string, path string, rule string, verdict string, token string, `_row` long"
    pages = spark.createDataFrame([(i, u, *"hprvt", 1) for i, u in enumerate(urls)] + [(4, urls[4], *"hprvt", 1), (None, urls[5], *"hprvt", 1)],
                                  f"page_id long, url string, {extra}")
    import re
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def judge(url):
        rest = (url or "").partition("://")[2]
        host, path = re.match("([^/?#]*)([^?#]*)", rest).groups()
        host = host.translate(lower)
        fits = []
        for action, rule in (r.split() for r in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")):
            name, slash, tail = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
                fits.append((len(rule), action, rule))
        if fits:
            return host, path, max(fits)[2], max(fits)[1]
        bad = any(re.search(r.pattern, host + path) for r in url_filters.PATTERN_RULES)
        return host, path, None, "block" if bad else "allow"

    same(url_filters.op8_query(pages), [(r["page_id"], *judge(r["url"])) for r in pages.collect()])
    assert url_filters.op8_query(pages.where("1 = 0")).count() == 0
    with pytest.raises(ValueError):
        url_filters.url_filters(pages, rules=())


def test_token_files(docs, byte_ids, empty):
    ordered = sorted(((i, ids + [2]) for i, ids in byte_ids), key=lambda x: (x[0] is not None, x[0] or 0))
    out = token_files.token_files(docs, with_ids=True).orderBy("start").collect()
    at = 0
    assert [r["doc_id"] for r in out] == [i for i, _ in ordered]
    for r in out:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == _crc(r["ids"])
        at += r["n_tokens"]
    assert collections.Counter((str(r["doc_id"]), tuple(r["ids"])) for r in out) == collections.Counter((str(i), tuple(ids)) for i, ids in ordered)
    assert token_files.op9_query(empty).count() == 0


def test_huffman():
    rng = np.random.default_rng(3)
    for counts, limit in ((np.array([0, 5]), 4), (np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55]), 18), (2 ** np.arange(20), 6),
                          (rng.integers(0, 4, 300), 18), (rng.zipf(1.3, 3000), 12)):
        lengths = token_files.code_lengths(np.asarray(counts), limit)
        used = counts > 0
        assert ((lengths > 0) == used).all() and lengths.max() <= limit
        if used.sum() > 1:
            assert sum(2.0 ** -lengths[used].astype(float)) == 1
        coder = token_files.Coder(lengths)
        sizes = rng.integers(1, 900, 30)
        ids = rng.choice(np.flatnonzero(used), sizes.sum())
        words, per, within = coder.write(ids, sizes)
        at = (np.cumsum(per) - per) * 32
        n, tokens = token_files.stretches(sizes)
        doc = np.repeat(np.arange(30), n)
        first = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * token_files.STRIDE
        starts = at[doc] + within[(np.cumsum(sizes) - sizes)[doc] + first]
        assert (coder.read(words.tobytes(), starts, tokens) == ids).all()
        assert coder.read(words.tobytes(), starts[7:8], tokens[7:8]).tolist() == ids[(np.cumsum(sizes) - sizes)[doc[7]] + first[7]:][:tokens[7]].tolist()
    free = token_files.code_lengths(np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55]), 18)
    assert sorted(free.tolist()) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]          # the unlimited code of Fibonacci weights


def _cut(texts, span):
    places = collections.Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if places[t[i:i + span]] > 1:
                gone[i:i + span] = True
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        yield len(t), int(gone.sum()), int((np.diff(np.r_[False, gone]) & gone).sum()) if len(t) else 0, hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize(("span", "gram", "hot"), [(400, 64, 20_000), (30, 8, 20_000), (30, 8, 2), (5, 5, 20_000), (6, 1, 1)])
def test_suffix_dedup(docs, rows, monkeypatch, span, gram, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = [(t or "").encode() for _, t in rows]
    same(suffix_dedup.remove_repeats(docs, span, gram), [(i, *c) for (i, _), c in zip(rows, _cut(texts, span), strict=True)])


def test_suffix_dedup_shapes(docs, empty):
    assert suffix_dedup.op10_query(empty).count() == 0
    left = suffix_dedup.without_repeats(docs, length_col="n_chars")
    assert left.columns == docs.columns and left.where("n_chars <> length(text)").count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, 10, 11)


def test_induced_sorting():
    from roadlens.llm.induced_sorting import common_prefixes, suffix_array
    rng = random.Random(1)
    for k in range(150):
        text = bytes(rng.choices(b"abc"[:rng.randint(1, 3)], k=rng.randint(0, 40))) * rng.randint(1, 3)
        sa = suffix_array(np.r_[np.frombuffer(text, np.uint8).astype(np.uint16) + np.uint16(1), np.uint16(0)].astype(np.uint16), 257)
        want = sorted(range(len(text) + 1), key=lambda i: text[i:])
        assert sa.tolist() == want
        prior, common = common_prefixes(text, sa)
        for x, y in zip(want[1:], want[2:], strict=False):
            n = 0
            while max(x, y) + n < len(text) and text[x + n] == text[y + n]:
                n += 1
            assert (prior[y], common[y]) == (x, n)


@pytest.mark.parametrize("kind", ["long", "binary", "string"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_of_hot_classes(spark, monkeypatch, kind, how):
    """A key beyond the limit goes by broadcast, the others by shuffle: together all rows."""
    from roadlens.llm import common
    monkeypatch.setattr(common, "LEAST_HOT", 5)
    make = {"long": int, "binary": lambda i: b"k%d" % i, "string": str}[kind]
    rows = [(make(k), n) for k, size in ((1, 40), (2, 3), (3, 9), (4, 1)) for n in range(size)] + [(None, 0)]
    left = spark.createDataFrame(rows, f"k {kind}, n int")
    classes = spark.createDataFrame([(make(1), 40, "one"), (make(2), 3, "two"), (make(3), 9, "three")], f"k {kind}, size int, v string")
    got = collections.Counter(r.v for r in common.join_by_class(left, classes, "k", "size", len(rows), how).collect())
    assert got == {"one": 40, "two": 3, "three": 9} | ({None: 2} if how == "left" else {})


def test_hot_everywhere(docs, rows, monkeypatch):
    """The operators that join classes give the same when every class counts as hot."""
    from roadlens.llm import common
    plain = [sorted(map(str, f(docs).collect())) for f in (simhash_dedup.op4_query, suffix_dedup.op10_query)]
    left = sorted(str(tuple(r)) for r in suffix_dedup.without_repeats(docs, 30, 8).collect())
    monkeypatch.setattr(common, "LEAST_HOT", 0)
    assert [sorted(map(str, f(docs).collect())) for f in (simhash_dedup.op4_query, suffix_dedup.op10_query)] == plain
    assert sorted(str(tuple(r)) for r in suffix_dedup.without_repeats(docs, 30, 8).collect()) == left


def test_numbers_without_gaps(spark, monkeypatch):
    from roadlens.llm import common
    rows = [("a", i % 7) for i in range(50)] + [("b", 0), ("c", None), ("c", None)]
    out = common.gapless(spark.createDataFrame(rows, "g string, x int"), "g", ["x"], "k", 2_000_000).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.g].append(r.k)
    assert {g: sorted(k) for g, k in by.items()} == {"a": list(range(50)), "b": [0], "c": [0, 1]}


def test_tables_of_pieces():
    from roadlens.llm.piece_hash import PieceTable
    rng = np.random.default_rng(0)
    table, known = PieceTable(16), {}
    for n in (0, 5, 700, 30):
        new = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        table.add(new)
        known.update({int(h): len(known) + i for i, h in enumerate(new)})
        asked = np.r_[np.array(list(known), np.uint64), rng.integers(0, 2**64, 50, dtype=np.uint64)]
        assert table.find(asked).tolist() == [known.get(int(h), -1) for h in asked]


def test_pipeline(spark, tmp_path):
    """Clean documents go through; junk, copies, repeated passages and benchmark items do not."""
    import corpus_pipeline
    rng = random.Random(11)
    vocabulary = [w.strip(".,") for w in PROSE.split()] + ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]

    def prose(n):
        return ". ".join(" ".join(rng.choices(vocabulary, k=12)).capitalize() for _ in range(n)) + "."

    passage, item = prose(9), prose(3)
    clean = {i: prose(10) for i in range(30)}
    texts = dict(clean)
    texts |= {100: "spam " * 200, 101: " ".join(f"x{i}###" for i in range(90)), 102: "", 103: None, 104: clean[3], 105: clean[3].upper().lower()}
    texts |= {110: prose(8) + " " + passage + " " + prose(8), 111: prose(9) + " " + passage + " " + prose(7), 120: prose(6) + " " + item.upper() + " " + prose(6)}
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        seen[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert ids["quality_rules"] == set(texts) - {100, 101, 102, 103}
    assert ids["simhash_dedup"] == ids["quality_rules"] - {104, 105}
    assert ids["suffix_dedup"] == ids["simhash_dedup"]
    left = {r.doc_id: r for r in seen["suffix_dedup"].collect()}
    assert all(left[i].text == t for i, t in clean.items()) and all(passage not in left[i].text for i in (110, 111))
    assert all(left[i].n_chars == len(left[i].text) and len(left[i].text) < len(texts[i]) - 400 for i in (110, 111))
    assert ids["decontamination"] == ids["suffix_dedup"] - {120}
    assert ids["packing"] == ids["decontamination"]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, seen["packing"].collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_passages_of_over_50_words(spark):
    """The pipeline's passages of 51 to 65 words go, also where they have far fewer than 400 bytes; shorter ones stay."""
    import corpus_pipeline
    rng = random.Random(5)

    def prose(n, k=5):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(k - 2, k + 2))) for _ in range(n))

    passages = {n: prose(n) for n in (51, 53, 56, 60, 65)} | {52: prose(52, 3)}
    short, twin, pair = prose(44), prose(45), [prose(40), prose(40)]
    texts = {}
    for n, p in [*passages.items(), (44, short)]:
        for k in range(2):
            texts[n * 10 + k] = (prose(60) + " " + p + " ", prose(70))
    texts |= {1: (twin, ""), 2: (twin, "")}                       # equal texts of fewer words
    texts |= {3: (prose(60) + " " + pair[0] + " " + pair[1] + " ", prose(60)),
              4: (prose(60) + " " + pair[0] + " ", prose(60)), 5: (prose(60) + " " + pair[1] + " ", prose(60))}
    assert all(150 <= len(p) < 400 for p in passages.values())
    frame = spark.createDataFrame([(i, a + b, "en", "s", len(a + b)) for i, (a, b) in texts.items()],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r for r in corpus_pipeline.suffix_dedup(spark, frame, "").collect()}
    assert set(left) == set(texts) and all(r.n_chars == len(r.text) for r in left.values())
    for n, p in passages.items():
        for k in range(2):
            a, b = texts[n * 10 + k]
            assert left[n * 10 + k].text in (a.removesuffix(p + " ") + b, a.removesuffix(" " + p + " ") + b) or (
                p not in left[n * 10 + k].text and len(a + b) - len(left[n * 10 + k].text) <= len(p) + 4)
    assert all(left[i].text == "".join(texts[i]) for i in (440, 441, 1, 2, 3, 4, 5))


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
