"""JSON exports: every good record and one reject per bad span, whatever the shape of the file."""

import json
import random
import re

import pytest

from roadlens.sources import files as FS
from roadlens.sources import json_records as J

REC = [{"recordId": f"A-{i}", "volume": i, "note": 'br { "ace" ] }', "meta": {"tags": [{"k": i}], "deep": [[i, []], {}]}} for i in range(10)]
IDS = [r["recordId"] for r in REC]


def scan(text):
    s = J.RecordScanner()
    out = []
    for line in text.split("\n"):
        out += s.feed(line)
    out += s.end()
    return [json.loads(t)["recordId"] for ok, t in out if ok], [t for ok, t in out if not ok]


def pretty(rows):
    return "\n".join(json.dumps(r, indent=2) for r in rows)


def test_scanner_on_whole_documents():
    for indent in (None, 0, 1, 4):
        for doc in (REC, {"records": REC}, {"meta": {"records": [1]}, "n": [1, {"a": 2}], "records": REC, "after": {"x": [{}]}, "z": 5}):
            assert scan(json.dumps(doc, indent=indent)) == (IDS, [])
    assert scan(pretty(REC)) == (IDS, []) and scan("".join(json.dumps(r) for r in REC)) == (IDS, [])
    assert scan(json.dumps(REC) + "\n" + json.dumps({"records": REC[:2]}) + "\n" + pretty(REC[:1])) == (IDS + IDS[:2] + IDS[:1], [])
    assert scan("") == ([], []) and scan("[]") == ([], []) and scan('{"records": []}') == ([], [])
    one = {"recordId": "x", "records": 5}
    assert scan(json.dumps(one)) == (["x"], []) and scan(json.dumps({"a": {"records": [1]}, "recordId": "y"}, indent=1)) == (["y"], [])


def test_scanner_on_broken_ones():
    cut = json.dumps(REC[3], indent=2)[:60]
    assert scan(pretty(REC[:3]) + "\n" + cut + "\n" + pretty(REC[4:]))[0] == IDS[:3] + IDS[4:]
    assert scan(pretty(REC[:3]) + "\n" + cut + "\n" + pretty(REC[4:]))[1] == [cut.strip()]
    assert scan(json.dumps(REC) + " and so on")[0] == IDS and scan(json.dumps(REC) + " and so on")[1] == ["and so on"]
    assert scan('[{"recordId": 1}, null, 7, {"recordId": 2}, "s", [3]]') == ([1, 2], ["null", "7", '"s"', "[3]"])
    assert scan('{"records": [{"recordId": 1}, {"recordId": 2,}, {"recordId": 3}]}') == ([1, 3], ['{"recordId": 2,}'])
    assert scan('[{"recordId": 1}, {"recordId": 2, "b": [1, {"recordId": 3}]') == ([1], ['{"recordId": 2, "b": [1, {"recordId": 3}]'])
    assert scan('[{"recordId": 1}\n{"recordId": 2}\n{"recordId": 3, "s": "open}\n]')[0] == [1, 2]
    assert scan("{ this is no JSON")[0] == [] and len(scan("{ this is no JSON")[1]) == 1
    assert scan('}]{"recordId": 1}') == ([1], ["}]"])


def test_scanner_loses_no_character():
    """Of files with any characters taken out or put in, all text is in a record or in a reject; a broken line costs a record or two."""
    rng = random.Random(8)
    want = {json.dumps(r) for r in REC}
    most = 0
    for _ in range(600):
        text = rng.choice([json.dumps(REC), json.dumps(REC, indent=1), json.dumps({"records": REC}, indent=2), pretty(REC)])
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "}", "{", "]", "[", '"', ",", "x"]) + text[at + rng.choice([0, 1, 30]):]
        scanner = J.RecordScanner()
        found = [x for line in text.split("\n") for x in scanner.feed(line)] + scanner.end()
        plain = lambda x: "".join(x.split())
        kept = "".join(plain(t) for _, t in found)
        if "records" not in text:           # between spans there are only the commas and the brackets of the list
            assert re.sub(r"[][,]", "", plain(text)) == re.sub(r"[][,]", "", kept), text
        whole = [t for ok, t in found if ok and json.dumps(json.loads(t)) in want]
        assert len(whole) == 10 or any(not ok for ok, _ in found) or len(found) != len(whole) or text.count("recordId") < 10
        most += "\n" not in text or len(whole) >= 7
    assert most >= 580


CASES = {
    "truncated line": ("\n".join(json.dumps(r) if i != 4 else json.dumps(r)[:25] for i, r in enumerate(REC)), 9, 1),
    "null line": ("\n".join(json.dumps(r) if i != 4 else "null" for i, r in enumerate(REC)), 9, 1),
    "trailing text": ("\n".join(map(json.dumps, REC)) + "\nthe end", 10, 1),
    "text behind a record": ("\n".join(json.dumps(r) + (" // 7" if i == 7 else "") for i, r in enumerate(REC)), 10, 1),
    "two in a line": ("\n".join(map(json.dumps, REC[:8])) + "\n" + json.dumps(REC[8]) + json.dumps(REC[9]), 10, 0),
    "pretty documents": (pretty(REC), 10, 0),
    "pretty documents, one cut off": (pretty(REC[:5]) + "\n" + json.dumps(REC[5], indent=2)[:50] + "\n" + pretty(REC[6:]), 9, 1),
    "list with text behind": (json.dumps(REC, indent=1) + "\n%%EOF", 10, 1),
    "list cut off": (json.dumps(REC, indent=1)[:-30], 9, 1),
    "several lists": (json.dumps(REC[:4]) + "\n" + json.dumps({"records": REC[4:]}), 10, 0),
    "mark and blank lines": ("﻿" + "\n\n".join(map(json.dumps, REC)) + "\n\n", 10, 0),
    "empty": ("", 0, 0),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_files(spark, tmp_dir, name):
    text, good, bad = CASES[name]
    open(f"{tmp_dir}/x.json", "w", encoding="utf-8").write(text)
    records, rejects = FS.read_export_with_rejects(spark, f"{tmp_dir}/x.json")
    got = [(r.recordId, r.volume, r.note, r.meta.tags[0].k) for r in records.collect()] if good else []
    assert len(got) == good and rejects.count() == bad
    assert set(got) <= {(r["recordId"], str(r["volume"]), r["note"], str(r["meta"]["tags"][0]["k"])) for r in REC} and len(set(got)) == good
    if bad:
        with pytest.raises(ValueError, match="x.json"):
            FS.read_export_json(spark, f"{tmp_dir}/x.json")


def test_many_files_of_each_shape(spark, tmp_dir):
    for i in range(3):
        open(f"{tmp_dir}/l{i}.json", "w").write("\n".join(map(json.dumps, REC[i::3])) + "\nbad line")
        open(f"{tmp_dir}/d{i}.json", "w").write(json.dumps({"records": REC[i::3]}, indent=2))
    records, rejects = FS.read_export_with_rejects(spark, tmp_dir)
    assert sorted(r.recordId for r in records.collect()) == sorted(IDS * 2)
    assert sorted((r.file.split("/")[-1], r.text) for r in rejects.collect()) == [(f"l{i}.json", "bad line") for i in range(3)]


def test_lines_are_judged_once(spark, tmp_dir, monkeypatch):
    """The verdict on a line and its cut spans are read from the shared folder, not from the export again."""
    from roadlens.sources import json_records as J
    with open(f"{tmp_dir}/judged.json", "w") as f:
        f.write('{"a": 1}\n\n{"a": 2} tail\n{"a": 3}\n')
    spans = J.export_spans(spark, f"{tmp_dir}/judged.json")
    assert not any("judged.json" in f for f in spans.inputFiles())
    assert sorted((r.ok, r.text) for r in spans.collect()) == [(False, "tail"), (True, '{"a": 1}'), (True, '{"a": 2}'), (True, '{"a": 3}')]


def test_round_trip_keeps_little_on_disk(spark, tmp_dir, monkeypatch):
    """The export is stored small, and its write frees the shuffle files of the joins behind it."""
    import pathlib

    from roadlens.plans import io_queries
    from roadlens.sources import tables as T
    from tests.conftest import SF_SMALL
    key, seen, write = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], io_queries.W.write_json_records

    def see(*args, **more):
        seen.append(spark.conf.get(key))
        write(*args, **more)

    monkeypatch.setattr(io_queries, "_run_dir", lambda spark, name: f"{tmp_dir}/{name}")
    monkeypatch.setattr(io_queries.W, "write_json_records", see)
    before = spark.conf.get(key)
    df = io_queries.q_json_export_roundtrip(spark, SF_SMALL)
    assert seen == ["true"] and spark.conf.get(key) == before
    stored = sum(p.stat().st_size for p in pathlib.Path(f"{tmp_dir}/json-export/export.json").glob("part-*"))
    text = spark.read.text(f"{tmp_dir}/json-export/export.json").selectExpr("sum(octet_length(value) + 1) n").first()["n"]
    assert stored * 5 < text
    assert df.count() == T.devices(spark, SF_SMALL).count()


def test_freed_shuffles_leave_no_files(spark, tmp_dir):
    import pathlib
    import time

    from roadlens.session import shuffles_freed
    local = pathlib.Path(spark.conf.get("spark.local.dir"))

    def shuffled():
        return set(local.rglob("shuffle_*.data"))

    before = shuffled()
    with shuffles_freed(spark):
        spark.range(1000).repartition(5, "id").write.parquet(f"{tmp_dir}/x")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.read.parquet(f"{tmp_dir}/x").count() == 1000
