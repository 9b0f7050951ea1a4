"""Members of large JSON documents, cut in ranges of bytes, against Python's parser."""

import json
import random

import pytest

from recall_lens.sources import json_ranges
from recall_lens.sources.recall_feed import read_documents, read_lines

STRINGS = ["", "}", "{", "]", "[", '"', "\\", '\\"', "}{", '"results": [', "a}b}c", "é}日", "\n", "x" * 40, '\\}"']


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 4 else 3)
    if kind < 2:
        return rng.choice(STRINGS)
    if kind == 2:
        return rng.choice([None, True, 1, -2.5])
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice([*STRINGS, "results"]): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def document(rng, members):
    results = [value(rng, 1) if rng.random() < 0.1 else {"id": i, "v": value(rng), "results": value(rng)} for i in range(members)]
    parts = [("meta", value(rng)), ("results", results), ("other", [{"id": -1}, value(rng)])]
    if rng.random() < 0.3:
        rng.shuffle(parts)
    return dict(parts)


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def canonical(values):
    return sorted(json.dumps(v, sort_keys=True) for v in values)


def test_ranges_of_many_documents(spark, tmp_path, small_ranges):
    rng = random.Random(3)
    expected = []
    for i in range(12):
        made = document(rng, rng.choice([0, 1, 5, 60]))
        expected += [m for m in made["results"] if isinstance(m, dict)]
        (tmp_path / f"d{i}.json").write_text(json.dumps(made, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5) + rng.choice(["", "\n"]))
    found = json_ranges.members(spark, str(tmp_path))
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert canonical(json.loads(r.value) for r in found.collect()) == canonical(expected)


def test_documents_without_members(spark, tmp_path):
    texts = ['{"results": []}', "{}", "[]", '{"results": {"results": [{"a": 1}]}}', '[{"results": [{"a": 1}]}]', '{"results": [[{"a": 1}], 1, "{"]}', "", '{"a": "results", "b": [{"c": 1}]}']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    assert json_ranges.members(spark, str(tmp_path)).count() == 0


def test_a_member_over_many_ranges(spark, tmp_path, small_ranges):
    member = {"a": [{"b": "}" * 50} for _ in range(100)], "c": "{" * 5}
    (tmp_path / "d.json").write_text(json.dumps({"results": [{"x": 1}, member, {"y": 2}]}))
    found = [json.loads(r.value) for r in json_ranges.members(spark, str(tmp_path)).collect()]
    assert canonical(found) == canonical([{"x": 1}, member, {"y": 2}])


def test_notes_combine(spark):
    rng = random.Random(8)
    for _ in range(30):
        text = json.dumps(document(rng, 6))
        lines = [(x + "}").encode() for x in text.split("}")[:-1]]
        cuts = sorted(rng.sample(range(len(lines) + 1), min(4, len(lines))))
        ranges = [lines[i:j] for i, j in zip([0, *cuts], [*cuts, len(lines)], strict=True)]
        notes = []
        for block, of_range in enumerate(ranges):
            for inside in (False, True):
                note = json_ranges._Note(inside)
                for line in of_range:
                    note.add(line, b'"results"')
                notes.append(("p", block, inside, note.inside, note.closes, "".join(note.opens)))
        table = json_ranges.pa.table(list(zip(*notes, strict=True)), names=json_ranges._NOTE.names)
        states = json_ranges._states(table).to_pylist()
        whole, at = json_ranges._Note(False), 0
        for state, of_range in zip(states, ranges, strict=True):
            assert (state["inside"], state["open"]) == (whole.inside, "".join(whole.opens))
            for line in of_range:
                whole.add(line, b'"results"')


def test_document_equals_lines(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    recalls = [{"cfres_id": str(i), "action": rng.choice(STRINGS), "k_numbers": [rng.choice(STRINGS)], "openfda": {"a": value(rng)}, "unknown": 1} for i in range(80)]
    compact = lambda v: json.dumps(v, separators=(",", ":"), ensure_ascii=False)
    (tmp_path / "d.json").write_text(compact({"meta": {"results": {"total": 80}}, "results": recalls}))
    (tmp_path / "l.jsonl").write_text("\n".join(map(compact, recalls)))
    documents, lines = read_documents(spark, str(tmp_path / "d.json")), read_lines(spark, str(tmp_path / "l.jsonl"))
    assert documents.columns == lines.columns
    assert sorted(map(repr, documents.collect())) == sorted(map(repr, lines.collect()))
