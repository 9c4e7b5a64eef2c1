"""Arrays in one file, read in byte ranges of a few bytes each, against json.loads."""

import json
import random

import pytest
from pyspark.sql import types as S

from ledgerloom.sources import archive, json_array

SHAPE = S.StructType([S.StructField("a", S.StringType()), S.StructField("b", S.LongType()), S.StructField("c", S.ArrayType(S.StructType([S.StructField("d", S.StringType())])))])


@pytest.fixture
def tiny(spark):
    """Blocks of 40 bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def value(rng, deep=0):
    texts = ["", "}", "{[", 'quo"te', "back\\slash", "\\", '\\"}', "new\nline", "naïve 漢字", "],", "x" * 70, '"}, {"a": "']
    kind = rng.randrange(9)
    if kind < 5 or deep > 2:
        return {"a": rng.choice([*texts, None]), "b": rng.choice([1, None, 7]), **({"c": [{"d": rng.choice(texts)} for _ in range(rng.randrange(3))]} if rng.random() < 0.5 else {})}
    return [3, "plain }", None, [value(rng, deep + 1), {"a": "inner"}]][kind - 5]


def plain(rows):
    return [(r["ord"], r["a"], r["b"], None if r["c"] is None else [x["d"] for x in r["c"]]) for r in sorted(rows, key=lambda r: r["ord"])]


@pytest.mark.parametrize("seed", range(4))
def test_arrays_in_tiny_blocks(tiny, tmp_path, seed):
    rng = random.Random(seed)
    data = [value(rng) for _ in range(30)]
    text = rng.choice(["", "\n", "\t \r\n", "﻿"]) + json.dumps(data, ensure_ascii=seed % 2 == 0, indent=rng.choice([None, 2])) + rng.choice(["", "\n \n"])
    (tmp_path / "a.json").write_text(text)
    path = f"file://{tmp_path}/a.json"
    parts, begins, kind = json_array.scan(tiny, path)
    assert kind == "array" and len(begins) > 5 and parts.rdd.getNumPartitions() > 10
    expected = [(k, x["a"], x["b"], [y["d"] for y in x["c"]] if "c" in x else None) for k, x in enumerate(data) if isinstance(x, dict)]
    assert plain(archive.read_archive(tiny, path, SHAPE).collect()) == expected
    # cut short anywhere, it is broken and never empty
    whole = text.strip().strip("﻿").strip()
    for at in rng.sample(range(2, len(whole) - 1), 3):
        (tmp_path / "cut.json").write_text(whole[:at])
        assert archive.archive_state(tiny, f"file://{tmp_path}/cut.json") == "broken", whole[:at]
        with pytest.raises(ValueError):
            archive.read_archive(tiny, f"file://{tmp_path}/cut.json", SHAPE, broken="error")
        assert archive.read_archive(tiny, f"file://{tmp_path}/cut.json", SHAPE).count() == 0


def test_states(spark, tmp_path):
    cases = {"[]": "empty", "\n[ ]\n": "empty", "": "blank", "  \n": "blank", "[1, 2]": "array", '[{"a": 1}] x': "broken", "[{}][{}]": "broken", "[{}]]": "broken", '{"a": 5}': "object", "3": "other", '[{"a": }]': "broken", "[": "broken", '["': "broken", '[{"a": "\\"}"}]': "array"}
    for k, (text, state) in enumerate(cases.items()):
        (tmp_path / f"f{k}").write_text(text)
        assert archive.archive_state(spark, f"file://{tmp_path}/f{k}") == state, text
    assert archive.archive_state(spark, f"file://{tmp_path}/none") == "missing"


def test_leading_white_space(spark, tmp_path):
    shape = S.StructType.fromDDL("a long")
    for k, (text, rows) in enumerate({'\n[{"a":1},{"a":2}]': [1, 2], '\n{"properties":[{"a":3},\n {"a":4}]}': [3, 4], '\t{"a":5}': [5], '\r\n\t {"items": \n [{"a":6}]}': [6], '﻿[{"a":7}]': [7], '﻿\n{"a":8}': [8]}.items()):
        (tmp_path / f"w{k}").write_text(text)
        assert [r["a"] for r in archive.read_archive(spark, f"file://{tmp_path}/w{k}", shape).orderBy("ord").collect()] == rows, text


def test_one_object(spark, tmp_path):
    shape = S.StructType.fromDDL("a long, b string")
    for name, text, rows in (("x", '\n {"a": 1, "b": "y"}', [(1, "y")]), ("list", "[1]", []), ("cut", '{"a": 1', []), ("text", "hello", [])):
        (tmp_path / name).write_text(text)
        assert [tuple(r) for r in archive.read_object(spark, f"file://{tmp_path}/{name}", shape).collect()] == rows, name
    assert archive.read_object(spark, f"file://{tmp_path}/none", shape).count() == 0
    (tmp_path / "large").write_text(json.dumps({"a": 3, "b": "x" * 20_000_000}))  # above the limit of a variant
    assert archive.read_object(spark, f"file://{tmp_path}/large", shape).selectExpr("a", "length(b)").collect() == [(3, 20_000_000)]
