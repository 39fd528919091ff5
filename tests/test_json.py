"""The JSON reader against whole files decoded at once, on files split at any place."""

import json
import random

import pytest

from millrace.sources import json as js


def value(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rnd.choices(["a", "}", "{", "]", '"', "\\", "é", "\n", " ", ",", "[{", "\\\\"], k=rnd.randrange(9)))
    if kind < 5:
        return rnd.choice([1, 2.5, True, None])
    if kind < 6:
        return [value(rnd, depth + 1) for _ in range(rnd.randrange(3))]
    return {rnd.choice(["id", "x", "y}"]): value(rnd, depth + 1) for _ in range(rnd.randrange(3))}


def record(rnd):
    return {"id": rnd.randrange(1000), "v": value(rnd), "w": value(rnd)}


def shapes(seed, n):
    rnd = random.Random(seed)
    some = [record(rnd) for _ in range(n)]
    yield "array", rnd.choice(["", "﻿", " \n"]) + json.dumps(some, indent=rnd.choice([None, 1]), ensure_ascii=False) + "\n"
    yield "lines", "".join(json.dumps(r) + "\n" for r in some)
    yield "concatenated", " ".join(json.dumps(r, indent=2) for r in some)
    yield "envelope", json.dumps({"meta": {"x": {"y": [{}]}, "z": [1]}, "few": some[:1], "numbers": [1, 2], "mixed": [{}, 1] * n, "records": [some[0], None, *some[1:]], "late": {"q": "}"}}, ensure_ascii=False)
    yield "mixed array", json.dumps([x for r in some for x in (r, 5, [r, "}"], None)])


def expected(text):
    out = []
    for v in js.values_of(text):
        out += js.expand(v)
    return [(js.text_of(r.get("id")), js.text_of(r.get("v"))) for r in out]


def read(spark, path, part, **more):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    try:
        return [(r["id"], r["v"]) for r in js.read_json(spark, str(path), ["id", "v"], **more).orderBy("_line").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("seed", range(3))
def test_any_shape_in_any_parts(spark, tmp_path, seed):
    for name, text in shapes(seed, 40):
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
        want = expected(text.removeprefix("﻿"))
        for part in ("128m", "600b", "90b"):
            assert read(spark, tmp_path / f"{name}.json", part) == want, (name, part)
            if name == "envelope":
                assert read(spark, tmp_path / f"{name}.json", part, whole_bytes=200) == want, part
    (tmp_path / "none.json").write_text(json.dumps({"a": [{}, 1] * 200, "b": {"c": [{}]}}))
    with pytest.raises(ValueError, match="holds no array"):
        read(spark, tmp_path / "none.json", "90b", whole_bytes=200)


def test_each_file_has_its_own_shape(spark, tmp_path):
    (tmp_path / "a.json").write_text("".join(f'{{"id": {i}, "v": "x"}}\n' for i in range(300)))
    (tmp_path / "b.json").write_text('[{"id": "b", "v": 1}]')
    (tmp_path / "c.json").write_text('{"items": [{"id": "c"}, {"id": "d"}]}')
    (tmp_path / "d.json").write_text(" \n")
    for part in ("128m", "100b"):
        assert sorted(read(spark, tmp_path, part), key=str) == sorted([*((str(i), "x") for i in range(300)), ("b", "1"), ("c", None), ("d", None)], key=str)


@pytest.mark.parametrize("text, message", [
    ("42", "no records"), ("[1, 2, 3]", "no records"), ('{"id": 1} 5', "no records"), ('[{"id": 1}, {"id": 2', "ends inside"), ('[{"id": 1}]]', "never opened"), ('{"id": "x', "ends inside"), ('{"id": tru}', "Expecting"),
])
def test_what_is_no_json_is_an_error(spark, tmp_path, text, message):
    (tmp_path / "a.json").write_text(text)
    for part in ("128m", "4b"):
        with pytest.raises(Exception, match=message):
            js.read_json(spark, str(tmp_path / "a.json"), ["id"]).collect()


def test_strict_refuses_elements_that_are_no_objects(spark, tmp_path):
    for text in ('[{"id": 1}, 5]', '[{"id": 1}, [{"id": 2}]]', '[{"id": 1}, null]', '["a", {"id": 1}]'):
        (tmp_path / "a.json").write_text(text)
        assert [r[0] for r in read(spark, tmp_path / "a.json", "128m")] == ["1"]
        with pytest.raises(Exception, match="no records"):
            read(spark, tmp_path / "a.json", "128m", strict=True)


def test_a_large_array_is_read_in_many_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text("[" + ",".join(f'{{"id": {i}, "v": "{"z" * 30}}}"}}' for i in range(20_000)) + "]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = js.read_json(spark, str(tmp_path / "a.json"), ["id", "v"])
        assert df.rdd.getNumPartitions() > 5
        assert [r["id"] for r in df.orderBy("_line").collect()] == [str(i) for i in range(20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
