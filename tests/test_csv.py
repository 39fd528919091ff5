"""The CSV reader against a plain one that goes through a file character by character, on files split at any place."""

import random

import numpy as np
import pytest

from millrace.sources import csv, quotes


def plain(text, comma=",", lazy=False, header=False, width=4):
    """(values, error) of each record."""
    lines = text.split("\n")
    lines = [x.removesuffix("\r") for x in (lines[:-1] if lines[-1] == "" else lines)]
    out, i = [], 0
    while i < len(lines):
        rest, first, fields, error = lines[i], lines[i], [], None
        i += 1
        if not rest.strip(" \t\r\x0b\x0c"):
            continue
        while error is None:
            if not rest.startswith('"'):
                value, sep, rest = rest.partition(comma)
                error = "bare quote in a value" if '"' in value and not lazy else None
                fields.append(value)
                if not sep:
                    break
                continue
            rest, value, go = rest[1:], "", None
            while go is None:
                part, quote, behind = rest.partition('"')
                value += part
                if not quote:
                    if i == len(lines):
                        error, go = None if lazy else "a quote is never closed", False
                    else:
                        value, rest, i = value + "\n", lines[i], i + 1
                elif behind.startswith('"'):
                    value, rest = value + '"', behind[1:]
                elif behind.startswith(comma):
                    rest, go = behind[1:], True
                elif not behind:
                    go = False
                elif lazy:
                    value, rest = value + '"', behind
                else:
                    error, go = "bare quote in a value", False
            fields.append(value)
            if not go:
                break
        out.append((fields, error, first))
    return out[header:]


def read(spark, path, part="128m", **options):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    try:
        columns = ["a", "b", "c", "d"]
        return [tuple(r) for r in csv.read_csv(spark, str(path), csv.CsvOptions(trim_space=False, **options), columns).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def padded(fields):
    return tuple(x or None for x in [*fields, None, None, None, None][:4])


def same(got, want, lazy=False):
    assert sorted(str(r[4]) for r in got) == sorted(str(e) for _, e, _ in want)
    if not lazy:
        assert sorted(map(repr, (r[:4] for r in got if r[4] is None))) == sorted(repr(padded(f)) for f, e, _ in want if e is None)


@pytest.mark.parametrize("lazy", [False, True])
def test_any_text_in_any_parts(spark, tmp_path, lazy):
    rnd = random.Random(lazy)
    for k in range(14):
        text = "".join(rnd.choices(["a", 'b"', '"', '""', ",", "\n", "\r\n", ',"', '",', '"\n', "\r", " ", "é"], k=rnd.choice((3, 20, 150))))
        path = tmp_path / f"{k}.csv"
        path.write_bytes(("x\n" + text).encode())
        want = plain("x\n" + text, lazy=lazy)
        for part in ("128m", "7b"):
            same(read(spark, path, part, has_header=False, lazy_quotes=lazy), want, lazy)


def test_an_open_quote_is_one_error_and_loses_no_other_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\nh,i\nc,"d\ne,f\n' + "g,h\n" * 50)
    (tmp_path / "b.csv").write_text('a,b\n1,"2\n3"\n"bad,bad\nc,d\n')
    (tmp_path / "c.csv").write_text('a,b\nx"y,z\nlast,row\n')
    want = [("h", "i", None), ("c", "d", "a quote is never closed"), ("1", "2\n3", None), ("bad,bad", None, "a quote is never closed"), ('x"y', "z", "bare quote in a value"), ("last", "row", None)]
    for part in ("128m", "16b"):
        assert sorted(map(repr, ((r[0], r[1], r[4]) for r in read(spark, tmp_path, part)))) == sorted(map(repr, want))


def test_one_row_changes_no_rules_for_others(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\nb"x,1\n"c"d,2\nr\rs,3\n')
    alone = read(spark, tmp_path / "a.csv")
    (tmp_path / "b.csv").write_text('a,b\nb"x,1\n"c"d,2\nr\rs,3\n"p\nq",4\n')
    assert [r[4] for r in alone] == ["bare quote in a value"] * 2 + [None] and alone[2][:2] == ("r\rs", "3")
    assert read(spark, tmp_path / "b.csv") == [*alone, ("p\nq", "4", None, None, None)]


def test_scrub_works_inside_quoted_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\r\n"Acme "v likvidaci"",1\r\n"two\r\n "v likvidaci"",2\r\n')
    assert read(spark, tmp_path / "a.csv", scrub=True) == [("Acme (v likvidaci)", "1", None, None, None), ("two\n (v likvidaci)", "2", None, None, None)]


def test_values_over_many_parts_and_long_ones(spark, tmp_path):
    text = 'a,b\n1,"' + "\n".join(f"line {i}" for i in range(300)) + '"\n2,x\n3,"' + "y" * 300_000 + '""z"\n' + ",".join(["w"] * 20_000) + "\n"
    (tmp_path / "a.csv").write_text(text)
    for part in ("128m", "4k"):
        got = sorted(read(spark, tmp_path / "a.csv", part))
        assert [r[0] for r in got] == ["1", "2", "3", "w"] and len(got[0][1].split("\n")) == 300 and len(got[2][1]) == 300_002 and not any(r[4] for r in got)


def test_large_files_with_quoted_line_ends_are_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n" + "".join(f'{i},"x\n\n{i}"\n' for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = csv.read_csv(spark, str(tmp_path / "a.csv"), csv.CsvOptions(), ["a", "b"])
        assert df.rdd.getNumPartitions() > 6
        assert sorted(tuple(r) for r in df.collect()) == sorted((str(i), f"x\n\n{i}", None) for i in range(20_000))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
        with pytest.raises(Exception, match="split in other places"):
            csv.read_csv(spark, str(tmp_path / "a.csv"), csv.CsvOptions(), ["a", "b"]).count(), df.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_states_are_those_of_a_walk():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 50):
        out, in_ = rnd.integers(0, 2, (2, n)).astype(bool)
        for start in (False, True):
            walk = [start]
            for a, b in zip(out, in_):
                walk.append(bool(b if walk[-1] else a))
            assert quotes.states(out, in_, start).tolist() == walk
