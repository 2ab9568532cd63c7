"""Files with quoted newlines and JSON arrays, read by many tasks, against Spark's
reader of whole files."""

from __future__ import annotations

import json
import random
from contextlib import contextmanager

import pytest
from pyspark.testing import assertDataFrameEqual

from tallyspark.sources import files

SCHEMA = "a string, b string, c string"


@contextmanager
def blocks_of(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def value(rng):
    kind = rng.random()
    if kind < 0.45:
        text = "".join(rng.choice(["x", "é", ",", "\n", '""', " ", "long " * 9]) for _ in range(rng.randint(0, 8)))
        return f'"{text}"'
    if kind < 0.55:
        return f'{rng.choice("xyz")}{rng.choice(["5\"", "\" \"", "\"\""])}tail'  # quotes inside an unquoted value
    if kind < 0.6:
        return '"shut"after'
    return "".join(rng.choice("abc é") for _ in range(rng.randint(0, 6)))


@pytest.mark.parametrize("seed", range(3))
def test_csv_equals_the_reader_of_whole_files(spark, tmp_path, seed):
    rng = random.Random(seed)
    for n in range(3):
        lines = ["a,b,c"]
        for _ in range(rng.choice([0, 1, 30])):
            lines.append(",".join(value(rng) for _ in range(rng.choice([3, 3, 3, 2, 4]))))
            if rng.random() < 0.1:
                lines.append("")
        end = rng.choice(["\n", "\r\n"])
        text = "\n".join(lines) + (rng.choice(["", "\n"]) if end == "\n" else "\n")
        (tmp_path / f"{n}.csv").write_bytes(text.replace("\n", end).encode("latin-1"))
    read = lambda **more: files.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, encoding="latin1",
                                         corrupt_column="bad", **more)
    want = sorted_rows(read())
    for size in (50, 1 << 20):
        with blocks_of(spark, size):
            assert sorted_rows(read(split=True)) == want


def test_a_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [(str(i), f'line "{i}",\nsecond line' * (i % 4), "é") for i in range(3000)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("escape", '"').option("header", True).csv(
        str(tmp_path / "one"))
    with blocks_of(spark, 8192):
        df = files.read_csv(spark, str(tmp_path / "one"), SCHEMA, multi_line=True, split=True)
        assert df.rdd.getNumPartitions() > 8
        assert files.read_csv(spark, str(tmp_path / "one"), SCHEMA, multi_line=True).rdd.getNumPartitions() == 1
        assertDataFrameEqual(df, files.read_csv(spark, str(tmp_path / "one"), SCHEMA, multi_line=True))


def test_csv_values_that_span_many_blocks_and_open_quotes(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,c\n1,"' + "x,\n" * 200 + '",2\n3,4,5\n6,"open,\n7,8,9\n')
    read = lambda **more: files.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, **more)
    with blocks_of(spark, 128):
        got = [tuple(x and x.rstrip("\n") for x in row) for row in sorted_rows(read(split=True))]
        want = [tuple(x and x.rstrip("\n") for x in row) for row in sorted_rows(read())]
        assert got == want


def test_csv_header_and_separator(spark, tmp_path):
    (tmp_path / "1.csv").write_text('\n"the\nkey";n;more\nk1;7;"x;\ny"\nk2;seven;\n')
    read = lambda **more: files.read_csv(spark, str(tmp_path), "n int, `the\nkey` string", multi_line=True,
                                         sep=";", corrupt_column="bad", **more)
    with blocks_of(spark, 16):
        assert sorted_rows(read(split=True)) == sorted_rows(read())
    (tmp_path / "2.csv").write_text('n;"the\nkey";more\n1;k3;\n')
    with pytest.raises(Exception, match="header"):
        read(split=True).collect()
    (tmp_path / "3.csv").write_text("")
    without = files.read_csv(spark, str(tmp_path / "1.csv"), "x string, y string, z string", header=False,
                             multi_line=True, split=True, sep=";")
    assert without.count() == 3
    with pytest.raises(ValueError, match="schema"):
        files.read_csv(spark, str(tmp_path), multi_line=True, split=True)
    with pytest.raises(ValueError, match="doubled quotes"):
        files.read_csv(spark, str(tmp_path / "1.csv"), "n int", multi_line=True, split=True, sep=";", comment="#")


JSON_SCHEMA = "id bigint, text string, deep struct<x:array<struct<y:string>>,z:string>, nothing string"


def element(rng, i):
    text = "".join(rng.choice(["}", "{", "[", "]", '"', "\\", ",", "\n", "é", "x" * 20]) for _ in range(rng.randint(0, 6)))
    return {"id": i, "text": text, "nothing": None,
            "deep": {"x": [{"y": text[:k]} for k in range(rng.randint(0, 3))], "z": "]}"}}


@pytest.mark.parametrize("seed", range(3))
def test_json_equals_the_reader_of_whole_files(spark, tmp_path, seed):
    rng = random.Random(seed)
    for n in range(4):
        rows = [element(rng, 100 * n + i) for i in range(rng.choice([0, 1, 25]))]
        text = json.dumps(rows, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{n}.json").write_text(rng.choice(["", "\n "]) + text + rng.choice(["", "\n"]))
    (tmp_path / "object.json").write_text(json.dumps(element(rng, -1), indent=1))
    read = lambda **more: files.read_json(spark, str(tmp_path), JSON_SCHEMA, multi_line=True, **more)
    want = sorted_rows(read())
    for size in (150, 1 << 20):
        with blocks_of(spark, size):
            got = read(split=True)
            assert sorted_rows(got) == want
            if size == 150:
                assert got.rdd.getNumPartitions() > 8


def test_broken_elements_and_files_spoil_only_themselves(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"id": 1}, {"id": oops}, {"id": 3}]')
    (tmp_path / "2.json").write_text('[{"id": 4},\n{"id": 5}, {"id": 6')
    (tmp_path / "3.json").write_text('[{"id": 7},\n{"id": 8, "deep": {"z": "q"')
    for size in (6, 1 << 20):
        with blocks_of(spark, size):
            df = files.read_json(spark, str(tmp_path), JSON_SCHEMA, multi_line=True, corrupt_column="bad", split=True)
            rows = df.select("id", "bad").collect()
        assert {r.id for r in rows if r.bad is None} == {1, 3, 4, 5, 7}
        assert len([r for r in rows if r.bad is not None]) == 3
