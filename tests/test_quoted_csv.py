"""CSV with quoted line breaks in ranges, against Spark's reader of whole files."""

import random

import pytest

from lakeworks.schemas import schema
from lakeworks.sources import files, quoted_csv

WIDE = schema(a="long", b="string", c="string", _corrupt_record="string")


def write(path, name, rows, encoding="utf-8"):
    from pathlib import Path

    Path(path).mkdir(parents=True, exist_ok=True)
    (Path(path) / name).write_bytes("".join(rows).encode(encoding))


def value(rng, escape, accents):
    bits = ["x", "word ", ",", "\n", "\n\n", escape + '"', "'", ";"] + (["\\"] if escape == '"' else []) + (["ã", "é"] if accents else [])
    text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
    return f'"{text}"' if rng.random() < 0.8 else rng.choice(["plain", "", "it's"])


def made(seed, n, escape='"', accents=True, broken=0.05):
    """A header and rows; some are short, some are no numbers."""
    rng, rows = random.Random(seed), ["a,b,c\n"]
    for i in range(n):
        row = [str(i) if rng.random() > broken else f"{i}x", value(rng, escape, accents), value(rng, escape, accents)]
        rows.append(",".join(row[: 2 if rng.random() < broken else 3]) + "\n")
    return rows


def both(spark, path, small=700, **options):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(small))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        options = {"columnNameOfCorruptRecord": "_corrupt_record", **options}
        mine = quoted_csv.read_quoted_csv(spark, path, WIDE, **options).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = files.read_csv(spark, path, WIDE, multiLine=True, **options).collect()
    return sorted(map(str, mine)), sorted(map(str, whole))


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
@pytest.mark.parametrize("escape", ['"', "\\"])
def test_like_the_whole_file(spark, path, encoding, escape):
    where = path("quoted")
    for k in range(4):
        write(where, f"{k}.csv", made(k, 300 if k else 0, escape), encoding)
    mine, whole = both(spark, where, encoding=encoding, escape=escape, quote='"')
    assert mine == whole and len(mine) == 900


def test_values_over_many_ranges(spark, path):
    """One value fills many ranges; the next opens where it ends; the last is never closed."""
    where = path("quoted")
    long = '"' + "line, with things\n" * 400 + '"'
    write(where, "a.csv", ["a,b,c\n", f"1,{long},x\n", f'2,"",{long}\n', "3,y,z\n"])
    write(where, "b.csv", [f'a,"b\n{"x" * 50}\n",c\n', "4,y,z\n", '5,"open\nto the end'])
    write(where, "c.csv", ["\n\na,b,c\n\n", "6,y,z\n\n", "7,y,z"])
    mine, whole = both(spark, where, 100, escape='"')
    assert mine == whole and len(mine) == 7


def test_quotes_inside_plain_values(spark, path):
    """A quote opens a value only where the value begins; the parity of all quotes would be wrong."""
    where = path("quoted")
    rows = ["a,b,c\n"] + [f'{i},5" pipe,"x\n{i}"\n' if i % 3 else f'{i},"a"b,z"\n' for i in range(400)]
    write(where, "a.csv", rows)
    mine, whole = both(spark, where, 300, escape='"')
    assert mine == whole and len(mine) == 400


def test_line_ends_of_two_bytes(spark, path):
    where = path("quoted")
    write(where, "a.csv", ["a,b,c\r\n"] + [f'{i},"x{i}",z\r\n' for i in range(200)])
    mine, whole = both(spark, where, 200, escape='"')
    assert mine == whole and len(mine) == 200


@pytest.mark.parametrize("few", [0, 100_000])
def test_ranges_are_tasks(spark, path, monkeypatch, few):
    """A large file is read in many tasks, by either join."""
    monkeypatch.setattr(quoted_csv, "FEW", few)
    where = path("quoted")
    write(where, "a.csv", made(9, 3000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(where, lineSep="\n").rdd.getNumPartitions() > 8
        found = quoted_csv.read_quoted_csv(spark, where, WIDE, escape='"', columnNameOfCorruptRecord="_corrupt_record").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = files.read_csv(spark, where, WIDE, multiLine=True, escape='"', columnNameOfCorruptRecord="_corrupt_record").collect()
    assert sorted(map(str, found)) == sorted(map(str, whole)) and len(found) == 3000


def test_modes_and_refusals(spark, path):
    where = path("quoted")
    write(where, "a.csv", ["a,b,c\n", '1,"x\ny",z\n', '2x,"x\ny",z\n'])
    kept = quoted_csv.read_quoted_csv(spark, where, schema(a="long", b="string", c="string"), mode="DROPMALFORMED").collect()
    assert [tuple(r) for r in kept] == [(1, "x\ny", "z")]
    with pytest.raises(ValueError):
        quoted_csv.read_quoted_csv(spark, where, WIDE, encoding="UTF-16")
    assert not quoted_csv.fits({"sep": "||"}) and not quoted_csv.fits({"comment": "#"}) and quoted_csv.fits({})
    write(empty := path("none"), "a.csv", [])
    assert quoted_csv.read_quoted_csv(spark, empty, WIDE).count() == 0
