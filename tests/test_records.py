import random

import pytest

from terrace.sources.delimited import read_delimited
from terrace.sources.records import read_records

COLUMNS = ["a", "b", "c"]


def in_blocks(spark, path, sep, size):
    """Rows of the split reader with blocks of about ``size`` bytes, and how many blocks it saw."""
    bytes_, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = spark.conf.get(bytes_), spark.conf.get(cost)
    spark.conf.set(bytes_, str(size))
    spark.conf.set(cost, "1")
    try:
        rows = [tuple(r) for r in read_records(spark, path, COLUMNS, sep).collect()]
        blocks = spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
        return sorted(rows, key=str), blocks
    finally:
        spark.conf.set(bytes_, old[0])
        spark.conf.set(cost, old[1])


def whole(spark, path, sep):
    return sorted((tuple(r) for r in read_delimited(spark, path, COLUMNS, sep, True).collect()), key=str)


def field(rng, sep, end):
    kind = rng.random()
    if kind < 0.15:
        return ""
    if kind < 0.5:
        return "".join(rng.choice('abé x"') for _ in range(rng.randint(1, 6))).lstrip('"') or "y"
    inner = "".join(rng.choice(["a", "b ", '""', end, sep, "é"]) for _ in range(rng.randint(0, 9)))
    return f'"{inner}"'


@pytest.mark.parametrize("sep", ["\t", "+|"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_files_read_like_whole_ones(spark, tmp_path, sep, end):
    rng = random.Random(sep + end)
    for n in range(2):
        rows = [sep.join(field(rng, sep, end) for _ in COLUMNS) for _ in range(40)]
        rows = [r if r.strip() else "z" for r in rows]
        (tmp_path / f"{n}.csv").write_bytes((end.join(rows) + end * (n > 0 or sep == "+|")).encode())
    rows, blocks = in_blocks(spark, str(tmp_path), sep, 100)
    assert blocks > 6
    assert rows == whole(spark, str(tmp_path), sep)


def test_a_record_longer_than_many_blocks(spark, tmp_path):
    inner = "\n".join(f'line {i} ""quoted"" \t' for i in range(120))
    (tmp_path / "t.csv").write_text(f'1\tx\ty\n2\t"{inner}"\tz\n\n3\t\t"one\ntwo"\n', encoding="utf-8")
    rows, blocks = in_blocks(spark, str(tmp_path / "t.csv"), "\t", 300)
    assert blocks > 7 and len(rows) == 3
    assert rows == whole(spark, str(tmp_path / "t.csv"), "\t")
    assert rows[1] == ("2", inner.replace('""', '"'), "z")


def test_awkward_files(spark, tmp_path):
    texts = [
        "",
        "\n\n",
        '1\t"open\nnever\tclosed',
        '2\tfive" pipe\tx\n3\t6"\ty\n',
        '"a"b\tc\td\n',
        "4\n5\tx\ty\tz\n",
        '"a" \tb\t"c" \n',
        '""\t""\t""\n6\t"""\n"""\t\n',
    ]
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.csv").write_text(text, encoding="utf-8")
    rows, blocks = in_blocks(spark, str(tmp_path), "\t", 5)
    assert blocks > len(texts)
    assert rows == whole(spark, str(tmp_path), "\t")
