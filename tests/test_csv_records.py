"""CSV files read by many tasks against Spark's own one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from civgraph.sources import csv_records as R
from civgraph.sources.blocks import pieces, with_start
from civgraph.sources.contracts import CONTRACTS, Contract
from civgraph.sources.readers import read_csv, read_csv_lines, read_raw


@pytest.fixture
def splits(spark):
    """Sets the bytes of a split; at the end the old settings are back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    old = {n: spark.conf.get(n) for n in names}

    def to(size, batch=7):
        for n, v in zip(names, (size, size, batch)):
            spark.conf.set(n, str(v))
    yield to
    for n, v in old.items():
        spark.conf.set(n, v)


def field(r):
    words = ["", "a", "é€", "x y", " lead", "1,5", 'say "hi"', "two\nlines", "cr\r\nlf", ";", ',";\n"', '"', '""', "\n", "tail\n"]
    return "".join(r.choice(words) for _ in range(r.randrange(3)))


def quoted(v, r, sep):
    if any(c in v for c in '"\r\n' + sep) or r.random() < 0.2:
        return '"' + v.replace('"', '""') + '"'
    return v


def write(path, r, header, n, sep=";", end="\n", encoding="utf-8", before=""):
    text = before + sep.join(header) + end
    for i in range(n):
        row = [str(i), *(quoted(field(r), r, sep) for _ in header[1:])]
        text += sep.join(row) + end + (end if r.random() < 0.05 else "")
    if r.random() < 0.5:
        text = text.removesuffix(end)
    path.write_bytes(text.encode(encoding, "replace"))


def plain(spark, files, sep=";", encoding="UTF-8"):
    return spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("quote", '"').option(
        "escape", '"').option("multiLine", True).option("mode", "FAILFAST").csv(files)


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


@pytest.mark.parametrize("size", [61, 10**6])
def test_equals_the_one_task_reader(spark, tmp_path, splits, size):
    r = random.Random(size)
    for k, (end, encoding) in enumerate([("\n", "UTF-8"), ("\r\n", "UTF-8"), ("\n", "ISO-8859-1")]):
        path = tmp_path / f"f{k}.csv"
        write(path, r, ["id", "b", "c d", "e"], 30, end=end, encoding=encoding)
        splits(10**9)
        want = rows(plain(spark, str(path), encoding=encoding))
        assert len(want) == 30
        splits(size)
        got = R.read_records(spark, [str(path)], ";", encoding)
        assert got.columns == ["id", "b", "c d", "e", "source_file_path"]
        assert rows(got.drop("source_file_path")) == want
        if size < 100:
            assert pieces(spark, [str(path)], "\n").rdd.getNumPartitions() > 8


def test_records_over_many_blocks(spark, tmp_path, splits):
    path = tmp_path / "long.csv"
    path.write_text('a,b\n1,"' + "line\n" * 60 + '"\n2,x\n3,"open ""still\n\n\nopen"""\n4,y\n')
    splits(13)
    assert rows(R.read_records(spark, [str(path)], ",").select("a", "b")) == [
        ("1", "line\n" * 60), ("2", "x"), ("3", 'open "still\n\n\nopen"'), ("4", "y")]


def test_stray_quotes_do_not_open_a_value(spark, tmp_path, splits):
    path = tmp_path / "stray.csv"
    path.write_text('a;b\n5" pipe;x\nin 3"4;"q\n;r"\n"ab"c;d\n')
    splits(10**9)
    want = rows(plain(spark, str(path)))
    splits(9)
    assert rows(R.read_records(spark, [str(path)], ";").drop("source_file_path")) == want and len(want) == 3


@pytest.mark.parametrize("size", [8, 10**6])
def test_a_header_with_a_line_break(spark, tmp_path, splits, size):
    path = tmp_path / "head.csv"
    path.write_bytes(b'\xef\xbb\xbf"amount\n(euro)";b\n\n1;2\n')
    splits(size)
    got = R.read_records(spark, [str(path)], ";")
    assert got.columns[:2] == ["amount\n(euro)", "b"] and rows(got.drop("source_file_path")) == [("1", "2")]


def test_short_and_long_records_fail(spark, tmp_path):
    for bad in ("1;2;3\n1;2\n", "1;2;3\n1;2;3;4\n"):
        path = tmp_path / "bad.csv"
        path.write_text("a;b;c\n" + bad)
        with pytest.raises(Exception):
            R.read_records(spark, [str(path)], ";").collect()


def test_no_header_and_unequal_headers(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n")
    for name in ("empty.csv", "blank.csv"):
        with pytest.raises(ValueError):
            R.read_records(spark, [str(tmp_path / name)], ";")
    (tmp_path / "a.csv").write_text("a;b\n1;2\n")
    (tmp_path / "b.csv").write_text("b;a\n3;4\n")
    both = [str(tmp_path / f) for f in ("a.csv", "b.csv", "empty.csv")]
    with pytest.raises(ValueError):
        R.read_records(spark, both, ";", one_header=True)
    assert rows(R.read_records(spark, both, ";").select("a", "b")) == [("1", "2"), ("4", "3")]


def test_many_files_of_two_headers_are_one_scan(spark, tmp_path):
    r = random.Random(2)
    for i in range(40):
        write(tmp_path / f"part{i:02d}.csv", r, ["id", "b", "c"] if i % 3 else ["id", "C", "extra", "b"], 5)
    files = [str(tmp_path / f"part{i:02d}.csv") for i in range(40)]
    got = R.read_records(spark, files, ";")
    assert {c.lower() for c in got.columns} == {"id", "b", "c", "extra", "source_file_path"}
    parts = [plain(spark, f) for f in files]
    want = parts[0]
    for p in parts[1:]:
        want = want.unionByName(p, allowMissingColumns=True)
    assert rows(got.select("id", "b", "c", "extra")) == rows(want.select("id", "b", "c", "extra"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") <= 2  # one, and one for records that span blocks if there are any


def test_preamble_before_quoted_line_breaks(spark, tmp_path, splits):
    c = CONTRACTS["agriculture_subvention"]
    path = tmp_path / "agriculture-subvention_2026.csv"
    path.write_bytes('Titre;"\nsous-titre\nNom;Objet;Montant\nA;"deux\nlignes; ""œ""";1\nB;x;2\n'.encode("cp1252"))
    for size in (30, 10**6):
        splits(size, 2)
        got = read_csv_lines(spark, c, str(path))
        assert rows(got.drop("source_file_path")) == [("A", 'deux\nlignes; "œ"', "1"), ("B", "x", "2")]
    splits(7)  # a preamble that is longer than a block is an error, not a shift
    with pytest.raises(ValueError):
        read_csv_lines(spark, c, str(path))
    splits(10**6)
    (tmp_path / "agriculture-subvention_2025.csv").write_text("one\ntwo\nNom;Objet;Montant\nC;z;3\n")
    assert read_raw(spark, str(tmp_path), "agriculture_subvention").count() == 3


def test_repaired_lines_then_records(spark, tmp_path, splits):
    c = CONTRACTS["anct_subvention_ville"]
    (tmp_path / "anct-subvention-ville-2019_2026.csv").write_bytes(
        ';;;\r\nNom;"""Objet""";Montant;Ville\r\nA;"""b""";1;"""c d"""\r\n;;;\r\n'.encode("cp1252"))
    (tmp_path / "anct-subvention-ville-2020_2026.csv").write_bytes("Ville;Nom;Objet;Montant\nÉvry;B;\"x\ny\";2\n".encode("cp1252"))
    for size in (10, 10**6):
        splits(size, 3)
        files = [str(tmp_path / f"anct-subvention-ville-{y}_2026.csv") for y in (2019, 2020)]
        got = rows(read_csv(spark, c, files).select("Nom", "Objet", "Montant", "Ville"))
        assert got == sorted([("A", "b", "1", "c d"), ("B", "x\ny", "2", "Évry"), (None,) * 4], key=repr)


def test_state_of_blocks(spark):
    r = random.Random(6)
    data, want = [], {}
    for f in ("x", "y"):
        state = False
        for b in range(40):
            out, ins = r.choice([(False, False), (True, True), (False, True), (True, False), (False, True)])
            data.append((f, b * 10, out, ins))
            want[f, b * 10] = state
            state = ins if state else out
    frame = spark.createDataFrame(data, "file_path string, block_start long, after_out boolean, after_in boolean").repartition(5)
    assert {(x.file_path, x.block_start): x.starts_in for x in with_start(frame).collect()} == want


def test_contract_without_line_breaks_stays_with_the_plain_reader(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1,2\n")
    got = read_csv(spark, Contract("x", "f.csv", multiline=False), [str(tmp_path / "f.csv")])
    assert rows(got.select("a", F.col("b"))) == [("1", "2")]
