from pyspark.sql import types as T

from pledgeflow.schema import TABLES
from pledgeflow.sources.files import load_delimited, read_tables, write_table
from tests.data import PLEDGES, bag, rows, table

PAIR = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.IntegerType(), False)])


def test_delimited_text_ends_at_its_marker(spark, tmp_path):
    (tmp_path / "test.txt").write_text("1,10\n2,20\n3,30\n4,40\n\\.\n")
    got = load_delimited(spark, str(tmp_path / "test.txt"), PAIR)
    assert rows(got, "a", "b", "reason") == [(n, n * 10, None) for n in range(1, 5)]


def test_bad_lines_are_kept_with_a_reason(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("1,\nx,2\n3,30\n5|50\n")
    got = bag(load_delimited(spark, str(tmp_path / "bad.txt"), PAIR), "line", "a", "b", "reason")
    assert got == sorted([
        ("1,", 1, None, "null value in column b"), ("x,2", None, 2, "malformed line"),
        ("3,30", 3, 30, None), ("5|50", None, None, "malformed line"),
    ], key=repr)
    (tmp_path / "bar.txt").write_text("5|50\n")
    assert rows(load_delimited(spark, str(tmp_path / "bar.txt"), PAIR, sep="|"), "a", "b") == [(5, 50)]


def test_tables_round_trip(spark, tmp_path):
    backs = table(spark, "backs", PLEDGES)
    write_table(backs.select(*reversed(backs.columns)), str(tmp_path), "backs")
    back = read_tables(spark, str(tmp_path), ["backs"])["backs"]
    assert back.columns == TABLES["backs"].schema.names
    assert bag(back) == bag(backs)


def test_what_stands_behind_the_marker_is_not_loaded(spark, tmp_path):
    # two files of several splits each; only one of them has a marker, and lines behind it
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        one = [f"{n},{n * 10}" for n in range(3000)]
        one[1234], one[2000] = "x,1", "\\."
        (tmp_path / "one.txt").write_text("\n".join(one))
        (tmp_path / "two.txt").write_text("".join(f"{n},7\n" for n in range(5000, 7000)) + "y,2\n")
        got = load_delimited(spark, str(tmp_path), PAIR)
        assert got.rdd.getNumPartitions() > 1
        found = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    good = sorted((r["a"], r["b"]) for r in found if r["reason"] is None)
    assert good == [(n, n * 10) for n in range(2000) if n != 1234] + [(n, 7) for n in range(5000, 7000)]
    bad = sorted((r["file"].rsplit("/")[-1], r["line_number"], r["line"], r["reason"]) for r in found if r["reason"])
    assert bad == [("one.txt", 1235, "x,1", "malformed line"), ("two.txt", 2001, "y,2", "malformed line")]
    numbers = sorted(r["line_number"] for r in found if r["file"].endswith("two.txt"))
    assert numbers == list(range(1, 2002))


def test_lines_of_empty_and_missing_ends(spark, tmp_path):
    for name, text in (("a.txt", ""), ("b.txt", "\\.\n1,1\n"), ("c.txt", "1,2")):
        (tmp_path / name).write_text(text)
    assert rows(load_delimited(spark, str(tmp_path), PAIR), "a", "b", "line_number") == [(1, 2, 1)]
