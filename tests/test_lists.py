"""Lists that are loaded again, and lines that do not fit."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from canvass.operators.suppression import base_list, holders_of_policies, list_validation
from canvass.sources.lists import INSURED_LIST, SuppressionStore, read_list, rejected_lines
from tests.conftest import rows

PAIR = StructType([StructField("insured_code", StringType()), StructField("n", IntegerType())])


def listed(spark, *pairs):
    return spark.createDataFrame(list(pairs), "insured_code string, source string")


def test_a_list_loaded_twice_is_there_once(spark, tmp_path):
    store = SuppressionStore(spark, f"file:{tmp_path}/s")
    assert rows(store.read()) == []
    assert store.load(listed(spark, ("C1", "A1"), ("C1", "A1"), ("C2", "A1"), ("C9", "B1"))) == ["A1", "B1"]
    assert store.load(listed(spark, ("C1", "A1"), ("C1", "A1"), ("C2", "A1"))) == ["A1"]
    later = SuppressionStore(spark.newSession(), f"file:{tmp_path}/s")       # another session, another list
    later.load(listed(spark, ("C3", "H")))
    want = [("C1", "A1"), ("C1", "A1"), ("C2", "A1"), ("C3", "H"), ("C9", "B1")]
    assert rows(store.read()) == want == rows(later.read())
    assert rows(list_validation(store.read())) == [("A1", 3), ("B1", 1), ("H", 1)]
    store.load(listed(spark, ("C7", "A1")))                                   # corrected: the old rows go
    assert rows(store.read()) == [("C3", "H"), ("C7", "A1"), ("C9", "B1")]


def test_a_list_that_comes_back_empty_is_emptied(spark, tmp_path):
    store = SuppressionStore(spark, f"file:{tmp_path}/s")
    odd = "B 1/x=%"
    store.load(listed(spark, ("C1", "A1"), ("C2", odd), ("C3", "007"), (None, "G1"), ("C4", None)))
    assert rows(store.read()) == [(None, "G1"), ("C1", "A1"), ("C2", odd), ("C3", "007"), ("C4", None)]
    store.load(listed(spark).limit(0), sources=[odd, "never loaded"])
    assert rows(store.read()) == [(None, "G1"), ("C1", "A1"), ("C3", "007"), ("C4", None)]
    store.load(listed(spark).limit(0))                                        # no names given: nothing changes
    assert store.read().count() == 4


def test_a_load_that_fails_changes_nothing(spark, tmp_path):
    store = SuppressionStore(spark, f"file:{tmp_path}/s")
    store.load(listed(spark, ("C1", "A1")))
    with pytest.raises(Exception, match="lost"):
        store.load(listed(spark, ("C2", "A1")).withColumn("insured_code", F.raise_error(F.lit("lost")).cast("string")))
    assert rows(store.read()) == [("C1", "A1")]


def test_lists_by_policy_are_resolved_and_replaced(spark, tmp_path):
    store = SuppressionStore(spark, f"file:{tmp_path}/s")
    header = spark.createDataFrame([("P1", "C1"), ("P1", "C1"), ("P2", "C2")], "policy_no string, insured_code string")
    by_policy = spark.createDataFrame([(" P1 ", "G1"), ("P9", "G2")], "policy_no string, source string")
    assert store.load(holders_of_policies(by_policy, header), sources=["G1", "G2"]) == ["G1"]
    store.load(base_list(listed(spark, ("C5 ", "A1"))))
    assert rows(store.read()) == [("C1", "G1"), ("C5 ", "A1")]


def test_bad_lines_are_told_by_file_and_number(spark, tmp_path):
    (tmp_path / "A1.csv").write_text("insured_code,n\nC1 ,1\n\nC2\nC3,x\n  \n\"C4\",4\nC5,5,5\n,\n")
    (tmp_path / "B2.csv").write_text("insured_code,n\n")
    (tmp_path / "C3.csv").write_text("")
    (tmp_path / "D4.csv").write_text("wrong\nC6,6")
    paths = f"file:{tmp_path}/*.csv"
    good = read_list(spark, paths, PAIR, skip_bad=True)
    assert rows(good) == [(None, None, "A1"), ("C1", 1, "A1"), ("C4", 4, "A1"), ("C6", 6, "D4")]
    assert good.count() == 4 and good.select("source").distinct().count() == 2     # columns of bad lines are not pruned away
    bad = rejected_lines(spark, paths, PAIR)
    assert rows(bad, "source", "line_no", "line") == [("A1", 4, "C2"), ("A1", 5, "C3,x"), ("A1", 8, "C5,5,5")]
    assert all(r.file.endswith("/A1.csv") for r in bad.collect())
    assert rows(rejected_lines(spark, paths, PAIR, header=False), "source", "line_no") == [("A1", 1), ("A1", 4), ("A1", 5), ("A1", 8), ("B2", 1), ("D4", 1)]
    with pytest.raises(Exception, match="[Mm]alformed|MALFORMED"):
        read_list(spark, paths, PAIR).collect()


def test_line_numbers_of_files_read_in_many_splits(spark, tmp_path):
    lines = ["insured_code"] + [f"C{i},extra" if i % 50 == 0 else f"C{i}" for i in range(1, 3000)]
    (tmp_path / "A1.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "B1.csv").write_text("\n".join(lines[:500]) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        bad = rejected_lines(spark, f"file:{tmp_path}", INSURED_LIST)
        assert spark.read.text(f"file:{tmp_path}").rdd.getNumPartitions() > 10
        got = rows(bad, "source", "line_no", "line")
        good = read_list(spark, f"file:{tmp_path}", INSURED_LIST, skip_bad=True).count()
    finally:
        spark.conf.set(key, before)
    want = [(s, n, x) for s, some in (("A1", lines), ("B1", lines[:500])) for n, x in enumerate(some, 1) if "," in x]
    assert got == want and good == len(lines) + 500 - 2 - len(want)


def test_command_line_keeps_lists_and_tells_bad_lines(spark, tmp_path, capsys):
    import json

    from canvass.__main__ import main
    from canvass.sources.fixtures import FixtureWarehouse
    from tests.conftest import SF_SMALL
    FixtureWarehouse(spark, SF_SMALL).land(f"{tmp_path}/wh")
    for folder, name, text in [("insured", "A1", "insured_code\nC0000001\nC0000002,x\n"), ("insured", "B1", "insured_code\nC0000003\n"),
                               ("policy", "G1", "policy_no\n"), ("email", "H", "email\nnobody@x.y\n"), ("bad_email", "bad", "bad_email\n")]:
        (tmp_path / "lists" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "lists" / folder / f"{name}.csv").write_text(text)
    SuppressionStore(spark, f"{tmp_path}/kept").load(listed(spark, ("C0000009", "A1"), ("C0000004", "Z9")))
    args = ["--warehouse", f"{tmp_path}/wh", "--lists", f"{tmp_path}/lists", "--skip-bad-lines", "--list-store", f"{tmp_path}/kept",
            "--out", f"{tmp_path}/out", "--n-main", "20", "--n-new", "5"]
    main(args)
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rows(spark.read.parquet(f"{tmp_path}/out/rejected"), "folder", "line_no", "line") == [("insured", 3, "C0000002,x")]
    assert rows(spark.read.parquet(f"{tmp_path}/out/stages/nps_scrubber")) == [("C0000001", "A1"), ("C0000003", "B1"), ("C0000004", "Z9")]
    main(args)
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == first
