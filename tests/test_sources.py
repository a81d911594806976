"""List files in, sample files out, the landed warehouse."""

import os

import pytest
import tempfile

from canvass.sources.fixtures import FixtureWarehouse
from canvass.sources.lists import INSURED_LIST, export_sample, read_list
from canvass.sources.warehouse import DOMAIN_TABLES, Warehouse, read_jdbc
from tests.conftest import SF_SMALL, rows


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_read_list_tags_source_from_file_name(spark):
    d = tempfile.mkdtemp(prefix="lists-", dir="/tmp")
    _write(f"{d}/A1.csv", 'insured_code\nC0000001 \n"  "\nC0000002\n')
    _write(f"{d}/B2.csv", "insured_code\nC0000003\n")
    got = rows(read_list(spark, [f"{d}/A1.csv", f"{d}/B2.csv"], INSURED_LIST))
    assert got == [(None, "A1"), ("C0000001", "A1"), ("C0000002", "A1"), ("C0000003", "B2")]
    fixed = rows(read_list(spark, f"{d}/B2.csv", INSURED_LIST, source="G1"))
    assert fixed == [("C0000003", "G1")]


def test_export_sample_round_trip(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "policyid bigint, insured_email string")
    out = export_sample(df, os.path.join(tempfile.mkdtemp(prefix="export-", dir="/tmp"), "f3"), single_file=True)
    back = spark.read.option("header", True).schema("policyid bigint, insured_email string").csv(out)
    assert rows(back) == [(1, "a"), (2, None)]
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1


def test_landed_warehouse_equals_derived(spark):
    root = tempfile.mkdtemp(prefix="wh-", dir="/tmp")
    derived = FixtureWarehouse(spark, SF_SMALL)
    landed = FixtureWarehouse(spark, SF_SMALL).land(root)
    assert set(landed) == set(DOMAIN_TABLES)
    for name in ["dw_policy_header", "dw_claim_details", "dw_dim_insured", "vouchers_issued"]:
        a, b = derived[name], landed[name]
        assert a.schema.simpleString() == b.schema.simpleString()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_warehouse_table_replacement(spark):
    wh = Warehouse(spark, {"t": lambda: spark.range(3)})
    assert wh["t"].count() == 3
    assert wh.with_table("t", spark.range(5))["t"].count() == 5


def test_jdbc_partitioned_read_needs_bounds(spark):
    import pytest
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x", "t", partition_column="id")


def test_slices_of_a_skewed_key_hold_equal_parts(spark):
    from pyspark.sql import functions as F

    from canvass.sources.warehouse import key_slices
    i = F.col("id")
    # half of the rows below 100, a tenth in one value, the rest spread over a billion
    key = F.when(i < 5000, i % 100).when(i < 6000, F.lit(777)).when(i < 9900, i * 100_003).otherwise(F.lit(None))
    keys = spark.range(10_000).select(key.alias("k"))
    cuts = key_slices(keys, "k", 8)
    assert 8 <= len(cuts) <= 16
    sizes = [keys.filter(c).count() for c in cuts]
    assert sum(sizes) == 10_000 and max(sizes) <= 2 * 10_000 / 8          # even ranges would put 6,000 rows into the first
    seen = [r["k"] for c in cuts for r in keys.filter(c).collect()]
    assert sorted(seen, key=lambda x: (x is None, x)) == sorted((r["k"] for r in keys.collect()), key=lambda x: (x is None, x))
    one = spark.range(3000).select(F.lit(5).alias("k"))                    # one value: nothing to cut
    assert sorted(one.filter(c).count() for c in key_slices(one, "k", 4))[-1] == 3000
    dates = spark.range(1000).select(F.date_add(F.lit("2013-01-01").cast("date"), (i % 30).cast("int")).alias("d"))
    parts = [dates.filter(c).count() for c in key_slices(dates, "d", 4)]
    assert sum(parts) == 1000 and max(parts) < 400
    assert key_slices(keys.limit(0), "k", 4) == ["1 = 1"] == key_slices(keys, "k", 1)
    with pytest.raises(TypeError, match="cannot cut"):
        key_slices(spark.createDataFrame([("a",)], "s string"), "s", 3)
    with pytest.raises(ValueError, match="not both"):
        read_jdbc(spark, "jdbc:none://x", "t", partition_column="k", predicates=cuts)


def test_command_line_run_writes_stages_files_and_reports(spark):
    from canvass.__main__ import main, run
    from canvass.config import FIXTURE_CONFIG
    base = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    FixtureWarehouse(spark, SF_SMALL).land(f"{base}/wh")
    funnel = run(spark, Warehouse.from_parquet(spark, f"{base}/wh"), FIXTURE_CONFIG, f"{base}/out",
                 populations=("F1A", "F2"))
    assert funnel["nps_f3"] == FIXTURE_CONFIG.n_main
    assert len(os.listdir(f"{base}/out/reports")) == 19          # 18 reports + by_population
    assert sorted(os.listdir(f"{base}/out/reports/by_population")) == ["F1A", "F2"]
    assert len(os.listdir(f"{base}/out/reports/by_population/F2")) == 13
    sample = spark.read.option("header", True).csv(f"{base}/out/files/sample_main")
    assert sample.count() == FIXTURE_CONFIG.n_main
    with pytest.raises(SystemExit):       # a warehouse source is required
        main(["--out", base])


def test_command_line_main(spark, capsys):
    import json

    from canvass.__main__ import main
    base = tempfile.mkdtemp(prefix="cli-main-", dir="/tmp")
    FixtureWarehouse(spark, SF_SMALL).land(f"{base}/wh")
    main(["--warehouse", f"{base}/wh", "--out", f"{base}/out", "--report-date", "02/28/2013",
          "--as-of", "03/01/2013", "--n-main", "20", "--n-new", "5", "--populations", "f3"])
    funnel = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert funnel["nps_f3"] == 20 and funnel["nps_f4a"] == 5
    assert os.path.isdir(f"{base}/out/reports/by_population/F3/species_mix")


def test_stages_named_in_a_catalog_are_not_copied(spark):
    from canvass.__main__ import STAGES, register_stages
    from canvass.plans.registry import pull_for
    loc = tempfile.mkdtemp(prefix="db-", dir="/tmp")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS canvass_stage_test LOCATION '{loc}'")
    p = pull_for(spark, SF_SMALL)
    register_stages(p, "canvass_stage_test")
    register_stages(p, "canvass_stage_test")
    saved = {r.tableName for r in spark.sql("SHOW TABLES IN canvass_stage_test").collect() if not r.isTemporary}
    assert saved == set(STAGES) | {"claim_rollups", "nps_f1_stored"}
    for name in STAGES:
        named, stage = spark.table(f"canvass_stage_test.{name}"), getattr(p, name)
        assert named.columns == stage.columns
        assert named.exceptAll(stage).count() == 0 and stage.exceptAll(named).count() == 0
    assert os.listdir(loc) == []        # the tables lie where the pull wrote them


def test_lists_of_a_folder_replace_the_warehouse_lists(spark, tmp_path):
    from canvass.__main__ import with_lists
    for folder, name, text in [("insured", "A1", "insured_code\nC1 \n C2\n"), ("insured", "D2", "insured_code\nC3\n"),
                               ("policy", "G1", "policy_no\n P9 \n"), ("email", "H", "email\nA@b.c\n\n"),
                               ("bad_email", "bad", "bad_email\nx@y.z\n")]:
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.csv").write_text(text)
    got = with_lists(spark, Warehouse(spark, {}), f"file:{tmp_path}")
    assert rows(got["nps_scrubber0"], "insured_code", "source") == [("C1", "A1"), ("C2", "A1"), ("C3", "D2")]
    assert rows(got["nps_scrubber_policy"], "policy_no", "source") == [("P9", "G1")]
    assert rows(got["nps_scrubber_dnc"], "email", "source") == [("A@b.c", "H")]
    assert rows(got["bad_email"], "bad_email") == [("x@y.z",)]


def test_export_keeps_blanks_and_uris(spark, tmp_path):
    df = spark.createDataFrame([(1, "  90001-1234"), (2, "x "), (3, None)], "id int, zip string")
    path = export_sample(df, f"file:{tmp_path}/out", single_file=True)
    assert path == f"file:{tmp_path}/out"
    assert rows(spark.read.schema(df.schema).option("header", True).csv(path)) == rows(df)


def test_entry_keeps_the_pull_without_an_optional_library():
    import subprocess
    import sys
    code = ("import sys, warnings; sys.modules['ahocorasick'] = None; warnings.simplefilter('ignore'); import __spark_entry__ as E; "
            "from canvass.plans.registry import QUERIES; assert set(QUERIES) == set(E.queries()) == set(E.oracle_sql())")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]


def test_tables_on_demand_are_those_landed_and_no_others(spark, tmp_path):
    made, derived = FixtureWarehouse(spark, SF_SMALL).on_demand(f"{tmp_path}/wh"), FixtureWarehouse(spark, SF_SMALL)
    names = made["dw_policy_header"].select("policyid", "policy_no")
    assert os.listdir(f"{tmp_path}/wh") == ["policy_head"]
    assert "Join" not in names._jdf.queryExecution().executedPlan().toString()   # no lines for a reader of none
    made["dw_claim_header"], made["dw_claim_details"]
    assert sorted(os.listdir(f"{tmp_path}/wh")) == ["claim_line", "policy_head"]
    for name in ("dw_policy_header", "dw_claim_header", "dw_claim_details", "dw_data_inforce", "policy_pets", "vouchers_issued", "nps_scrubber0"):
        a, b = made[name], derived[name]
        assert dict(a.dtypes) == dict(b.dtypes) and a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0


def test_claims_of_null_keys_have_one_header_row_each(spark):
    line = "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, l_tax double"
    keys = [(1, 1), (1, 1), (1, None), (None, 1), (None, 1), (None, None), (2, 1)]
    t = FixtureWarehouse(spark, SF_SMALL)
    t._frames["lineitem"] = spark.createDataFrame([(*k, "R", "F", i, 1, 10.0, 0.0, 0.0) for i, k in enumerate(keys)], line)
    header = t["dw_claim_header"]
    assert rows(header) == rows(t["claim_line"].selectExpr("l_orderkey", "claim_id", "concat('CL', claim_id)").distinct()) and header.count() == 5
    assert header.select("claim_id")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1   # the window's


def test_a_query_builds_only_the_stages_it_reads(spark, monkeypatch):
    from canvass.plans import registry
    monkeypatch.setattr(registry, "_PULLS", {})
    registry.QUERIES["q01_inforce_snapshot"](spark, SF_SMALL).count()
    (p,) = registry._PULLS.values()
    assert p.store.built == ["ah_inforce"]
    registry.QUERIES["q06_referral_counts"](spark, SF_SMALL).count()
    assert registry._PULLS and p.store.built == ["ah_inforce", "referrals"]
