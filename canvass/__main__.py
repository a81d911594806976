"""Run a whole survey pull: ``python -m canvass --warehouse ROOT --out DIR``.

Reads the warehouse tables (a parquet root with one folder per table, or a
catalog database), builds every stage as a parquet table under ``--out/stages``
(a run that was ended half-way is taken up there), exports both samples as CSV files with a header
(``--out/files``) and writes the funnel and every report (``--out/reports``).
Dates are month/day/year, as the pull writes them.
"""

from __future__ import annotations

import argparse
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.config import Config
from canvass.functions.dates import parse_report_date
from canvass.operators.household import MIN_POLICY
from canvass.operators.suppression import suppression_list
from canvass.plans import reports as R
from canvass.plans.pull import SurveyPull
from canvass.sources.lists import (
    BAD_EMAIL_LIST,
    EMAIL_LIST,
    INSURED_LIST,
    POLICY_LIST,
    SuppressionStore,
    export_sample,
    read_list,
    rejected_lines,
)
from canvass.sources.warehouse import Warehouse

STAGES = ["ah_inforce", "inforce_quarterly", "inforce_well_dw", "inforce_med_dw", "nps_f1", "nps_f1a",
          "nps_scrubber", "nps_f2", "nps_f2a", "nps_f3", "nps_f4", "nps_f4a"]


def report_frames(p: SurveyPull) -> dict:
    f1a, f2a, f3 = p.nps_f1a, p.nps_f2a, p.nps_f3
    return {
        "funnel": p.funnel(),
        "list_validation": p.list_validation,
        "species_by_stage": R.species_by_stage(f1a, f2a, f3),
        "term_by_stage": R.term_by_stage(f1a, f2a, f3),
        "top_states_pif": R.top_states_paid_in_full(f3, p.t["dw_policy_header"], p.dim("dw_dim_paymentplan"),
                                                    p.dim("dw_dim_payment_type"),
                                                    max_broadcast_bytes=p.config.broadcast_max_bytes),
        **{name: p.report(name) for name in R.REPORTS},
    }


LIST_FOLDERS = {"insured": ("nps_scrubber0", INSURED_LIST), "policy": ("nps_scrubber_policy", POLICY_LIST),
                "email": ("nps_scrubber_dnc", EMAIL_LIST), "bad_email": ("bad_email", BAD_EMAIL_LIST)}


def with_lists(spark: SparkSession, tables: Warehouse, root: str, skip_bad: bool = False) -> Warehouse:
    """``tables`` with the hand-loaded lists imported from the folders of ``root``
    (:data:`LIST_FOLDERS`, all four); the source is the file's name."""
    for folder, (table, schema) in LIST_FOLDERS.items():
        tables = tables.with_table(table, read_list(spark, f"{root.rstrip('/')}/{folder}/*", schema, skip_bad=skip_bad))
    return tables


def list_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The lines that :func:`with_lists` skips: ``folder, file, line_no, line, source``."""
    parts = [rejected_lines(spark, f"{root.rstrip('/')}/{folder}/*", schema).select(F.lit(folder).alias("folder"), "*")
             for folder, (_, schema) in LIST_FOLDERS.items()]
    return reduce(DataFrame.unionByName, parts)


def with_kept_lists(spark: SparkSession, tables: Warehouse, store: str) -> Warehouse:
    """``tables`` with the suppression list kept at ``store``, after the lists of ``tables`` are
    loaded there: each replaces its own source, lists loaded before stay."""
    kept = SuppressionStore(spark, store)
    lists = [tables[name] for name in ("nps_scrubber0", "nps_scrubber_policy", "nps_scrubber_dnc")]
    names = {r["source"] for df in lists for r in df.select("source").distinct().collect() if r["source"]}   # one row per list
    kept.load(suppression_list(*lists, tables["dw_policy_header"], tables["dw_dim_insured"]), sorted(names))
    return tables.with_table("nps_scrubber", kept.read())


#: Stages that are parts of a stored one: the stored stage, and the part as SQL.
VIEWS = {
    "inforce_well_dw": ("claim_rollups", "policy_no, vrcccount, well_claimedamount AS claimamount, well_paidamount AS paidamount, "
                                         "well_eligibleamount AS eligibleamount FROM {0} WHERE well_groups > 0"),
    "inforce_med_dw": ("claim_rollups", "policy_no, medcount, med_claimedamount AS claimamount, med_paidamount AS paidamount, "
                                        "med_eligibleamount AS eligibleamount FROM {0} WHERE medcount > 0"),
    "nps_f1": ("nps_f1", f"* EXCEPT ({MIN_POLICY}) FROM {{0}}"),
}


def register_stages(p: SurveyPull, database: str) -> None:
    """Name every stage in ``database``: a table over the folder that the pull has
    written, or a view of its part of one.  No row is copied."""
    p.prepare()
    spark = p.spark
    for name in [s for s in STAGES if s not in VIEWS] + sorted({stored for stored, _ in VIEWS.values()}):
        table = f"{database}.{name}_stored" if name in VIEWS else f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=p.store.path(name), source="parquet")
    for view, (name, part) in VIEWS.items():
        table = f"{database}.{name}_stored" if name in VIEWS else f"{database}.{name}"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT {part.format(table)}")


def run(spark: SparkSession, tables: Warehouse, config: Config, out: str,
        populations: tuple[str, ...] = (), database: str | None = None) -> dict:
    """Build the pull and write stages, sample files and reports under ``out``.

    ``populations`` (any of F1A, F2, F2A, F3) additionally writes every
    single-population report for each of them under ``reports/by_population``.
    The pull writes each stage once, to its folder under ``out/stages``; a run
    that was ended half-way is taken up there by the next one with the same
    parameters and input files.  ``database`` also names the stages as tables
    and views of that database.
    """
    out = out.rstrip("/")
    p = SurveyPull(spark, tables, config, run_dir=f"{out}/stages").prepare()
    if database:
        register_stages(p, database)
    export_sample(p.nps_f3, f"{out}/files/sample_main", single_file=True)
    export_sample(p.nps_f4a, f"{out}/files/sample_new_policies", single_file=True)
    for name, df in report_frames(p).items():
        df.write.mode("overwrite").parquet(f"{out}/reports/{name}")
    for label in populations:
        for name in R.REPORTS:
            p.report(name, label).write.mode("overwrite").parquet(f"{out}/reports/by_population/{label}/{name}")
    return {r["stage"]: r["row_count"] for r in spark.read.parquet(f"{out}/reports/funnel").collect()}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m canvass", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--warehouse", help="parquet root with one folder per table")
    src.add_argument("--database", help="catalog database holding the tables")
    ap.add_argument("--lists", help="folder with the lists as delimited files, read instead of the warehouse's: "
                                    "insured/, policy/, email/, bad_email/ with one file per source (A1.csv, G1.csv, H.csv)")
    ap.add_argument("--skip-bad-lines", action="store_true", help="leave out lines of the lists that do not fit, and write them "
                                                                  "with file and line number to --out/rejected")
    ap.add_argument("--list-store", help="folder that keeps the suppression list over many runs: each list given replaces "
                                         "what was loaded under its name")
    ap.add_argument("--out", required=True)
    ap.add_argument("--report-date", default="02/28/2013", help="month/day/year")
    ap.add_argument("--as-of", default="03/01/2013", help="month/day/year")
    ap.add_argument("--n-main", type=int, default=Config.n_main)
    ap.add_argument("--n-new", type=int, default=Config.n_new)
    ap.add_argument("--seed", type=int, default=Config.seed)
    ap.add_argument("--stage-database", help="also name the stages as tables and views of this database")
    ap.add_argument("--populations", default="", help="also run every single-population report on these stages, "
                                                       "e.g. F1A,F2,F3")
    args = ap.parse_args(argv)
    populations = tuple(x.strip().upper() for x in args.populations.split(",") if x.strip())
    unknown = [x for x in populations if x not in R.POPULATIONS]
    if unknown:
        ap.error(f"unknown population(s) {unknown}; choose from {sorted(R.POPULATIONS)}")

    spark = SparkSession.builder.appName("canvass").getOrCreate()
    tables = (Warehouse.from_parquet(spark, args.warehouse) if args.warehouse
              else Warehouse.from_catalog(spark, args.database))
    if args.lists:
        tables = with_lists(spark, tables, args.lists, args.skip_bad_lines)
        if args.skip_bad_lines:
            list_rejects(spark, args.lists).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/rejected")
    if args.list_store:
        tables = with_kept_lists(spark, tables, args.list_store)
    config = Config(report_date=parse_report_date(args.report_date), as_of=parse_report_date(args.as_of),
                    n_main=args.n_main, n_new=args.n_new, seed=args.seed)
    print(json.dumps(run(spark, tables, config, args.out, populations, database=args.stage_database)))


if __name__ == "__main__":
    main()
