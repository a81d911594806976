"""All reports over all populations from one pass.

The reports R3 to R8 and R10 to R16 count rows, or policies or policyholders
once each, by one or two labels; the script runs each of them on several
populations by changing the table name.  Here every population is read once,
reduced to the columns the reports need, and rows that agree in all of them
become one row with a count for each population.  Each such row then has one
entry for each report (:data:`REPORTS`), and two aggregations over all entries
give the cube: ``report, label_1, label_2`` and, for each population, its rows
and its different keys.

The distinct counts are exact.  The first aggregation leaves one row for each
report, label and key, with the rows each population has of it; the second
adds up the keys that a population has at all.  Entries of reports that count
rows have no key, so the first aggregation already reduces them to a row for
each label on every map task.

The cube has a few hundred rows, whatever the size of the populations (plus
one for each state and product).  :func:`report` and :func:`by_population`
read it instead of the populations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import amount_band, multipet_group, pets_topcoded, product_group, species_mix, term_group
from canvass.plans.reports import ordered

#: What the reports read of a population.
COLUMNS = ["insured_code", "policy_no", "total_pets", "dogs", "cats", "avian", "exoticothers", "min_term", "max_term", "baseproduct",
           "insured_state", "medicalclaimcount", "medicalclaimamount", "medicaleligibleamount", "medicalpaidamount",
           "welcareclaimcount", "welcareclaimamount", "welcareeligibleamount", "welcarepaidamount"]


@dataclass(frozen=True)
class Report:
    """One report: its labels (name and rule), the name of its count, the columns that the rules
    read, what it counts (a key once each; None: rows) and of which rows (None: all)."""

    labels: dict[str, Callable[[], Column]]
    value: str
    reads: tuple[str, ...]
    key: str | None = None
    where: Callable[[], Column] | None = None
    bounded: bool = field(default=True)


_MIX = ("total_pets", "dogs", "cats", "avian", "exoticothers")


def _several() -> Column:
    return F.col("total_pets") > 1


def _band(label: str, amount: str, count: str, above: bool = False) -> Report:
    """R10 to R15; the source's ``count >= 0`` is true of every count, wellness paid has ``> 0``."""
    return Report({label: lambda: amount_band(amount)}, "policy_count", (amount, count), "policy_no",
                  lambda: F.col(count) > 0 if above else F.col(count) >= 0)


REPORTS = {
    "multipet_households": Report({"multipet": lambda: multipet_group("total_pets")}, "tot_ph", ("total_pets",), "insured_code"),
    "species_mix": Report({"multi_pet": species_mix}, "ph", _MIX, where=_several),
    "mix_min_term": Report({"multi_pet": species_mix, "term_group": lambda: term_group("min_term")}, "ph", (*_MIX, "min_term"), where=_several),
    "mix_max_term": Report({"multi_pet": species_mix, "term_group": lambda: term_group("max_term")}, "ph", (*_MIX, "max_term"), where=_several),
    "product": Report({"baseproduct": lambda: product_group("baseproduct")}, "tot_pet", ("baseproduct",), bounded=False),
    "state": Report({"insured_state": lambda: F.col("insured_state")}, "tot_rows", ("insured_state",), bounded=False),
    "band_med_submitted": _band("submitted_group", "medicalclaimamount", "medicalclaimcount"),
    "band_med_eligible": _band("eligible_group", "medicaleligibleamount", "medicalclaimcount"),
    "band_med_paid": _band("reimbursement_grp", "medicalpaidamount", "medicalclaimcount"),
    "band_well_submitted": _band("well_submitted_group", "welcareclaimamount", "welcareclaimcount"),
    "band_well_eligible": _band("well_eligible_group", "welcareeligibleamount", "welcareclaimcount"),
    "band_well_paid": _band("well_reimbursement_grp", "welcarepaidamount", "welcareclaimcount", above=True),
    "pets_topcoded": Report({"total_pets": lambda: pets_topcoded("total_pets")}, "ph_count", ("total_pets",)),
}


def columns_of(reports: dict[str, Report]) -> list[str]:
    """What some of the reports read of a population."""
    read = {c for r in reports.values() for c in (*r.reads, r.key)}
    return [c for c in COLUMNS if c in read]


def report_cube(populations: dict[str, DataFrame], reports: dict[str, Report] = REPORTS) -> DataFrame:
    """``report, label_1, label_2`` with ``rows_<population>`` and ``keys_<population>``."""
    counts = [f"n_{name}" for name in populations]
    columns = columns_of(reports)
    tagged = [df.select(*columns, *[F.lit(int(name == mine)).cast("long").alias(f"n_{name}") for name in populations])
              for mine, df in populations.items()]
    base = reduce(DataFrame.unionByName, tagged).groupBy(*columns).agg(*[F.sum(n).alias(n) for n in counts])
    entries = []
    for name, r in reports.items():
        label = [rule().cast("string") for rule in r.labels.values()] + [F.lit(None).cast("string")]
        entries.append(F.struct(
            F.lit(name).alias("report"), label[0].alias("label_1"), label[1].alias("label_2"),
            (F.col(r.key).cast("string") if r.key else F.lit(None).cast("string")).alias("key"),
            (r.where() if r.where else F.lit(True)).alias("taken")))
    rows = base.select(*counts, F.inline(F.array(*entries))).filter("taken").drop("taken")
    labels = ["report", "label_1", "label_2"]
    per_key = rows.groupBy(*labels, "key").agg(*[F.sum(n).alias(n) for n in counts])
    held = lambda n: F.count(F.when(F.col("key").isNotNull() & (F.col(n) > 0), 1))
    return per_key.groupBy(*labels).agg(*[F.sum(f"n_{p}").alias(f"rows_{p}") for p in populations],
                                        *[held(f"n_{p}").alias(f"keys_{p}") for p in populations])


def _labelled(cube: DataFrame, name: str, population: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The cube's rows of a report, and its labels in their own types (those ``population`` gives them)."""
    rules = REPORTS[name].labels
    kinds = population.select(*[rule().alias(a) for a, rule in rules.items()]).schema
    return cube.filter(F.col("report") == name), [F.col(f"label_{n}").cast(kinds[a].dataType).alias(a) for n, a in enumerate(rules, 1)]


def report(cube: DataFrame, name: str, population: str, like: DataFrame) -> DataFrame:
    """One report over one population, in the source's order; ``like``: any of the populations, for types."""
    r = REPORTS[name]
    rows, labels = _labelled(cube, name, like)
    value = F.col(f"keys_{population}" if r.key else f"rows_{population}").alias(r.value)
    return ordered(rows.filter(F.col(f"rows_{population}") > 0).select(*labels, value), *r.labels, bounded=r.bounded)


def by_population(cube: DataFrame, name: str, populations: list[str], like: DataFrame) -> DataFrame:
    """One report over each population, its rows tagged with the population's name."""
    r = REPORTS[name]
    rows, labels = _labelled(cube, name, like)
    each = [F.struct(F.lit(p).alias("population"), F.col(f"rows_{p}").alias("_rows"), F.col(f"keys_{p}" if r.key else f"rows_{p}").alias(r.value))
            for p in populations]
    return (rows.select(*labels, F.inline(F.array(*each))).filter(F.col("_rows") > 0)
            .select("population", *r.labels, r.value))
