"""Labelling rules of the survey pull, as Spark Column expressions.

Each rule is a ``CASE WHEN`` chain built from ``pyspark.sql.functions``, so it
stays inside whole-stage codegen.  NULL handling follows SQL: a NULL test is
not a match, and a chain without ``otherwise`` yields NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the survey script's values exactly.
# ---------------------------------------------------------------------------
# Amount bands: the first band is 0 <= x <= 100, every later band is
# lower < x <= upper, the last is x > 5000.
AMOUNT_BAND_EDGES = [0, 100, 200, 300, 400, 500, 600, 700, 800, 900, 1000,
                     1200, 1400, 1600, 1800, 2000, 3000, 4000, 5000]
AMOUNT_BAND_LABELS = ["a0 to 100", "b101 to 200", "c201 to 300", "d301 to 400",
                      "e401 to 500", "f501 to 600", "g601 to 700", "h701 to 800",
                      "i801 to 900", "j901 to 1000", "k1001 to 1200",
                      "l1201 to 1400", "m1401 to 1600", "n1601 to 1800",
                      "o1801 to 2000", "p2001 to 3000", "q3001 to 4000",
                      "r4001 to 5000", "s5000 Higher"]
# Household species mix labels, first match wins.
MIX_ALL_FELINE = "A_AllFeline"
MIX_ALL_CANINE = "B_AllCanine"
MIX_ALL_AVIAN_EXOTIC = "C_AllAvianExotic"
MIX_CANINE_FELINE = "D_CanineFelineMix"
MIX_CANINE_OTHERS = "E_CanineOthersMix"
MIX_FELINE_OTHERS = "F_FelineOthersMix"
MIX_ALL_KINDS = "G_CanineFelineorOthersMix"
MIX_UNKNOWN = "Unknown"
# Term groups: 0; 1 to 3; 4 to 5; over 5.
TERM_GROUP_LABELS = ["0", "1 to 3", "4 to 5", "5 Higher"]
# Species codes: C dog, F cat, A avian, E and R exotic/other.
SPECIES_DOG, SPECIES_CAT, SPECIES_AVIAN = "C", "F", "A"
SPECIES_EXOTIC = ["E", "R"]
# Wellness plan by VRCC code.
WELLCARE_TYPES = {99: "VRCC", 144: "Core", 264: "Premier"}
# Staff origin codes, excluded from the survey.
STAFF_ORIGIN_CODES = ["GD0082", "GD0174", "GP0082", "GP0083"]
# Policy statuses that count as in force.
INFORCE_STATUSES = ["Inforce", "Inforce (Undernotice)"]
# Product prefixes of the new-policy pool.
NEW_POLICY_PRODUCT_PREFIXES = ["M", "FS", "I", "NI", "WB"]
# Products folded into one report label.
PRODUCT_FOLD_PREFIX = "I250"
PRODUCT_FOLD_LABEL = "I250 (Reg/I250G)"
# Coverage type that marks a wellness claim.
WELLNESS_COVERAGE = "Wellcare"
# Claim revisions that do not count.
REOPENED_STATUS = "Reopened"
# Term numbers at or above this are reported on one overflow row.
TERM_OVERFLOW = 18
# Households with more pets than this are reported together.
MULTIPET_TOP = 7
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def amount_band(amount: Column | str) -> Column:
    """Label an amount with its band; negative or NULL amounts get NULL."""
    x = _c(amount)
    expr = F.when((x >= AMOUNT_BAND_EDGES[0]) & (x <= AMOUNT_BAND_EDGES[1]), F.lit(AMOUNT_BAND_LABELS[0]))
    for lo, hi, label in zip(AMOUNT_BAND_EDGES[1:-1], AMOUNT_BAND_EDGES[2:], AMOUNT_BAND_LABELS[1:-1]):
        expr = expr.when((x > lo) & (x <= hi), F.lit(label))
    return expr.when(x > AMOUNT_BAND_EDGES[-1], F.lit(AMOUNT_BAND_LABELS[-1]))


def species_mix(dogs: Column | str = "dogs", cats: Column | str = "cats",
                avian: Column | str = "avian", exotic: Column | str = "exoticothers") -> Column:
    """Household species mix from the four per-household pet counts."""
    d, c, a, e = _c(dogs), _c(cats), _c(avian), _c(exotic)
    no_other = (e == 0) & (a == 0)
    other = (e >= 1) | (a >= 1)
    return (
        F.when(no_other & (c >= 1) & (d == 0), F.lit(MIX_ALL_FELINE))
        .when(no_other & (c == 0) & (d >= 1), F.lit(MIX_ALL_CANINE))
        .when((c == 0) & (d == 0) & other, F.lit(MIX_ALL_AVIAN_EXOTIC))
        .when(no_other & (c >= 1) & (d >= 1), F.lit(MIX_CANINE_FELINE))
        .when((d >= 1) & (c == 0) & other, F.lit(MIX_CANINE_OTHERS))
        .when((c >= 1) & (d == 0) & other, F.lit(MIX_FELINE_OTHERS))
        .when((d >= 1) & (c >= 1) & other, F.lit(MIX_ALL_KINDS))
        .otherwise(F.lit(MIX_UNKNOWN))
    )


def term_group(term: Column | str) -> Column:
    """Group a term number: 0, 1 to 3, 4 to 5, over 5; anything else NULL."""
    t = _c(term)
    zero, low, mid, high = TERM_GROUP_LABELS
    return (
        F.when(t == 0, F.lit(zero))
        .when(t.between(1, 3), F.lit(low))
        .when(t.between(4, 5), F.lit(mid))
        .when(t > 5, F.lit(high))
    )


def multipet_group(total_pets: Column | str) -> Column:
    """1 to 6 pets as is, everything else (NULL and 0 included) as 7."""
    n = _c(total_pets)
    return F.when(n.between(1, MULTIPET_TOP - 1), n).otherwise(F.lit(MULTIPET_TOP).cast("bigint"))


def pets_topcoded(total_pets: Column | str) -> Column:
    """7 or more pets as 7; NULL and 0 kept as they are."""
    n = _c(total_pets)
    return F.when(n >= MULTIPET_TOP, F.lit(MULTIPET_TOP).cast("bigint")).otherwise(n)


def term_number(col: str) -> Column:
    """A term number as ``int``, text or not; text that is no number is NULL and meets nothing."""
    return F.col(col).try_cast("int")


def product_group(baseproduct: Column | str) -> Column:
    """Fold the I250 product family into one label."""
    p = _c(baseproduct)
    return F.when(p.startswith(PRODUCT_FOLD_PREFIX), F.lit(PRODUCT_FOLD_LABEL)).otherwise(p)


def wellcare_type(vrcc: Column | str) -> Column:
    """Wellness plan name from the VRCC code; no plan gives NULL."""
    v = _c(vrcc)
    expr = None
    for code, name in WELLCARE_TYPES.items():
        expr = (F.when if expr is None else expr.when)(v == code, F.lit(name))
    return expr


def cancer_flag(cancer: Column | str) -> Column:
    """'N' when the cancer rider is 0, otherwise (NULL included) 'Y'."""
    c = _c(cancer)
    return F.when(c == 0, F.lit("N")).otherwise(F.lit("Y"))


def email_shape_ok(email: Column | str, strict: bool = False) -> Column:
    """The pull's e-mail test: contains '@' or contains '.'.

    ``strict=True`` requires both, which the original test does not.
    """
    e = _c(email)
    if strict:
        return e.contains("@") & e.contains(".")
    return e.contains("@") | e.contains(".")


def new_policy_product(baseproduct: Column | str) -> Column:
    """True when the product starts with one of the new-policy prefixes."""
    p = _c(baseproduct)
    cond = None
    for prefix in NEW_POLICY_PRODUCT_PREFIXES:
        cond = p.startswith(prefix) if cond is None else (cond | p.startswith(prefix))
    return cond
