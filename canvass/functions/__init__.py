"""Column -> Column rules (all built-in expressions, codegen-friendly)."""

from canvass.functions.rules import (
    amount_band,
    cancer_flag,
    email_shape_ok,
    multipet_group,
    pets_topcoded,
    product_group,
    species_mix,
    term_group,
    wellcare_type,
)

__all__ = [
    "amount_band",
    "cancer_flag",
    "email_shape_ok",
    "multipet_group",
    "pets_topcoded",
    "product_group",
    "species_mix",
    "term_group",
    "wellcare_type",
]
