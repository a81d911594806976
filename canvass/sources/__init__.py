"""Where the pull's tables come from and where its files go."""

from canvass.sources.fixtures import FixtureWarehouse
from canvass.sources.lists import export_sample, read_list
from canvass.sources.warehouse import DOMAIN_TABLES, Warehouse

__all__ = ["DOMAIN_TABLES", "FixtureWarehouse", "Warehouse", "export_sample", "read_list"]
