"""canvass: survey-sample pulls from a policy warehouse, as Spark DataFrame jobs.

The package reads warehouse tables (parquet, catalog or JDBC), builds the
in-force population, removes suppressed and unreachable contacts, draws exact,
reproducible random samples and reports how each sample compares with its
population.  Every step is a plain ``DataFrame -> DataFrame`` function.
"""

from canvass.config import Config
from canvass.plans.pull import SurveyPull

__all__ = ["Config", "SurveyPull"]
