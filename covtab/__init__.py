"""covtab: category coverage reporting on Spark.

Resolve one category per entity from coded records, attach living entities
to the organisations valid on an as-of date, and publish per-organisation
coverage tables and a category cross-tab with totals, small-number
suppression, rounding and rates. Every step is a DataFrame operator.
"""

from covtab.params import JobParams

__all__ = ["JobParams"]
