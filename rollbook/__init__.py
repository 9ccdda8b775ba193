"""rollbook - count-table analytics (bronze, silver, gold, data quality) on Spark DataFrames."""

from rollbook.catalog import KEY, SPECS, TableSpec

__all__ = ["KEY", "SPECS", "TableSpec"]
