"""metassoc: association analysis and meta-analysis of many cohorts on PySpark."""

__version__ = "0.1.0"
