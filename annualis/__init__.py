"""Annual person-year panels from longitudinal microdata, as Spark DataFrame operators."""

__version__ = "0.1.0"
