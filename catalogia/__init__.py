"""Catalogia: media catalogue operators on PySpark DataFrames."""
