"""Reporting operators for brokerage data, written as Spark DataFrame functions.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or a
Column); nothing is computed on the driver apart from the one-row period lookup.
"""
