"""Lakehouse operators for Spark: every public function takes and returns DataFrames or Columns."""
