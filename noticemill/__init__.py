"""Classification, enrichment, storage and reporting of free-text notices on Spark.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; column names are parameters.
"""
