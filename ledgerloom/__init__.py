"""Data-assurance operators for large tables of records, references, histories and text.

Every public operator takes DataFrames (or Columns) and returns a DataFrame; none triggers a
Spark action, so calls compose into one plan.
"""
