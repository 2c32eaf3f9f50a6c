"""Review and catalogue analytics as Spark DataFrame functions.

Every public function takes DataFrames (or Columns) and gives back a DataFrame
(or Column); nothing runs until the caller acts on the result, except where the
docstring says that a bounded statistic is measured first.
"""
