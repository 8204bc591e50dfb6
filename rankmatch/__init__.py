"""Match a dirty checklist of named records against a hierarchical authority table, on Spark.

Every function takes DataFrames and returns DataFrames.  Nothing is collected to the
driver except one row of counts when wholly empty columns are looked for.
"""
