"""Reports and table operators.

Every operator takes DataFrames and returns a DataFrame, without running a job.
``scope`` names extra key columns (``cluster_id``, ``snapshot_ts``) that take part
in every join and grouping, so that one run covers a whole fleet.
"""
