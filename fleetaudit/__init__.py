"""Fleet-wide audits of search-cluster metadata, as Spark DataFrame operators."""
