"""ledgerloom: aid and trade open data as Spark DataFrame jobs."""
