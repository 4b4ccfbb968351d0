"""The registered queries: stand-in tables, Spark queries and their SQL twins."""
