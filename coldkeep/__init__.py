"""coldkeep: archive, validate and purge aged relational data with Spark."""
