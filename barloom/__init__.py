"""Market-data bars on Spark: cleaning, storage and checks for all symbols at once."""
