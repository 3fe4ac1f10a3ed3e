"""Road-network conflation on Spark: DataFrame plans for linear referencing, matching and map fusion."""
