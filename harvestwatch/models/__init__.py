"""Model operators: splits, Spark ML classifier/regressor, isolation forest,
evaluation tables and importances."""
