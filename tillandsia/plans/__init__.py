"""Query plans: Spark SQL over DataFrames, optimised by Catalyst."""
