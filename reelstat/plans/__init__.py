"""Jobs built from the operators: fit loops, the query catalogue and its SQL oracles, ALS cross-check."""
