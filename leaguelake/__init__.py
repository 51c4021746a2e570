"""leaguelake: head-to-head competition analytics as plain Spark DataFrame functions."""
