"""Single-node SQL used to check the Spark results."""
