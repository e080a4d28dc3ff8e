"""stepforge - building and auditing step-level training data on Spark."""
