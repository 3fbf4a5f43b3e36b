"""Clinical-trial registry analytics expressed as Spark DataFrame operators."""
