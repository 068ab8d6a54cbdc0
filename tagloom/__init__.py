"""tagloom: tag time-series analytics expressed as Spark DataFrame plans."""
