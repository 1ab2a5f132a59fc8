"""marlstone: tabular analytics, cleaning and model operators as Spark DataFrame plans."""
