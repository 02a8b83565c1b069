"""Point-in-time analytics and training-data operators as Spark plans."""
