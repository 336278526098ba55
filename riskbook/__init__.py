"""Consumer-loan analytics on PySpark: exploration, cleaning, features and default models."""
