"""Caption and text-contract analytics, and training-data operators, as PySpark DataFrame programs."""
