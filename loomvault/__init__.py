"""loomvault: a historised analytical warehouse expressed as PySpark DataFrame operators."""
