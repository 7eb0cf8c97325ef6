"""Feature layers, leak-free model evaluation and run marts as Spark DataFrame plans."""
