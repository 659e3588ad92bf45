"""Analytics over tables of timestamped observations, written as Spark DataFrame transformations."""
