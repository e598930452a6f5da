"""A PySpark engine for collecting, cleaning, merging and serving learning opportunities from many feeds."""
