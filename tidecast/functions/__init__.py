"""Column functions: everything here returns a native Spark ``Column``."""
