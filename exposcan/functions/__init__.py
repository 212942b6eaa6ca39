"""Column functions. Everything here is a JVM expression; there are no Python UDFs."""
