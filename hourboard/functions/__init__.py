"""Column functions; all are built-in Spark expressions, evaluated in the JVM."""
