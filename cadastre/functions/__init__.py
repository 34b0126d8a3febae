"""Column builders: every function returns a Spark ``Column`` and stays in the JVM."""
