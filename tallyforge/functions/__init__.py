"""Column helpers. Every one maps Column to Column and stays inside the JVM."""
