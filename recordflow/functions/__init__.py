"""Column builders: everything here returns a Column and stays inside the JVM unless it says otherwise."""
