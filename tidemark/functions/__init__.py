"""Column expressions. All of them stay on the JVM unless their docstring says otherwise."""
