"""Column expressions shared by the models. Everything here stays in the JVM."""
