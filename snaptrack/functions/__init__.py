"""Column -> Column expressions. All built-ins, so they stay inside the JVM."""
