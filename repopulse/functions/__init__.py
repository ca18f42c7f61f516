"""Column expressions shared by the plans. All of them stay inside the JVM."""
