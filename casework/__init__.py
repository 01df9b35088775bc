"""casework: document and case analytics as plain Spark DataFrame functions."""
