"""Sources and sinks: JSON landing / export envelope, stored tables, test data."""
