"""Sources and sinks: files, JDBC, fixed lookups, and views over the test tables."""
