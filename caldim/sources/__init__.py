"""Sources and sinks: spines, financial calendar, fact tables, versioned
tables, log tables."""
