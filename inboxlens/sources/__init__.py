"""Sources and sinks: landed message JSON, table layouts, the mail relation of the test tables."""
