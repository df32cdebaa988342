"""Sources and sinks: files, catalog tables, slices, column specs, DDL, object stores."""
