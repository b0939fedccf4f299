"""Sources and sinks: driver tables, fixture bindings, raw lake, staging, audit."""
