"""Sources and sinks: landing extracts, layered table store, report CSVs, driver-table views."""
