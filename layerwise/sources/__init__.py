"""Sources and sinks: delimited records, vector tables, image folders, model and metric tables."""
