"""Sources and sinks: the rating view, the `ratings_bin` record data source, text scans and writers."""
