"""Raw inputs: declared schemas, file discovery, scans and catalog listings."""
