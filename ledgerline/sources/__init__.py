"""Reading and writing: tab-separated records and lists, catalogs, fixtures, sinks."""
