"""Sources: file loaders, the file catalog and the parquet test tables."""
