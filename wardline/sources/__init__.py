from wardline.sources.tables import read_table  # noqa: F401
