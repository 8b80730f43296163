"""Where the given tables are; a module of its own, as several folders have a conftest."""

DATA = "/root/testdata"
