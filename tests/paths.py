"""Folders of the given tables, for every test module (a name that no
``conftest`` can shadow)."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
