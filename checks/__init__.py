"""Binding of the library to the driver's tables, the registered queries and their SQL oracles."""
