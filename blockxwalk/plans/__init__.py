"""Pipeline stages and the named-query registry."""
