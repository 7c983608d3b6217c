"""The operators bound to the driver tables, and their SQL counterparts."""
