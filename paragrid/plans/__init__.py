"""The query catalogue of the driver contract."""
