"""starlane: build, check, publish and query a star schema with PySpark.

Nothing here starts a session, reads a file or runs a job at import time.
"""
