"""slipway: publish Spark tables safely.

Builds go into immutable Parquet versions; a publish log decides which
version each environment sees; fused data-quality checks and gates decide
whether a build may go live; a bad live table is reverted by moving a
pointer back.
"""

__version__ = "0.1.0"
