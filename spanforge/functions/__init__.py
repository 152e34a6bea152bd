"""Column-level building blocks (pure Spark SQL expressions, JVM-side)."""

from spanforge.functions.arrays import prefix_sum  # noqa: F401
from spanforge.functions.hashing import draw_index, u32, unit_draw  # noqa: F401
