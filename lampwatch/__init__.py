"""lampwatch: wasteful-lighting detection on Spark.

Keyed actuator (lamp level) and presence readings are joined as-of per
sensor, evaluated against rules (working-hours schedule, presence
look-back, or both) and turned into anomaly episodes.  The same rules run
as batch DataFrame window plans and as Structured Streaming stateful
operators.
"""

__all__ = ["session", "schemas"]
