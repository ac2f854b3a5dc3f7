"""heliolake: a Spark-native bronze -> silver -> gold lakehouse for solar-inverter telemetry.

Every operator is a DataFrame transformation (or a column expression) built from
``pyspark.sql.functions``; nothing leaves the JVM in a core path, so one plan covers one
day or many years of telemetry.
"""

from heliolake.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
