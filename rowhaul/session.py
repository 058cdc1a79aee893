"""Session settings that suit these jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Decoding many columns makes long generated methods, which the JVM would only interpret;
    # beyond this size Spark splits the expressions instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the recommended settings to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder
