"""Session settings the jobs rely on, and the object-store connector settings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def object_store(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict[str, str]:
    """Settings for an S3-compatible store; paths then start with ``s3a://bucket``."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def build_session(app: str, extra: Mapping[str, str] | None = None) -> SparkSession:
    """Get or create a session; master and sizes come from spark-submit or ``extra``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
