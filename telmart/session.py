"""Session construction.

Storage and catalog settings are passed in; no endpoint or credential lives in code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions, splits skewed ones and turns joins
# into broadcasts from measured sizes; dynamic overwrite replaces only the
# partitions a write touches. Generated methods above 8000 bytes of bytecode are not
# compiled by HotSpot; with the limit, Spark splits wide projections instead.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Spark's own limit, which lets methods through that are then interpreted.
_METHOD_LIMIT, _SPARKS_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535"


def split_wide_code(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the limit for generated methods, unless it has one of its own.

    The builders of wide projections call it: their code runs several times slower in one method
    that HotSpot does not compile. It changes how rows are computed, never which.
    """
    if spark.conf.get(_METHOD_LIMIT) == _SPARKS_LIMIT:
        spark.conf.set(_METHOD_LIMIT, DEFAULT_CONF[_METHOD_LIMIT])


def get_spark(
    app_name: str = "telmart",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    """Return a session with the library defaults, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def iceberg_conf(catalog: str, warehouse: str, catalog_type: str = "hadoop") -> dict[str, str]:
    """Settings for an Iceberg catalog (the Iceberg runtime must be on the classpath)."""
    prefix = f"spark.sql.catalog.{catalog}"
    return {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": catalog_type,
        f"{prefix}.warehouse": warehouse,
    }


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    ssl: bool = True,
) -> dict[str, str]:
    """Settings for an S3-compatible store through the Hadoop ``s3a`` client."""
    prefix = "spark.hadoop.fs.s3a"
    conf = {
        f"{prefix}.endpoint": endpoint,
        f"{prefix}.path.style.access": str(path_style).lower(),
        f"{prefix}.connection.ssl.enabled": str(ssl).lower(),
        # Plain milliseconds: some client versions reject suffixed durations.
        f"{prefix}.connection.timeout": "60000",
        f"{prefix}.connection.establish.timeout": "60000",
    }
    if access_key is not None:
        conf[f"{prefix}.access.key"] = access_key
    if secret_key is not None:
        conf[f"{prefix}.secret.key"] = secret_key
    return conf
