"""CSV objects in an S3-compatible store, read through the s3a connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import ExtractError
from millrace.sources.csv import read_csv

# Config key -> Hadoop s3a option.
S3A_OPTIONS = {
    "endpoint_url": "fs.s3a.endpoint",
    "aws_access_key_id": "fs.s3a.access.key",
    "aws_secret_access_key": "fs.s3a.secret.key",
    "region_name": "fs.s3a.endpoint.region",
}


def object_uri(config: dict, scheme: str = "s3a") -> str:
    bucket, key = config.get("bucket"), config.get("key")
    if not bucket or not key:
        raise ExtractError("an object source needs 'bucket' and 'key'")
    return f"{scheme}://{bucket}/{key.lstrip('/')}"


def object_options(config: dict) -> dict[str, str]:
    """Reader options; they apply to this read only, so two stores can be used side by side."""
    options = {S3A_OPTIONS[k]: config[k] for k in S3A_OPTIONS if config.get(k)}
    if config.get("endpoint_url"):
        options["fs.s3a.path.style.access"] = "true"
    return options


def read_object(spark: SparkSession, config: dict) -> DataFrame:
    """Config: bucket, key, optional endpoint_url, credentials, region_name, schema, multi_line."""
    return read_csv(
        spark, object_uri(config, config.get("scheme", "s3a")), config.get("schema"),
        config.get("multi_line"), object_options(config),
    )
