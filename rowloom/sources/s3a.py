"""Session settings for ``s3a://`` paths. They need the hadoop-aws package on the class path."""

from __future__ import annotations

import os
from collections.abc import Mapping

# The settings, the endpoint and the environment variables of the credentials.
DEFAULT_ENDPOINT = "s3.us-west-2.amazonaws.com"
ACCESS_KEY_VARIABLE = "ACCESS_KEY"
SECRET_KEY_VARIABLE = "SECRET_KEY"


def credentials(environment: Mapping[str, str] = os.environ, required: bool = True) -> tuple[str, str]:
    """Access and secret key from the environment; empty texts where they may be missing."""
    access = environment.get(ACCESS_KEY_VARIABLE, "")
    secret = environment.get(SECRET_KEY_VARIABLE, "")
    if required and not (access and secret):
        raise ValueError(f"set {ACCESS_KEY_VARIABLE} and {SECRET_KEY_VARIABLE}")
    return access, secret


def s3a_settings(access: str, secret: str, endpoint: str = DEFAULT_ENDPOINT) -> dict[str, str]:
    """Settings to pass to ``SparkSession.builder.config(map=...)`` before the session starts."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.com.amazonaws.services.s3.enableV4": "true",
        "spark.hadoop.fs.s3a.access.key": access,
        "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.endpoint": endpoint,
    }
