"""File access of tasks, with the settings of Spark's own readers."""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

# Settings of Spark's object-store reader and the arguments that mean the same here.
_S3_SETTINGS = {
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.endpoint.region": "region",
}


def hadoop_settings(spark: SparkSession) -> dict[str, str]:
    """The file system settings that Spark's own readers use, ``spark.hadoop.*`` included."""
    settings = {}
    entries = spark._jsc.hadoopConfiguration().iterator()
    while entries.hasNext():
        entry = entries.next()
        if entry.getKey().startswith(("fs.", "dfs.", "hadoop.security.")):
            settings[entry.getKey()] = entry.getValue()
    return settings


def file_system_call(root: str, settings: dict[str, str]) -> tuple[str, dict, str]:
    """Kind of file system, its arguments, and the folder in it, for a root with or without a scheme."""
    scheme, _, rest = root.partition("://")
    if not rest:
        return "local", {}, root.rstrip("/")
    if scheme in ("s3", "s3a", "s3n"):
        given = {name: settings[key] for key, name in _S3_SETTINGS.items() if settings.get(key)}
        return "s3", given, rest.rstrip("/")
    if scheme == "file":
        return "local", {}, rest.rstrip("/")
    host, _, path = rest.partition("/")
    name, _, port = host.partition(":")
    address = {"host": f"{scheme}://{name}" if name else "default", "port": int(port or 0), "extra_conf": settings}
    return "hadoop", address, f"/{path}".rstrip("/")


def open_root(root: str, settings: dict[str, str]) -> tuple[pafs.FileSystem, str]:
    kind, arguments, base = file_system_call(root, settings)
    made = {"local": pafs.LocalFileSystem, "s3": pafs.S3FileSystem, "hadoop": pafs.HadoopFileSystem}[kind]
    return made(**arguments), base


def resolved(spark: SparkSession, root: str) -> str:
    """A root without a scheme is meant as Spark's readers mean it: in the default file system."""
    if "://" in root:
        return root
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else uri.toString()
