"""Files as bytes, from inside tasks."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyarrow import fs

def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a location as Spark writes it, and the path there. Credentials and regions come from the environment."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    if parts.scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(), f"{parts.netloc}{unquote(parts.path)}"
    if parts.scheme in ("hdfs", "viewfs"):  # the client's own configuration resolves the name
        return fs.HadoopFileSystem(f"{parts.scheme}://{parts.hostname or 'default'}", parts.port or 0), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)
