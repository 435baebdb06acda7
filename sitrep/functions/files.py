"""Files that tasks open by themselves."""

import re


def open_filesystem(path: str):
    """File system and path in it, of a path as Spark writes it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    # The names Hadoop gives to stores that pyarrow knows by others.
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
