"""Files of our own formats in the shared folder, written and read inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it (``file:/x``) or of a plain path."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def write_once(uri: str, pieces: Iterable[bytes]) -> None:
    """Write a file under a passing name and rename it, so a repeated or doubled task leaves one whole file."""
    store, path = filesystem(uri)
    passing = f"{path}.{uuid.uuid4().hex}.part"
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(passing) as out:
        for piece in pieces:
            out.write(piece)
    store.move(passing, path)
