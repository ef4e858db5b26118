"""Files that tasks write and read themselves, in the session's shared folder."""

from __future__ import annotations

import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; Hadoop writes local URIs with one slash."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file under a name of its own: a repeated attempt never touches what another attempt wrote."""

    def __init__(self, folder: str, suffix: str):
        system, path = locate(folder)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.stream = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.at = 0

    def write(self, data: bytes) -> int:
        """Append ``data``; returns its offset."""
        at = self.at
        self.stream.write(data)
        self.at += len(data)
        return at

    def close(self) -> None:
        self.stream.close()


def open_file(folder: str, name: str):
    system, path = locate(folder)
    return system.open_input_file(f"{path}/{name}")
