"""Small JSON documents in a folder that the driver and all executors reach; what a stream has to find again after a restart."""

from __future__ import annotations

import json
import os
import uuid
from typing import Any

from pyarrow import fs


class Notes:
    """folder: a mounted path or a URI that pyarrow opens (s3, gs, hdfs, file).  A document is there whole or not at all."""

    def __init__(self, folder: str) -> None:
        if folder.startswith("file:"):
            folder = "/" + folder.removeprefix("file:").lstrip("/")
        self.files, self.root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))
        self.files.create_dir(self.root, recursive=True)

    def put(self, name: str, value: Any) -> None:
        made = f"{self.root}/{name}.{uuid.uuid4().hex}.part"
        with self.files.open_output_stream(made) as out:
            out.write(json.dumps(value).encode())
        self.files.move(made, f"{self.root}/{name}")

    def get(self, name: str) -> Any:
        """None where there is no such document."""
        at = f"{self.root}/{name}"
        if self.files.get_file_info(at).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(at) as file:
            return json.loads(file.read())

    def names(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(self.root))
        return sorted(f.base_name for f in found if f.type == fs.FileType.File and not f.base_name.endswith(".part"))

    def drop(self, name: str) -> None:
        self.files.delete_file(f"{self.root}/{name}")
