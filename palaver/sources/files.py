"""Files beside Spark's own formats: any file system that pyarrow knows, and lists of parts that count."""

from __future__ import annotations

import json


def file_system(uri: str):
    """The file system and path of a URI or of a local path."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def read_list(uri: str, name: str):
    """The document `name` in a folder, None without it."""
    from pyarrow import fs

    files, path = file_system(uri)
    if files.get_file_info(f"{path}/{name}").type != fs.FileType.File:
        return None
    with files.open_input_stream(f"{path}/{name}") as f:
        return json.loads(f.read())


def commit_list(uri: str, name: str, document, parts: set[str], prefix: str = "part-") -> None:
    """Puts the document in place by a move, then deletes what begins with `prefix` and isn't one of the `parts`.

    A reader sees the old list or the new one; files of lost, repeated or replaced attempts don't stay.
    """
    from pyarrow import fs

    files, path = file_system(uri)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/{name}.new") as f:
        f.write(json.dumps(document).encode())
    files.move(f"{path}/{name}.new", f"{path}/{name}")
    for info in files.get_file_info(fs.FileSelector(path)):
        if info.base_name.startswith(prefix) and info.base_name not in parts:
            files.delete_file(info.path)
