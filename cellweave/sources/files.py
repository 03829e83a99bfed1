"""Files under a folder by URI, for data sources that run in Python workers on any executor."""

from __future__ import annotations

from fnmatch import fnmatch

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI, or of a path without scheme. Remote schemes need what pyarrow needs for them."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def listed(uri: str, pattern: str = "*") -> list[tuple[str, int]]:
    """Path and size of each file of a folder (or of the one file named) whose name matches, in order of path. Names that
    begin with _ or . are not data."""
    system, path = place(uri)
    info = system.get_file_info(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
    names = [(x.path, x.size) for x in found if x.type == fs.FileType.File and fnmatch(x.base_name, pattern) and x.base_name[0] not in "_."]
    return sorted(names)
