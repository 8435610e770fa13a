"""Files of arrays in the shared folder, one file for each shard, mapped into workers' memory."""

from __future__ import annotations

import json
import mmap
import os
import shutil
import tempfile
import uuid
from collections import OrderedDict

import numpy as np
from pyarrow import fs

#: Files that a worker keeps mapped at once; the one that was used longest ago goes first.
MAPS = 96
_ALIGN = 64


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Writes the arrays as one file that has its final name only when whole; a task that runs again writes the same bytes.

    The file holds the length of a header, the header (type, shape and place of each array) and the arrays.
    """
    held, places, at = [], {}, 0
    for key, values in arrays.items():
        values = np.ascontiguousarray(values)
        places[key] = (values.dtype.str, values.shape, at)
        held.append(values)
        at += -(-values.nbytes // _ALIGN) * _ALIGN
    header = json.dumps(places).encode()
    header += b" " * (-(len(header) + 8) % _ALIGN)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(len(header).to_bytes(8, "little") + header)
        for values in held:
            out.write(values.tobytes())
            out.write(bytes(-values.nbytes % _ALIGN))
    store.move(draft, f"{path}/{name}")


_MAPPED: OrderedDict[str, dict[str, np.ndarray]] = OrderedDict()


def _map(path: str) -> dict[str, np.ndarray]:
    with open(path, "rb") as file:
        data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)  # a map outlives its file's name
    size = int.from_bytes(data[:8], "little")
    found = {}
    for key, (kind, shape, at) in json.loads(data[8 : 8 + size]).items():
        count = int(np.prod(shape))
        found[key] = np.frombuffer(data, kind, count, 8 + size + at).reshape(shape) if count else np.empty(shape, kind)
    return found


def mapped(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file as maps of it; none if there is no such file.

    Arrays that a caller still holds stay valid when their file leaves the table. From a store that cannot be mapped the
    file is copied to an unnamed local one.
    """
    key = f"{folder}/{name}"
    if key in _MAPPED:
        _MAPPED.move_to_end(key)
        return _MAPPED[key]
    store, path = fs.FileSystem.from_uri(folder)
    path = f"{path}/{name}"
    try:
        if isinstance(store, fs.LocalFileSystem):
            found = _map(path)
        else:
            with tempfile.NamedTemporaryFile(delete=False) as copy, store.open_input_stream(path) as source:
                shutil.copyfileobj(source, copy)
            found = _map(copy.name)
            os.unlink(copy.name)
    except FileNotFoundError:
        found = {}
    while len(_MAPPED) >= MAPS:
        _MAPPED.popitem(last=False)
    _MAPPED[key] = found
    return found
