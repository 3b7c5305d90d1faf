"""Members of a ZIP archive by ranged reads: nothing is extracted."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs

# Fixed values of the ZIP format: signatures and sizes of its records.
END, END_SIZE = b"PK\x05\x06", 22
LOCATOR, LOCATOR_SIZE = b"PK\x06\x07", 20
END64, END64_SIZE = b"PK\x06\x06", 56
ENTRY, ENTRY_SIZE = b"PK\x01\x02", 46
LOCAL, LOCAL_SIZE = b"PK\x03\x04", 30
LONGEST_COMMENT = 0xFFFF
IN_ZIP64_16, IN_ZIP64_32 = 0xFFFF, 0xFFFFFFFF
STORED = 0


@dataclass
class Member:
    name: str
    method: int
    header: int  # place of the local header
    size: int  # bytes as stored


def open_ranges(uri: str) -> pa.NativeFile:
    """A file for ranged reads, on any file system that Arrow knows."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def read_range(file: pa.NativeFile, start: int, length: int) -> bytes:
    data = file.read_at(length, start)
    if len(data) != length:
        raise ValueError(f"the archive ends within {length} bytes from {start}")
    return data


def _directory(file: pa.NativeFile) -> tuple[int, int, int]:
    """(entries, bytes, place) of the central directory."""
    size = file.size()
    tail_length = min(size, END_SIZE + LONGEST_COMMENT)
    tail = read_range(file, size - tail_length, tail_length)
    at = tail.rfind(END)
    # The signature may also occur in the comment: the true one ends with the file.
    while at >= 0:
        if at + END_SIZE <= len(tail):
            comment = struct.unpack_from("<H", tail, at + END_SIZE - 2)[0]
            if at + END_SIZE + comment == len(tail):
                break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: it has no end of central directory")
    entries, length, place = struct.unpack_from("<HII", tail, at + 10)
    if IN_ZIP64_16 == entries or IN_ZIP64_32 in (length, place):
        before = size - tail_length + at - LOCATOR_SIZE
        locator = read_range(file, before, LOCATOR_SIZE) if before >= 0 else b""
        if locator[:4] == LOCATOR:
            record = read_range(file, struct.unpack_from("<Q", locator, 8)[0], END64_SIZE)
            if record[:4] != END64:
                raise ValueError("the ZIP64 locator points at no directory record")
            entries, length, place = struct.unpack_from("<QQQ", record, 32)
    return entries, length, place


def _zip64_values(extra: bytes, size: int, header: int, plain_size: int) -> tuple[int, int]:
    """Stored size and place, where the entry leaves them to its ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if plain_size == IN_ZIP64_32:
                next(values)
            if size == IN_ZIP64_32:
                size = next(values)
            if header == IN_ZIP64_32:
                header = next(values)
            break
        at += 4 + length
    return size, header


def members(file: pa.NativeFile, chunk: int = 1 << 20) -> Iterator[Member]:
    """The entries of the central directory, read in chunks."""
    entries, length, place = _directory(file)
    held, end = b"", place + length
    for _ in range(entries):
        while True:
            if len(held) >= ENTRY_SIZE:
                if held[:4] != ENTRY:
                    raise ValueError("broken entry in the central directory")
                name, extra, comment = struct.unpack_from("<HHH", held, 28)
                whole = ENTRY_SIZE + name + extra + comment
                if len(held) >= whole:
                    break
            more = min(chunk, end - place)
            if more <= 0:
                raise ValueError("the central directory ends early")
            held += read_range(file, place, more)
            place += more
        flags, method = struct.unpack_from("<HH", held, 8)
        size, plain_size = struct.unpack_from("<II", held, 20)
        header = struct.unpack_from("<I", held, 42)[0]
        text = held[ENTRY_SIZE : ENTRY_SIZE + name]
        own_extra = held[ENTRY_SIZE + name : ENTRY_SIZE + name + extra]
        size, header = _zip64_values(own_extra, size, header, plain_size)
        yield Member(text.decode("utf-8" if flags & 0x800 else "cp437"), method, header, size)
        held = held[whole:]


def data_start(file: pa.NativeFile, member: Member) -> int:
    """Where a member's bytes begin: its local header may be longer than its entry."""
    local = read_range(file, member.header, LOCAL_SIZE)
    if local[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    name, extra = struct.unpack_from("<HH", local, 26)
    return member.header + LOCAL_SIZE + name + extra
