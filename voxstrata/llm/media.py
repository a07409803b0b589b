"""Media columns in ISO base media files (nested boxes with a sample table).

``with_media`` makes bytes an 8-bit sound track: ``ftyp``, ``mdat`` and a ``moov`` whose sample table says where each
unit of 64 bytes lies, how long it lasts and which units are key frames; ``stored_media`` writes that column and reads it
again. ``media_features`` walks the boxes of any such column, decodes every track's sample table and returns codec,
duration and, from one key frame to the next, byte ranges and times, without touching the payload; ``payload`` follows the
same table to read it back.

Defined results: null text is stored as one unit of zeros; bytes that aren't a well-formed file give null tracks and a
reason in ``problem``, whatever they claim about their sizes; equal texts give equal files; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored. Texts of any length are stored whole: beyond 4 GiB boxes
and offsets take 64 bits.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_lists, stored

UNIT, TIMESCALE, KEY_EVERY = 64, 8000, 16
#: Box types that hold other boxes (fixed values of the format).
CONTAINERS = frozenset((b"moov", b"trak", b"mdia", b"minf", b"dinf", b"stbl"))
#: Containers inside containers; the format needs six.
MOST_DEPTH = 32
FEATURES = "tracks array<struct<handler:string,codec:string,channels:int,sample_bits:int,timescale:long,duration:long,samples:long,keyframes:array<struct<start:long,length:long,time:long>>>>, problem string"


def box(kind: bytes, body: bytes) -> bytes:
    size = len(body) + 8
    return struct.pack(">I4s", size, kind) + body if size < 1 << 32 else struct.pack(">I4sQ", 1, kind, size + 8) + body


def full_box(kind: bytes, body: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags) + body)


def padded(data: bytes) -> bytes:
    return data.ljust(max(1, -(-len(data) // UNIT)) * UNIT, b"\0")


def mux(payload: bytes) -> bytes:
    """A file with one track of 8-bit samples; the payload's length is a positive multiple of UNIT."""
    units = len(payload) // UNIT
    head = box(b"ftyp", b"isom" + struct.pack(">I", 512) + b"isommp42")
    data = box(b"mdat", payload)
    at = len(head) + len(data) - len(payload)
    chunks = -(-units // KEY_EVERY)
    offsets = at + UNIT * KEY_EVERY * np.arange(chunks, dtype=np.int64)
    wide = at + len(payload) >= 1 << 32
    rest = units - (chunks - 1) * KEY_EVERY
    runs = ([(1, KEY_EVERY)] if chunks > 1 or rest == KEY_EVERY else []) + ([(chunks, rest)] if rest < KEY_EVERY else [])
    length = units * UNIT
    entry = box(b"raw ", bytes(6) + struct.pack(">H8xHHHHI", 1, 1, 8, 0, 0, TIMESCALE << 16))
    table = box(b"stbl", b"".join((
        full_box(b"stsd", struct.pack(">I", 1) + entry),
        full_box(b"stts", struct.pack(">III", 1, units, UNIT)),
        full_box(b"stss", struct.pack(">I", chunks) + np.arange(1, units + 1, KEY_EVERY, dtype=">u4").tobytes()),
        full_box(b"stsc", struct.pack(">I", len(runs)) + b"".join(struct.pack(">III", *r, 1) for r in runs)),
        full_box(b"stsz", struct.pack(">II", UNIT, units)),
        full_box(b"co64" if wide else b"stco", struct.pack(">I", chunks) + offsets.astype(">u8" if wide else ">u4").tobytes()),
    )))
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    movie = full_box(b"mvhd", struct.pack(">QQIQIH10x", 0, 0, TIMESCALE, length, 0x10000, 0x100) + matrix + bytes(24) + struct.pack(">I", 2), 1)
    track = full_box(b"tkhd", struct.pack(">QQIIQ8xHHH2x", 0, 0, 1, 0, length, 0, 0, 0x100) + matrix + bytes(8), 1, 7)
    media = full_box(b"mdhd", struct.pack(">QQIQHH", 0, 0, TIMESCALE, length, 0x55C4, 0), 1)
    handler = full_box(b"hdlr", struct.pack(">I4s12x", 0, b"soun") + b"\0")
    where = box(b"dinf", full_box(b"dref", struct.pack(">I", 1) + full_box(b"url ", b"", 0, 1)))
    info = box(b"minf", full_box(b"smhd", bytes(4)) + where + table)
    return head + data + box(b"moov", movie + box(b"trak", track + box(b"mdia", media + handler + info)))


def walk(data: bytes, start: int = 0, end: int | None = None) -> list[tuple[tuple, int, int]]:
    """(path of types, start, end) of every box's body, nested ones after the box that holds them; any depth."""
    found: list[tuple[tuple, int, int]] = []
    todo = [(start, len(data) if end is None else end, ())]
    while todo:
        start, end, path = todo.pop()
        if start == end:
            continue
        if start + 8 > end:
            raise ValueError("a box is cut off")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if body + 8 > end:
                raise ValueError("a box is cut off")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop < body or stop > end:
            raise ValueError("a box reaches beyond what holds it")
        found.append((path, kind, body, stop))
        todo.append((stop, end, path))
        if kind in CONTAINERS:
            if len(path) >= MOST_DEPTH:
                raise ValueError("boxes are nested too deep")
            todo.append((body, stop, (*path, kind)))
    return [((*path, kind), a, b) for path, kind, a, b in found]


class _Boxes:
    """The bodies of one track's boxes; everything read is checked against the box that holds it."""

    def __init__(self, data: bytes, found: list[tuple[tuple, int, int]]):
        self.data, self.at = data, {}
        for path, a, b in found:
            self.at.setdefault(path[-1], (a, b))

    def fields(self, kind: bytes, form: str, skip: int) -> tuple:
        a, b = self.at[kind]
        if a + skip + struct.calcsize(form) > b:
            raise ValueError(f"{kind.decode('latin-1')} is too short")
        return struct.unpack_from(form, self.data, a + skip)

    def numbers(self, kind: bytes, skip: int, width: int = 1, form: str = ">u4") -> np.ndarray:
        """A count at ``skip`` - 4 and so many rows of ``width`` numbers from ``skip`` on."""
        a, b = self.at[kind]
        (count,) = self.fields(kind, ">I", skip - 4)
        if a + skip + count * width * np.dtype(form).itemsize > b:
            raise ValueError(f"{kind.decode('latin-1')} is too short")
        return np.frombuffer(self.data, form, count * width, a + skip).astype(np.int64).reshape(-1, width)


def _track(data: bytes, boxes: _Boxes) -> dict:
    version = boxes.fields(b"mdhd", ">B", 0)[0]
    timescale, duration = boxes.fields(b"mdhd", ">IQ" if version else ">II", 20 if version else 12)
    handler = boxes.fields(b"hdlr", ">4s", 8)[0]
    codec = boxes.fields(b"stsd", ">4s", 12)[0].decode("latin-1")
    channels, bits = boxes.fields(b"stsd", ">HH", 32) if handler == b"soun" else (None, None)
    one, count = boxes.fields(b"stsz", ">II", 4)
    if one * count > len(data):
        raise ValueError("samples are larger than the file")
    sizes = np.full(count, one, np.int64) if one else boxes.numbers(b"stsz", 12)[:, 0]
    offsets = (boxes.numbers(b"co64", 8, form=">u8") if b"co64" in boxes.at else boxes.numbers(b"stco", 8))[:, 0]
    runs = boxes.numbers(b"stsc", 8, 3)
    chunks = np.diff(np.append(runs[:, 0], len(offsets) + 1))
    if len(runs) and (runs[0, 0] != 1 or (chunks < 0).any()) or int((runs[:, 1] * chunks).sum()) != count:
        raise ValueError("the sample table doesn't add up")
    each = np.repeat(runs[:, 1], chunks)
    chunk = np.repeat(np.arange(len(offsets)), each)
    ends = np.cumsum(sizes)
    first = np.concatenate([[0], np.cumsum(each)[:-1]]).astype(np.int64)
    starts = offsets[chunk] + (ends - sizes) - (ends - sizes)[first[chunk]] if count else ends
    if count and (starts.min() < 0 or int((starts + sizes).max()) > len(data)):
        raise ValueError("a sample lies beyond the file")
    spans = boxes.numbers(b"stts", 8, 2)
    if int(spans[:, 0].sum()) != count:
        raise ValueError("the times don't add up")
    lasts = np.repeat(spans[:, 1], spans[:, 0])
    keys = boxes.numbers(b"stss", 8)[:, 0] - 1 if b"stss" in boxes.at else np.arange(count)
    if len(keys) and (keys.min() < 0 or keys.max() >= count or (np.diff(keys) <= 0).any()):
        raise ValueError("the key frames aren't in order")
    return {"handler": handler.decode("latin-1"), "codec": codec, "channels": channels, "sample_bits": bits, "timescale": timescale, "duration": duration, "sizes": sizes, "starts": starts, "times": np.cumsum(lasts) - lasts, "keys": keys}


def tracks(data: bytes) -> list[dict]:
    """Each track's codec, times, and where each sample lies: only boxes are read."""
    found, out, own = walk(data), [], None
    for box_ in found:
        path = box_[0]
        if path[:2] == (b"moov", b"trak"):
            if len(path) == 2:
                own = []
                out.append(own)
            else:
                own.append(box_)
    if not out:
        raise ValueError("no track")
    return [_track(data, _Boxes(data, x)) for x in out]


def keyframe_ranges(track: dict) -> list[dict]:
    """From each key frame to the last sample before the next one, as runs of bytes' first and total length, and its time."""
    keys, starts, sizes = track["keys"], track["starts"], track["sizes"]
    last = np.append(keys[1:], len(starts)) - 1
    return [{"start": s, "length": n, "time": t} for s, n, t in zip(starts[keys].tolist(), (starts[last] + sizes[last] - starts[keys]).tolist(), track["times"][keys].tolist(), strict=True)]


def samples(data: bytes, track: dict) -> bytes:
    """A track's samples, one after the other."""
    view, starts, ends = memoryview(data), track["starts"], track["starts"] + track["sizes"]
    if not len(starts):
        return b""
    fresh = np.flatnonzero(np.append(True, starts[1:] != ends[:-1]))  # runs that lie together are read at once
    return b"".join(view[a:b] for a, b in zip(starts[fresh].tolist(), ends[np.append(fresh[1:], len(starts)) - 1].tolist(), strict=True))


def payload(data: bytes) -> bytes:
    """The first track's samples."""
    return samples(data, tracks(data)[0])


def _described(track: dict) -> dict:
    names = ("handler", "codec", "channels", "sample_bits", "timescale", "duration")
    return {k: track[k] for k in names} | {"samples": len(track["sizes"]), "keyframes": keyframe_ranges(track)}


def features(data: bytes | None) -> dict:
    try:
        return {"tracks": [_described(x) for x in tracks(data or b"")], "problem": None}
    except (ValueError, KeyError, IndexError, OverflowError, struct.error) as e:
        return {"tracks": None, "problem": f"{type(e).__name__}: {e}"}


def with_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): texts as files in a binary column."""

    def make():
        def apply(keys, texts):
            raw = [x.encode("utf-8", "surrogatepass") for x in texts]
            return [keys, [len(x) for x in raw], [mux(padded(x)) for x in raw]]

        return apply

    return map_lists(id_and_text(docs, id_col, text_col), "doc_id long, n_bytes long, media binary", make)


def media_features(held: DataFrame, *, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Id and features of a column of files: one entry a track."""

    def make():
        def apply(keys, files):
            found = [features(x) for x in files]
            return [keys, [x["tracks"] for x in found], [x["problem"] for x in found]]

        return apply

    return map_lists(held.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media")), f"doc_id long, {FEATURES}", make)


def media_digests(held: DataFrame) -> DataFrame:
    """What a stored column holds: the first track's payload, read back through its sample table, and its features as a string.

    Bytes that aren't a well-formed file have nulls there, and the reason as their feature.
    """

    def make():
        def digest(data: bytes | None) -> tuple:
            data = data or b""
            try:
                track = tracks(data)[0]
                read, f = samples(data, track), _described(track)
            except (ValueError, KeyError, IndexError, OverflowError, struct.error) as e:
                return None, None, None, len(data), hashlib.sha256(data).hexdigest(), f"{type(e).__name__}: {e}"
            ranges = ",".join(f"{k['start']}+{k['length']}@{k['time']}" for k in f["keyframes"])
            feature = f"{f['codec']}|{f['channels']}x{f['sample_bits']}|{f['duration']}/{f['timescale']}|{f['samples']}|{ranges}"
            return len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), feature

        def apply(keys, lengths, files):
            return [keys, lengths, *map(list, zip(*map(digest, files), strict=True))]

        return apply

    return map_lists(held.select("doc_id", "n_bytes", "media"), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", make, text=2)


def stored_media(docs: DataFrame, **columns) -> DataFrame:
    """The media column written as a table in the shared folder, and read again."""
    return stored(with_media(docs, **columns), "media")
