"""Media columns: what the bytes are, whatever the declared type says, and what is embedded in them.

An Aho-Corasick automaton finds the magic bytes of all formats in one pass; a validator for each format then walks its
structure and gives the true length, or refuses. A value's type is that of a valid medium at its start; valid media further in
are carved, from left to right and without overlap. FLAC, headerless MP3 and streamed Matroska do not tell their length: they end where
their frames or the bytes do.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import re
import struct
import zlib
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "application/octet-stream"


def _riff(b: bytes, at: int) -> int | None:
    if len(b) < at + 12 or b[at + 8 : at + 12] not in (b"WAVE", b"WEBP", b"AVI "):
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    if end > len(b):
        return None
    p, seen = at + 12, set()
    while p + 8 <= end:
        kind, n = b[p : p + 4], struct.unpack_from("<I", b, p + 4)[0]
        if p + 8 + n > end or not kind.strip().isalnum():
            return None
        seen.add(kind)
        p += 8 + n + (n & 1)
    if p not in (end, end + 1) or (b[at + 8 : at + 12] == b"WAVE" and not {b"fmt ", b"data"} <= seen) or not seen:
        return None
    return end - at


def _png(b: bytes, at: int) -> int | None:
    p, first = at + 8, True
    while p + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        if p + 12 + n > len(b) or first and (kind, n) != (b"IHDR", 13) or zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0]:
            return None
        p, first = p + 12 + n, False
        if kind == b"IEND":
            return p - at
    return None


def _gif(b: bytes, at: int) -> int | None:
    try:
        flags = b[at + 10]
        p = at + 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)
        while True:
            kind = b[p]
            if kind == 0x3B:
                return p + 1 - at
            if kind == 0x21:
                p += 2
            elif kind == 0x2C:
                local = b[p + 9]
                p += 11 + (3 << ((local & 7) + 1) if local & 0x80 else 0)
            else:
                return None
            while b[p]:
                p += b[p] + 1
            p += 1
    except IndexError:
        return None


def _jpeg(b: bytes, at: int) -> int | None:
    p = at + 2
    while p + 4 <= len(b) and b[p] == 0xFF:
        kind, n = b[p + 1], struct.unpack_from(">H", b, p + 2)[0]
        if kind == 0xDA:
            p += 2 + n
            while (p := b.find(b"\xff", p)) >= 0 and p + 1 < len(b):
                if b[p + 1] == 0xD9:
                    return p + 2 - at
                if b[p + 1] and not 0xD0 <= b[p + 1] <= 0xD7:
                    break
                p += 2
            if p < 0:
                return None
        elif n < 2 or kind in (0x00, 0xFF):
            return None
        else:
            p += 2 + n
    return None


def _bmp(b: bytes, at: int) -> int | None:
    if len(b) < at + 18:
        return None
    size, reserved, pixels, head = struct.unpack_from("<IIII", b, at + 2)
    return size if not reserved and head in (12, 40, 52, 56, 64, 108, 124) and 14 + head <= pixels <= size and at + size <= len(b) else None


class _Places:
    """Where a mark stands in the bytes, looked up once however many validators ask."""

    def __init__(self, data: bytes):
        self.data, self.of = data, {}

    def __call__(self, mark: bytes) -> list[int]:
        if mark not in self.of:
            self.of[mark] = [m.start() for m in re.finditer(re.escape(mark), self.data)]
        return self.of[mark]


def _pdf(b: bytes, at: int, places: _Places | None = None) -> int | None:
    """To the first %%EOF that a startxref precedes."""
    if not b[at + 5 : at + 6].isdigit() or b[at + 6 : at + 7] != b".":
        return None
    places = places or _Places(b)
    starts, ends = places(b"startxref"), places(b"%%EOF")
    k = bisect.bisect_left(starts, at)
    j = bisect.bisect_left(ends, starts[k]) if k < len(starts) else len(ends)
    return ends[j] + 5 - at if j < len(ends) else None


def _ogg(b: bytes, at: int) -> int | None:
    """Pages up to the last one of the first page's stream; of pages that follow each other without a gap, all."""
    p, serial, ended = at, None, False
    while b[p : p + 5] == b"OggS\0" and p + 27 <= len(b):
        flags, stream, segments = b[p + 5], b[p + 14 : p + 18], b[p + 26]
        if serial is None:
            if not flags & 2:
                return None
            serial = stream
        end = p + 27 + segments + sum(b[p + 27 : p + 27 + segments])
        if end > len(b):
            return None
        p, ended = end, ended or (flags & 4 and stream == serial)
        if ended:
            return p - at
    return None


def _flac(b: bytes, at: int) -> int | None:
    p, first = at + 4, True
    while p + 4 <= len(b):
        kind, n = b[p], int.from_bytes(b[p + 1 : p + 4], "big")
        if first and (kind & 127, n) != (0, 34):
            return None
        p, first = p + 4 + n, False
        if kind & 128:
            return len(b) - at if b[p : p + 1] == b"\xff" and b[p + 1 : p + 2] in (b"\xf8", b"\xf9") else None
    return None


#: Fixed values of the format: kilobits a second by index, layer III of MPEG 1 and of MPEG 2; samples a second of MPEG 1.
_MP3_RATES = ((32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320), (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160))
_MP3_SAMPLES = (44100, 48000, 32000)


def _mp3(b: bytes, at: int) -> int | None:
    """An ID3 tag or none, then three layer III frames at least."""
    p, frames = at, 0
    if b[p : p + 3] == b"ID3":
        if len(b) < p + 10 or max(b[p + 6 : p + 10]) > 127:
            return None
        p += 10 + sum(x << s for x, s in zip(b[p + 6 : p + 10], (21, 14, 7, 0)))
    while p + 4 <= len(b) and b[p] == 0xFF and b[p + 1] & 0xE6 == 0xE2:
        version, rate, samples = b[p + 1] >> 3 & 3, b[p + 2] >> 4, b[p + 2] >> 2 & 3
        if version == 1 or rate in (0, 15) or samples == 3:
            break
        one = version == 3
        hertz = _MP3_SAMPLES[samples] >> (0 if one else 1 if version == 2 else 2)
        n = (144 if one else 72) * 1000 * _MP3_RATES[not one][rate - 1] // hertz + (b[p + 2] >> 1 & 1)
        if p + n > len(b):
            break
        p, frames = p + n, frames + 1
    return p - at if frames >= 3 else None


_TIFF_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


def _tiff(b: bytes, at: int) -> int | None:
    """To the end of the last directory, value or strip that a directory names."""
    e = "<" if b[at : at + 2] == b"II" else ">"
    if len(b) < at + 8:
        return None
    p, far, seen = struct.unpack_from(e + "I", b, at + 4)[0], 8, set()
    while p:
        if p in seen or p < 8 or at + p + 2 > len(b):
            return None
        seen.add(p)
        count = struct.unpack_from(e + "H", b, at + p)[0]
        if not count or at + p + 6 + 12 * count > len(b):
            return None
        strips: dict[int, tuple[int, ...]] = {}
        for q in range(at + p + 2, at + p + 2 + 12 * count, 12):
            tag, kind, n = struct.unpack_from(e + "HHI", b, q)
            if kind not in _TIFF_SIZES:
                return None
            size = _TIFF_SIZES[kind] * n
            where = q + 8 if size <= 4 else at + struct.unpack_from(e + "I", b, q + 8)[0]
            if where + size > len(b):
                return None
            far = max(far, where + size - at)
            if tag in (273, 279, 324, 325) and kind in (3, 4):
                strips[tag] = struct.unpack_from(f"{e}{n}{'H' if kind == 3 else 'I'}", b, where)
        for begin, size in ((273, 279), (324, 325)):
            far = max([far, *(x + n for x, n in zip(strips.get(begin, ()), strips.get(size, ())))])
        far = max(far, p + 6 + 12 * count)
        p = struct.unpack_from(e + "I", b, at + p + 2 + 12 * count)[0]
    return far if seen and at + far <= len(b) else None


def _mp4(b: bytes, at: int) -> int | None:
    """Boxes from the one of ``ftyp``, with a ``moov`` or ``moof`` among them."""
    p, kinds = at, set()
    while p + 8 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        if n == 1 and p + 16 <= len(b):
            n = struct.unpack_from(">Q", b, p + 8)[0]
        n = n or len(b) - p
        if n < 8 or p + n > len(b) or not all(32 <= c < 127 or c == 0xA9 for c in kind):
            break
        kinds.add(kind)
        p += n
    return p - at if kinds & {b"moov", b"moof"} else None


def _vint(b: bytes, p: int) -> tuple[int, int | None]:
    """Width and value of an EBML size; None: unknown size. Width 0: none is there."""
    width = 9 - b[p].bit_length() if p < len(b) and b[p] else 0
    if not width or p + width > len(b):
        return 0, None
    value = int.from_bytes(b[p : p + width], "big") & ((1 << 7 * width) - 1)
    return width, None if value == (1 << 7 * width) - 1 else value


def _matroska(b: bytes, at: int) -> int | None:
    w, n = _vint(b, at + 4)
    if not w or n is None or at + 4 + w + n > len(b) or not re.search(rb"\x42\x82.(?:webm|matroska)", b[at + 4 + w : at + 4 + w + n], re.S):
        return None
    p = at + 4 + w + n
    v, size = _vint(b, p + 4)
    if b[p : p + 4] != b"\x18\x53\x80\x67" or not v:
        return None
    end = len(b) if size is None else p + 4 + v + size
    return end - at if end <= len(b) else None


def _gzip(b: bytes, at: int) -> int | None:
    inflate, p = zlib.decompressobj(31), at
    try:
        while p < len(b) and not inflate.eof:
            data = b[p : p + 65536]
            while data:  # what comes out is dropped a block at a time
                inflate.decompress(data, 1 << 20)
                data = inflate.unconsumed_tail
            p += 65536
    except zlib.error:
        return None
    return min(p, len(b)) - at - len(inflate.unused_data) if inflate.eof else None


#: Magic bytes -> (type, validator, bytes before the magic).
FORMATS: dict[bytes, tuple[str, Callable[[bytes, int], int | None], int]] = {
    b"RIFF": ("riff", _riff, 0), b"\x89PNG\r\n\x1a\n": ("image/png", _png, 0), b"GIF87a": ("image/gif", _gif, 0), b"GIF89a": ("image/gif", _gif, 0),
    b"\xff\xd8\xff": ("image/jpeg", _jpeg, 0), b"BM": ("image/bmp", _bmp, 0), b"%PDF-": ("application/pdf", _pdf, 0), b"\x1f\x8b\x08": ("application/gzip", _gzip, 0),
    b"OggS": ("audio/ogg", _ogg, 0), b"fLaC": ("audio/flac", _flac, 0), b"II*\0": ("image/tiff", _tiff, 0), b"MM\0*": ("image/tiff", _tiff, 0),
    b"ftyp": ("video/mp4", _mp4, 4), b"\x1aE\xdf\xa3": ("matroska", _matroska, 0), b"ID3": ("audio/mpeg", _mp3, 0),
    b"\xff\xfb": ("audio/mpeg", _mp3, 0), b"\xff\xfa": ("audio/mpeg", _mp3, 0), b"\xff\xf3": ("audio/mpeg", _mp3, 0), b"\xff\xf2": ("audio/mpeg", _mp3, 0),
}
_RIFF_TYPES = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/x-msvideo"}


@functools.cache
def _automaton():
    found = ahocorasick.Automaton()
    for magic in FORMATS:
        found.add_word(magic.decode("latin-1"), magic)
    found.make_automaton()
    return found


def sniff(data: bytes) -> tuple[str, int, list[tuple[str, int, int]]]:
    """Type and valid length of the medium at the start (unknown: 0), and (type, offset, length) of each one carved behind or in it."""
    kind, length, carved, free, places = UNKNOWN, 0, [], 0, _Places(data)
    for end, magic in _automaton().iter(data.decode("latin-1")):
        name, valid, before = FORMATS[magic]
        at = end - len(magic) + 1 - before
        if at < 0 or at and at < free:
            continue
        n = _pdf(data, at, places) if valid is _pdf else valid(data, at)
        if not n:
            continue
        if name == "riff":
            name = _RIFF_TYPES[data[at + 8 : at + 12]]
        elif name == "matroska":
            name = "video/webm" if b"webm" in data[at : at + 64] else "video/x-matroska"
        if at == 0:
            kind, length = name, n
        else:
            carved.append((name, at, n))
            free = at + n
    return kind, length, carved


def judged(declared: str | None, found: str) -> tuple[str, bool]:
    """The type to use, and whether it corrects the declared one. What sniffing does not know leaves a declared type as it is."""
    if found == UNKNOWN:
        return declared or UNKNOWN, False
    return found, declared is not None and declared.lower() != found


def sniffed(table: DataFrame, id_col: str, media_col: str, declared_col: str | None = None) -> DataFrame:
    """A row for each row: (id, media_type, valid_bytes, corrected, embedded array of (type, offset, length)).

    Null and empty media have a null type, 0 bytes and nothing embedded; corrected says whether a declared type (null: none) differs
    from the one found. A type that is not known stays as declared. Bytes behind the valid length are kept in view for carving. Repeated rows and null ids each give a row;
    an empty table gives an empty result; other columns are not read.
    """
    embedded = pa.list_(pa.struct([("type", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    def run(batches):
        for batch in batches:
            types, sizes, corrected, inside = [], [], [], []
            for data, declared in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kind, n, carved = sniff(data) if data else (None, 0, [])
                kind, wrong = judged(declared, kind) if data else (None, False)
                types.append(kind)
                sizes.append(n)
                corrected.append(wrong)
                inside.append([{"type": t, "offset": at, "length": k} for t, at, k in carved])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(types, pa.string()), pa.array(sizes, pa.int64()), pa.array(corrected, pa.bool_()), pa.array(inside, embedded)], names=["id", "media_type", "valid_bytes", "corrected", "embedded"])

    declared = F.col(declared_col) if declared_col else F.lit(None)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).cast("binary").alias("media"), declared.cast("string").alias("declared"))
    return rows.mapInArrow(run, "id long, media_type string, valid_bytes long, corrected boolean, embedded array<struct<type: string, offset: long, length: long>>")


def store_samples(payload: bytes, rate: int = 16000) -> bytes:
    """A WAV of one channel of 8-bit samples that are the payload's bytes."""
    head = struct.pack("<4sIHHIIHH4sI", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    body = b"WAVE" + head + payload + b"\0" * (len(payload) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_samples(media: bytes) -> tuple[bytes, int, int, int]:
    """Samples, channels, bits and rate of a WAV."""
    if not _riff(media, 0) or media[8:12] != b"WAVE":
        raise ValueError("not a whole WAV")
    p, form = 12, None
    while True:
        kind, n = struct.unpack_from("<4sI", media, p)
        if kind == b"fmt ":
            form = struct.unpack_from("<HHIIHH", media, p + 8)
        if kind == b"data" and form:
            return media[p + 8 : p + 8 + n], form[1], form[5], form[2]
        p += 8 + n + (n & 1)


def feature(samples: bytes, channels: int, bits: int, rate: int, found: tuple[str, int, list]) -> str:
    """Whole-number features of 8-bit samples, with what sniffing found."""
    x = np.frombuffer(samples, np.uint8)
    bins = np.bincount(x >> 5, minlength=8)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    energy = int(np.square(x.astype(np.int64) - 128).sum())
    inside = ",".join(f"{t}@{at}+{n}" for t, at, n in found[2])
    return f"{found[0]};{channels}x{bits}@{rate};peak={int(x.max())};energy={energy};crossings={crossings};bins={'/'.join(map(str, bins))};embedded={inside}"


def stored_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: str = "text/plain") -> DataFrame:
    """Each text as a WAV of its bytes, read back and described; null counts as empty.

    The payload is the UTF-8 text, filled with zero bytes to a positive multiple of 64. Returns doc_id, n_bytes, payload_bytes,
    payload_sha256, tail_crc32, media_bytes, media_sha256, feature, and media_type with corrected: the column says ``declared``, and sniffing
    finds what is stored. Equal texts give equal values. Repeated rows and
    null ids each give a row; an empty table gives an empty result; other columns are not read.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for text in pc.cast(batch.column(1), pa.binary()):
                raw = text.as_py() or b""
                payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
                media = store_samples(payload)
                found = sniff(media)
                samples, *form = read_samples(media)
                rows.append((len(raw), len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples, *form, found), *judged(declared, found[0])))
            columns = list(zip(*rows)) or [[]] * 9
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media_type string, corrected boolean"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)
