"""Matroska columns: muxing 8-bit PCM, parsing EBML back into packet tables, and features of the stored samples.

``mux`` writes a small audio file, ``parse`` reads any Matroska bytes: variable-length EBML elements (also of unknown
size), clusters, SimpleBlocks and BlockGroups, all four lacing modes, and cues. ``packet_table`` and ``cue_table`` turn a
binary column into one row per frame or cue with timestamps, tracks and byte ranges. Damaged or truncated files yield the
packets before the damage and ``complete`` False, and so do numbers that no long or no finite number holds; null or empty
files yield no packets. Every row is read by itself: repeated rows and null ids are rows like others, equal files give equal
rows, very long texts are stored whole, an empty table gives no rows, other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, columns, text_of

# Element ids of the published EBML and Matroska specifications (RFC 8794, RFC 9559).
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
FLAG_LACING, DEFAULT_DURATION, AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0x9C, 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
REFERENCE_BLOCK = 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1

NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3
SAMPLE_RATE, FRAME, FRAMES_PER_BLOCK, BLOCKS_PER_CLUSTER = 8000, 1024, 8, 16
UNIT = 64
GROUP = 256


class Packet(NamedTuple):
    track: int
    timestamp_ns: int
    keyframe: bool
    lacing: int
    offset: int
    length: int


class Cue(NamedTuple):
    timestamp_ns: int
    track: int
    cluster_offset: int


class Parsed(NamedTuple):
    tracks: dict[int, dict]
    packets: list[Packet]
    cues: list[Cue]
    clusters: int
    blocks: int
    duration_ns: int
    complete: bool


# --- writing -----------------------------------------------------------------------------------------------------


def write_vint(value: int, width: int = 0) -> bytes:
    """A size as EBML variable-length integer; all-ones values are reserved, so they take one byte more."""
    width = width or next(n for n in range(1, 9) if value < (1 << 7 * n) - 1)
    return ((1 << 7 * width) | value).to_bytes(width, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + write_vint(len(body)) + body


def unsigned(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def laced(frames: list[memoryview], lacing: int) -> bytes:
    """The lace header that precedes the frames: their number less one, then sizes of all but the last."""
    if lacing == NO_LACING:
        return b""
    head = bytes([len(frames) - 1])
    sizes = [len(f) for f in frames[:-1]]
    if lacing == XIPH:
        return head + b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes)
    if lacing == EBML_LACING:
        out = head + write_vint(sizes[0])
        for a, b in zip(sizes, sizes[1:]):
            d = b - a
            width = next(n for n in range(1, 9) if abs(d) < (1 << (7 * n - 1)) - 1)
            out += write_vint(d + (1 << (7 * width - 1)) - 1, width)
        return out
    return head


def block(track: int, relative: int, frames: list[memoryview], lacing: int) -> bytes:
    head = write_vint(track) + struct.pack(">hB", relative, 0x80 | lacing << 1)
    return head + laced(frames, lacing) + b"".join(frames)


def mux(payload: bytes) -> bytes:
    """One mono 8-bit PCM track at 8 kHz; the lacing mode goes round with the block's number, fixed only for equal frames."""
    view = memoryview(payload)
    header = element(EBML, unsigned(EBML_VERSION, 1) + unsigned(EBML_READ_VERSION, 1) + unsigned(EBML_MAX_ID, 4) + unsigned(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + unsigned(DOC_TYPE_VERSION, 4) + unsigned(DOC_TYPE_READ_VERSION, 2))
    info = element(INFO, unsigned(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / SAMPLE_RATE)) + element(MUXING_APP, b"taxalith") + element(WRITING_APP, b"taxalith"))
    audio = element(SAMPLING_FREQUENCY, struct.pack(">d", SAMPLE_RATE)) + unsigned(CHANNELS, 1) + unsigned(BIT_DEPTH, 8)
    entry = unsigned(TRACK_NUMBER, 1) + unsigned(TRACK_UID, 1) + unsigned(TRACK_TYPE, 2) + unsigned(FLAG_LACING, 1) + unsigned(DEFAULT_DURATION, FRAME * 1_000_000_000 // SAMPLE_RATE) + element(CODEC_ID, b"A_PCM/INT/LIT") + element(AUDIO, audio)
    body = [info, element(TRACKS, element(TRACK_ENTRY, entry))]
    position, cues, number = sum(map(len, body)), [], 0
    per_block, per_cluster = FRAME * FRAMES_PER_BLOCK, FRAME * FRAMES_PER_BLOCK * BLOCKS_PER_CLUSTER
    for start in range(0, len(payload), per_cluster):
        base = start * 1000 // SAMPLE_RATE
        blocks = [unsigned(CLUSTER_TIMESTAMP, base)]
        for at in range(start, min(start + per_cluster, len(payload)), per_block):
            end = min(at + per_block, len(payload))
            frames = [view[i : min(i + FRAME, end)] for i in range(at, end, FRAME)]
            lacing = (XIPH, FIXED, EBML_LACING)[number % 3] if len(frames) > 1 else NO_LACING
            if lacing == FIXED and len(frames[-1]) != FRAME:
                lacing = EBML_LACING
            blocks.append(element(SIMPLE_BLOCK, block(1, at * 1000 // SAMPLE_RATE - base, frames, lacing)))
            number += 1
        cluster = element(CLUSTER, b"".join(blocks))
        cues.append(element(CUE_POINT, unsigned(CUE_TIME, base) + element(CUE_TRACK_POSITIONS, unsigned(CUE_TRACK, 1) + unsigned(CUE_CLUSTER_POSITION, position))))
        position += len(cluster)
        body.append(cluster)
    body.append(element(CUES, b"".join(cues)))
    return header + element(SEGMENT, b"".join(body))


# --- reading -----------------------------------------------------------------------------------------------------


class Damaged(ValueError):
    pass


def read_id(data: bytes, at: int) -> tuple[int, int]:
    if at >= len(data) or not data[at]:
        raise Damaged(f"no element id at {at}")
    width = 9 - data[at].bit_length()
    if width > 4 or at + width > len(data):
        raise Damaged(f"bad element id at {at}")
    return int.from_bytes(data[at : at + width], "big"), at + width


def read_vint(data: bytes, at: int, end: int | None = None) -> tuple[int, int, int]:
    """Value (-1: unknown), position behind it, and width."""
    end = len(data) if end is None else end
    if at >= end or not data[at]:
        raise Damaged(f"no size at {at}")
    width = 9 - data[at].bit_length()
    if at + width > end:
        raise Damaged(f"cut size at {at}")
    value = int.from_bytes(data[at : at + width], "big") & ((1 << 7 * width) - 1)
    return (-1 if value == (1 << 7 * width) - 1 else value), at + width, width


def children(data: bytes, at: int, end: int, stop: frozenset[int] = frozenset()) -> Iterator[tuple[int, int, int]]:
    """(id, start, end) of each child element; a child of unknown size lasts until an id in stop or its parent's end."""
    while at < end:
        ident, body = read_id(data, at)
        if ident in stop:
            return
        size, body, _ = read_vint(data, body, end)
        last = end if size < 0 else body + size
        if last > end:
            raise Damaged(f"element {ident:X} at {at} leaves its parent")
        if size < 0 and ident == CLUSTER:
            last = body
            for _, _, last in children(data, body, end, frozenset({CLUSTER, CUES, INFO, TRACKS})):
                pass
        yield ident, body, last
        at = last


def fits(value: int) -> int:
    """The value, which a long must hold."""
    if not -(1 << 63) <= value < 1 << 63:
        raise Damaged(f"{value} is too large")
    return value


def uint(data: bytes, at: int, end: int) -> int:
    return fits(int.from_bytes(data[at:end], "big"))


def real(data: bytes, at: int, end: int) -> float:
    value = 0.0 if at == end else struct.unpack(">d" if end - at == 8 else ">f", data[at:end])[0]
    if not math.isfinite(value):
        raise Damaged(f"no number at {at}")
    return value


def frame_sizes(data: bytes, at: int, end: int, lacing: int) -> tuple[list[int], int]:
    """Sizes of a block's frames and where the first one starts."""
    if lacing == NO_LACING:
        return [end - at], at
    if at >= end:
        raise Damaged(f"no lace header at {at}")
    count, at, sizes = data[at] + 1, at + 1, []
    if lacing == FIXED:
        if (end - at) % count:
            raise Damaged(f"frames of unequal size at {at}")
        return [(end - at) // count] * count, at
    for i in range(count - 1):
        if lacing == XIPH:
            size = 0
            while True:
                if at >= end:
                    raise Damaged(f"cut lace at {at}")
                size, at = size + data[at], at + 1
                if data[at - 1] != 255:
                    break
        else:
            value, at, width = read_vint(data, at, end)
            size = value if i == 0 else sizes[-1] + value - ((1 << (7 * width - 1)) - 1)
        sizes.append(size)
    rest = end - at - sum(sizes)
    if rest < 0 or min(sizes, default=0) < 0:
        raise Damaged(f"laces leave their block at {at}")
    return [*sizes, rest], at


def parse(data: bytes | None) -> Parsed:
    """Tracks, packets in file order, and cues of a Matroska file."""
    data = data or b""
    tracks, packets, cues, clusters, blocks, duration, scale = {}, [], [], 0, 0, 0.0, 1_000_000

    def read_block(at: int, end: int, base: int, simple: bool, key: bool) -> None:
        track, at, _ = read_vint(data, at, end)
        if at + 3 > end:
            raise Damaged(f"cut block at {at}")
        relative, flags = struct.unpack(">hB", data[at : at + 3])
        lacing = flags >> 1 & 3
        sizes, at = frame_sizes(data, at + 3, end, lacing)
        step = tracks.get(track, {}).get("default_duration", 0)
        for i, size in enumerate(sizes):
            packets.append(Packet(track, fits((base + relative) * scale + i * step), bool(flags & 0x80) if simple else key, lacing, at, size))
            at += size

    try:
        for top, at, end in children(data, 0, len(data)):
            if top != SEGMENT:
                continue
            origin = at
            for ident, at, end in children(data, at, end):
                if ident == INFO:
                    for k, a, b in children(data, at, end):
                        if k == TIMESTAMP_SCALE:
                            scale = uint(data, a, b)
                        elif k == DURATION:
                            duration = real(data, a, b)
                    fits(round(duration * scale))
                elif ident == TRACKS:
                    for _, a, b in children(data, at, end):
                        track = {"default_duration": 0}
                        for k, c, d in children(data, a, b):
                            if k == TRACK_NUMBER:
                                tracks[uint(data, c, d)] = track
                            elif k == TRACK_TYPE:
                                track["type"] = uint(data, c, d)
                            elif k == CODEC_ID:
                                track["codec"] = data[c:d].decode("ascii", "replace")
                            elif k == DEFAULT_DURATION:
                                track["default_duration"] = uint(data, c, d)
                            elif k == AUDIO:
                                for kk, e, f in children(data, c, d):
                                    if kk == SAMPLING_FREQUENCY:
                                        track["rate"] = real(data, e, f)
                                    elif kk == BIT_DEPTH:
                                        track["bits"] = uint(data, e, f)
                elif ident == CLUSTER:
                    clusters, base = clusters + 1, 0
                    for k, a, b in children(data, at, end):
                        if k == CLUSTER_TIMESTAMP:
                            base = uint(data, a, b)
                        elif k == SIMPLE_BLOCK:
                            read_block(a, b, base, True, True)
                            blocks += 1
                        elif k == BLOCK_GROUP:
                            inner = list(children(data, a, b))
                            key = all(x != REFERENCE_BLOCK for x, _, _ in inner)
                            for x, c, d in inner:
                                if x == BLOCK:
                                    read_block(c, d, base, False, key)
                                    blocks += 1
                elif ident == CUES:
                    for _, a, b in children(data, at, end):
                        time, places = 0, []
                        for k, c, d in children(data, a, b):
                            if k == CUE_TIME:
                                time = uint(data, c, d)
                            elif k == CUE_TRACK_POSITIONS:
                                found = {x: uint(data, e, f) for x, e, f in children(data, c, d)}
                                places.append((found.get(CUE_TRACK, 0), origin + found.get(CUE_CLUSTER_POSITION, 0)))
                        cues.extend(Cue(fits(time * scale), track, fits(place)) for track, place in places)
        complete = bool(data)
    except (Damaged, struct.error):
        complete = False
    length = duration * scale
    return Parsed(tracks, packets, cues, clusters, blocks, round(length) if abs(length) < 1 << 63 else 0, complete)


def samples(data: bytes, parsed: Parsed, track: int = 1) -> bytes:
    return b"".join(data[p.offset : p.offset + p.length] for p in parsed.packets if p.track == track)


# --- columns -----------------------------------------------------------------------------------------------------

PACKETS = "track long, timestamp_ns long, keyframe boolean, lacing int, offset long, length long"
CUE_ROWS = "timestamp_ns long, track long, cluster_offset long"
_KINDS = {"bigint": "long"}


def _rows_of(df: DataFrame, media: str, key: str, fields: str, part: str) -> DataFrame:
    """Fields called like the key column get an underscore before their name."""
    clean = lambda f: f"_{f}" if f.split()[0].lower() == key.lower() else f
    fields = ", ".join(map(clean, ("n long", *fields.split(", "))))
    schema = f"`{key}` {_KINDS.get(kind := df.schema[key].dataType.simpleString(), kind)}, {fields}"
    names = [f.split()[0] for f in fields.split(", ")]

    def rows(batches):
        for keys, files in columns(batches, key, media):
            out = [(k, i, *row) for k, data in zip(keys, files) for i, row in enumerate(getattr(parse(data), part))]
            yield pa.RecordBatch.from_pydict({n: [r[j] for r in out] for j, n in enumerate((key, *names))}, schema=arrow_schema(schema))

    return df.select(key, media).mapInArrow(rows, schema)


def packet_table(df: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """One row per frame of each file: key, n (place in the file), track, timestamp, key frame, lacing and byte range."""
    return _rows_of(df, media, key, PACKETS, "packets")


def cue_table(df: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """One row per cue of each file: key, n, timestamp, track and byte position of its cluster."""
    return _rows_of(df, media, key, CUE_ROWS, "cues")


def feature_of(stored: bytes, parsed: Parsed) -> str:
    """What the packets and samples say; equal files give equal strings."""
    wave = np.frombuffer(stored, np.uint8)
    share = np.bincount(wave, minlength=256)
    share = share[share > 0] / max(1, len(wave))
    entropy = float(-(share * np.log2(share)).sum())
    turns = int(np.count_nonzero(np.diff(wave >> 7)))
    return f"clusters={parsed.clusters};blocks={parsed.blocks};packets={len(parsed.packets)};cues={len(parsed.cues)};duration_ns={parsed.duration_ns};last_ns={parsed.packets[-1].timestamp_ns if parsed.packets else 0};mean={wave.mean() if len(wave) else 0:.6f};entropy={entropy:.6f};turns={turns}"


MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, complete boolean"


def payload_of(text: str | None) -> tuple[bytes, int]:
    """A text's UTF-8 bytes padded with zeros to a positive multiple of 64, and their number before padding."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % UNIT or (0 if raw else UNIT)), len(raw)


def as_media(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Stores each text losslessly in a Matroska file: doc_id, n_bytes, media. Null texts are empty, keys may repeat."""

    def rows(batches):
        for keys, texts in columns(batches, "doc_id", "text"):
            files = [payload_of(t) for t in texts]
            yield pa.RecordBatch.from_pydict({"doc_id": keys, "n_bytes": [n for _, n in files], "media": [mux(p) for p, _ in files]}, schema=arrow_schema(MEDIA))

    return df.select(F.col(key).cast("long").alias("doc_id"), text_of(df, text).alias("text")).mapInArrow(rows, MEDIA)


def _features(keys, sizes, files) -> pa.RecordBatch:
    out = {n.split()[0]: [] for n in FEATURES.split(", ")}
    for key, n, data in zip(keys, sizes, files):
        parsed = parse(data)
        stored = samples(data or b"", parsed)
        row = (key, n, len(stored), hashlib.sha256(stored).hexdigest(), zlib.crc32(stored[-UNIT:]), len(data or b""))
        for name, value in zip(out, (*row, hashlib.sha256(data or b"").hexdigest(), feature_of(stored, parsed), parsed.complete)):
            out[name].append(value)
    return pa.RecordBatch.from_pydict(out, schema=arrow_schema(FEATURES))


def media_features(df: DataFrame) -> DataFrame:
    """Reads stored files back (doc_id, n_bytes, media) and returns digests of payload and file with a feature string."""

    def rows(batches):
        for batch in columns(batches, "doc_id", "n_bytes", "media"):
            yield _features(*batch)

    return df.select("doc_id", "n_bytes", "media").mapInArrow(rows, FEATURES)


def document_media(df: DataFrame) -> DataFrame:
    """Every document stored as media and read back; one row per input row.

    The same as ``media_features(as_media(df))``, but only a few files are held at a time, and none leaves its worker.
    """

    def rows(batches):
        for keys, texts in columns(batches, "doc_id", "text"):
            for i in range(0, len(keys), GROUP):
                payloads = [payload_of(t) for t in texts[i : i + GROUP]]
                yield _features(keys[i : i + GROUP], [n for _, n in payloads], (mux(p) for p, _ in payloads))

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(df).alias("text")).mapInArrow(rows, FEATURES)
