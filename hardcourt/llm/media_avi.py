"""Media columns as AVI motion-JPEG: bytes stored as grey frames, RIFF indexes parsed, intra frames decoded, shots found.

Frames are lossless JPEG (process SOF3, 8-bit samples, predictor 1, a restart marker after every line), so what is read
back equals what was stored. A line is WIDTH samples, a frame HEIGHT lines at most; the last frame is filled with zero
lines and a chunk `plen` beside the stream headers keeps the payload's length. Restart markers let all lines of many
frames be decoded side by side.

Shots end where the difference of successive frames' histograms is above the mean of the differences just before plus
DEVIATIONS times their standard deviation (and above FLOOR). Each shot is a clip row with its times.

A null text counts as empty; every payload has 64 bytes at least. Repeated rows are stored each; an empty table gives no
rows; other columns are not read. Memory follows one batch of rows, in which the frames are coded CHUNK at a time. Media
that is no AVI of such frames gives no payload and no clips.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.runtime import ship, table

WIDTH, HEIGHT = 64, 16
FRAME_MS = 40
CHUNK = 1024
BINS, BEFORE, DEVIATIONS, FLOOR = 16, 8, 2.0, 0.35

# Huffman table: the nine categories of an 8-bit difference, all with four-bit codes.
_LENGTHS, _SYMBOLS = [0, 0, 0, 9] + [0] * 12, list(range(9))
_DIFF = np.arange(-255, 256)
_CATEGORY = np.array([abs(int(d)).bit_length() for d in _DIFF], np.uint32)
_BITS = (4 + _CATEGORY).astype(np.int64)
_CODE = ((_CATEGORY << _CATEGORY) | np.where(_DIFF >= 0, _DIFF, _DIFF + (1 << _CATEGORY) - 1).astype(np.uint32)).astype(np.uint32)


def jpeg_head(lines: int) -> bytes:
    """Everything of a frame up to its entropy-coded data."""

    def part(marker: int, body: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body

    frame = part(0xC3, struct.pack(">BHHBBBB", 8, lines, WIDTH, 1, 1, 0x11, 0))
    codes = part(0xC4, bytes([0, *_LENGTHS, *_SYMBOLS]))
    return b"\xff\xd8" + frame + codes + part(0xDD, struct.pack(">H", WIDTH)) + part(0xDA, bytes([1, 1, 0, 1, 0, 0]))


def encode_frames(raw: list[bytes]) -> list[bytes]:
    """Grey frames of WIDTH samples a line to JPEG."""
    out: list[bytes] = []
    for k in range(0, len(raw), CHUNK):
        out += _encoded(raw[k : k + CHUNK])
    return out


def _encoded(raw: list[bytes]) -> list[bytes]:
    x = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, WIDTH).astype(np.int16)
    lines = np.array([len(r) // WIDTH for r in raw])
    at = np.diff(x, axis=1, prepend=np.int16(128)) + 255
    bits = _BITS[at]
    ends = np.cumsum(bits, axis=1)
    size = (ends[:, -1] + 7) >> 3
    first = np.cumsum(size) - size
    place = (first[:, None] * 8 + ends - bits).ravel()
    window = _CODE[at].ravel() << (24 - bits.ravel() - (place & 7)).astype(np.uint32)
    place >>= 3
    total = int(size.sum())
    data = sum(np.bincount(place + j, weights=(window >> np.uint32(16 - 8 * j)) & np.uint32(255), minlength=total + 3)[:total] for j in range(3)).astype(np.uint8)
    data[first + size - 1] |= ((1 << (size * 8 - ends[:, -1])) - 1).astype(np.uint8)
    # a zero after every 0xFF, a marker after every line
    full = data == 255
    shift = np.cumsum(full) - full
    line = np.repeat(np.arange(len(x)), size)
    goes = np.arange(total) + shift + 2 * line
    done = np.zeros(total + int(full.sum()) + 2 * len(x), np.uint8)
    done[goes] = data
    last = first + size - 1
    mark = goes[last] + 1 + full[last]
    stop = np.cumsum(lines)
    number = np.arange(len(x)) - np.repeat(stop - lines, lines)
    done[mark] = 255
    done[mark + 1] = 0xD0 + number % 8
    done[mark[stop - 1] + 1] = 0xD9
    cut = [0, *(mark[stop - 1] + 2).tolist()]
    body, heads = done.tobytes(), {n: jpeg_head(n) for n in {*lines.tolist()}}
    return [heads[n] + body[a:b] for n, a, b in zip(lines.tolist(), cut, cut[1:], strict=False)]


HEAD = len(jpeg_head(1))
_heads: dict[bytes, tuple] = {}


def jpeg_parts(jpeg: bytes) -> tuple | None:
    """(lines, where the coded data starts, table of symbols, table of code lengths); None if not of this kind."""
    if (known := _heads.get(jpeg[:HEAD])) is not None:
        return known
    at, lines, symbols, widths, restart = 2, 0, None, None, 0
    if jpeg[:2] != b"\xff\xd8":
        return None
    while at + 4 <= len(jpeg):
        marker, size = jpeg[at + 1], int.from_bytes(jpeg[at + 2 : at + 4], "big")
        body = jpeg[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC3:
            depth, lines, width, parts = struct.unpack(">BHHB", body[:6])
            if (depth, width, parts) != (8, WIDTH, 1):
                return None
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            return None
        elif marker == 0xC4 and body[0] == 0:
            symbols, widths = np.zeros(1 << 16, np.uint64), np.full(1 << 16, 16, np.uint64)
            code, value = 0, 17
            for length in range(1, 17):
                for _ in range(body[length]):
                    low = code << (16 - length)
                    symbols[low : low + (1 << (16 - length))], widths[low : low + (1 << (16 - length))] = body[value], length
                    code, value = code + 1, value + 1
                code <<= 1
        elif marker == 0xDD:
            restart = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            if symbols is None or restart != WIDTH or body[3] != 1 or not lines:
                return None
            if len(_heads) > 64:
                _heads.clear()
            _heads[jpeg[:at]] = (lines, at, symbols, widths)
            return _heads[jpeg[:at]]
    return None


def decode_frames(jpegs: list[bytes]) -> list[bytes] | None:
    out: list[bytes] = []
    for k in range(0, len(jpegs), CHUNK):
        found = _decoded(jpegs[k : k + CHUNK])
        if found is None:
            return None
        out += found
    return out


def _decoded(jpegs: list[bytes]) -> list[bytes] | None:
    parts = [jpeg_parts(j) for j in jpegs]
    if any(p is None for p in parts):
        return None
    if any(p[2] is not parts[0][2] and not np.array_equal(p[2], parts[0][2]) for p in parts):
        return [x for j in jpegs for x in _decoded([j]) or [b""]]
    _, _, symbols, widths = parts[0]
    coded = np.frombuffer(b"".join(j[p[1] :] for j, p in zip(jpegs, parts, strict=True)), np.uint8)
    after = np.append(coded[1:], 0)
    full = coded == 255
    marks = np.flatnonzero(full & (after >= 0xD0) & (after <= 0xD9))
    lines = np.array([p[0] for p in parts])
    if len(marks) != lines.sum():
        return None
    keep = ~np.append(False, full[:-1] & (coded[1:] == 0))
    new = np.cumsum(keep) - keep
    clean = np.append(coded[keep], np.zeros(8, np.uint8)).astype(np.uint64)
    window = (clean[:-3] << np.uint64(24)) | (clean[1:-2] << np.uint64(16)) | (clean[2:-1] << np.uint64(8)) | clean[3:]
    place = new[np.append(0, marks[:-1] + 2)].astype(np.int64) * 8
    samples = np.zeros((len(marks), WIDTH), np.uint8)
    past = np.full(len(marks), 128, np.int64)
    for k in range(WIDTH):
        v = (window[place >> 3] << (place & 7).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
        at = (v >> np.uint64(16)).astype(np.int64)
        category, length = symbols[at], widths[at]
        extra = (((v << length) & np.uint64(0xFFFFFFFF)) >> (np.uint64(32) - category)).astype(np.int64)
        place += (length + category).astype(np.int64)
        top = np.left_shift(1, category.astype(np.int64))
        past = (past + np.where(extra * 2 < top, extra - top + 1, extra) * (category > 0)) & 255
        samples[:, k] = past
        place = np.minimum(place, (len(window) - 1) * 8)
    body, cut = samples.tobytes(), [0, *(np.cumsum(lines) * WIDTH).tolist()]
    return [body[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def avi(frames: list[bytes], lines: int, payload: int) -> bytes:
    """The RIFF file of JPEG frames, with its index."""
    most = max(map(len, frames))
    main = struct.pack("<14I", FRAME_MS * 1000, 0, 0, 0x10, len(frames), 0, 1, most, WIDTH, lines, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, FRAME_MS, 1000, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, WIDTH, lines)
    kind = struct.pack("<IiiHH4sIiiII", 40, WIDTH, lines, 1, 8, b"MJPG", WIDTH * lines, 0, 0, 0, 0)
    head = b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", kind)) + _chunk(b"plen", struct.pack("<Q", payload))
    body, index, at = [b"movi"], [], 4
    for f in frames:
        piece = _chunk(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        body.append(piece)
        at += len(piece)
    return _chunk(b"RIFF", b"AVI " + _chunk(b"LIST", head) + _chunk(b"LIST", b"".join(body)) + _chunk(b"idx1", b"".join(index)))


def riff_parts(media: bytes) -> tuple[list[bytes], int | None, int]:
    """The frames an AVI file's index names (or its movi list holds), the payload's length if noted, ms a frame."""
    if media[:4] != b"RIFF" or media[8:12] != b"AVI ":
        return [], None, FRAME_MS
    movi, index, payload, ms = None, None, None, FRAME_MS
    todo = [(12, len(media))]
    while todo:
        at, end = todo.pop()
        while at + 8 <= end:
            name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
            if name == b"LIST" and media[at + 8 : at + 12] == b"movi":
                movi = (at + 8, min(at + 8 + size, len(media)))
            elif name == b"LIST":
                todo.append((at + 12, min(at + 8 + size, end)))
            elif name == b"idx1":
                index = media[at + 8 : at + 8 + size]
            elif name == b"plen":
                payload = int.from_bytes(media[at + 8 : at + 16], "little")
            elif name == b"avih":
                ms = max(1, int.from_bytes(media[at + 8 : at + 12], "little") // 1000)
            at += 8 + size + (size & 1)
    frames = []
    if movi and index:
        for name, _, at, size in struct.iter_unpack("<4sIII", index[: len(index) // 16 * 16]):
            base = movi[0] if media[movi[0] + at : movi[0] + at + 4] == name else 0  # some writers count from the file's start
            if name[2:] in (b"dc", b"db"):
                frames.append(media[base + at + 8 : base + at + 8 + size])
    elif movi:
        at = movi[0] + 4
        while at + 8 <= movi[1]:
            size = int.from_bytes(media[at + 4 : at + 8], "little")
            if media[at + 2 : at + 4] in (b"dc", b"db"):
                frames.append(media[at + 8 : at + 8 + size])
            at += 8 + size + (size & 1)
    return frames, payload, ms


def shots(frames: list[bytes]) -> list[tuple[int, int]]:
    """Frame ranges (end exclusive) between cuts."""
    n = len(frames)
    if n < 2:
        return [(0, n)] if n else []
    rows = np.repeat(np.arange(n), [len(f) for f in frames]) * BINS + np.frombuffer(b"".join(frames), np.uint8) // (256 // BINS)
    histogram = np.bincount(rows, minlength=n * BINS).reshape(n, BINS) / np.array([[len(f)] for f in frames])
    change = np.abs(np.diff(histogram, axis=0)).sum(axis=1)
    s1, s2 = (np.append(0.0, np.cumsum(v)) for v in (change, change * change))
    i = np.arange(n - 1)
    low = np.maximum(0, i - BEFORE)
    count = np.maximum(1, i - low)
    mean = (s1[i] - s1[low]) / count
    spread = np.sqrt(np.maximum(0, (s2[i] - s2[low]) / count - mean * mean))
    cuts = np.flatnonzero(change > np.maximum(FLOOR, mean + DEVIATIONS * spread)) + 1
    edges = [0, *cuts.tolist(), n]
    return [*zip(edges, edges[1:], strict=False)]


def payload_of(text: str | None) -> tuple[int, bytes]:
    data = (text or "").encode("utf-8", "replace")
    return len(data), data + b"\0" * (max(64, -(-len(data) // 64) * 64) - len(data))


def grouped(values: list, size, most: int) -> Iterator[list]:
    """Runs of values of about `most` bytes."""
    run, n = [], 0
    for v in values:
        run.append(v)
        n += size(v)
        if n >= most:
            yield run
            run, n = [], 0
    if run:
        yield run


def media_column(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media): every text stored as an AVI file."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [*range(batch.num_rows)]
            texts = batch.column(1)
            for run in grouped(rows, lambda i: len(texts[i].as_py() or ""), CHUNK * WIDTH * HEIGHT):
                sizes, heights, raw, counts, lengths = [], [], [], [], []
                for i in run:
                    n, data = payload_of(texts[i].as_py())
                    lines = min(HEIGHT, len(data) // WIDTH)
                    step_ = lines * WIDTH
                    frames = [data[k : k + step_].ljust(step_, b"\0") for k in range(0, len(data), step_)]
                    sizes.append(n)
                    heights.append(lines)
                    lengths.append(len(data))
                    counts.append(len(frames))
                    raw += frames
                coded = encode_frames(raw)
                media, at = [], 0
                for lines, n, length in zip(heights, counts, lengths, strict=True):
                    media.append(avi(coded[at : at + n], lines, length))
                    at += n
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(run)), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], [key, "n_bytes", "media"])

    return docs.select(key, text).mapInArrow(step, f"{key} {kind}, n_bytes long, media binary")


CLIPS = "array<struct<clip:int,start_ms:long,end_ms:long,frames:int>>"


def read_media(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the stored files hold: payload sizes and digests, clips with their times. media: (key, media, ...)."""
    ship(media.sparkSession)
    others = [c for c in media.columns if c not in (key, "media")]
    schema = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in (key, *others))
    clip = pa.list_(pa.struct([("clip", pa.int32()), ("start_ms", pa.int64()), ("end_ms", pa.int64()), ("frames", pa.int32())]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for run in grouped([*range(batch.num_rows)], lambda i: len(column[i].as_py() or b""), CHUNK * WIDTH * HEIGHT):
                out: list[tuple] = []
                files = [column[i].as_py() or b"" for i in run]
                parts = [riff_parts(f) for f in files]
                everything = decode_frames([j for frames, _, _ in parts for j in frames])
                at = 0
                for file, (frames, length, ms) in zip(files, parts, strict=True):
                    raw = everything[at : at + len(frames)] if everything is not None else decode_frames(frames)
                    at += len(frames)
                    if not raw:
                        out.append((None, None, None, len(file), hashlib.sha256(file).hexdigest(), None))
                        continue
                    data = b"".join(raw)[:length]
                    clips = [{"clip": k, "start_ms": a * ms, "end_ms": b * ms, "frames": b - a} for k, (a, b) in enumerate(shots(raw))]
                    out.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(file), hashlib.sha256(file).hexdigest(), clips))
                columns = [*zip(*out, strict=True)]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), clip)
                kept = [batch.column(k).take(pa.array(run)) for k in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], [key, *others, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "clips"])

    return media.select("media", key, *others).mapInArrow(step, f"{schema}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, clips {CLIPS}")


def clip_rows(read: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per clip: key, clip, start_ms, end_ms, frames."""
    return read.select(key, F.inline("clips"))


def op8_avi_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_media(media_column(table(spark, sf_dir, "documents")))
    feature = F.array_join(F.transform("clips", lambda c: F.concat_ws("-", c["start_ms"], c["end_ms"])), ",")
    return found.withColumn("feature", feature).drop("clips")
