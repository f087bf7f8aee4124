"""AVI motion-JPEG with lossless intra frames, on numpy.

A frame is a grey 8-bit picture of WIDTH columns, coded by JPEG's lossless process
(SOF3): each sample's difference from its left neighbour as a Huffman code of the
difference's bit length and that many bits.  A restart marker follows every line,
so lines are decoded side by side, a column at a time over all frames of a batch.
The file is RIFF with hdrl, INFO (the payload's length), movi and idx1; frames are
found by the index.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np

WIDTH, HEIGHT, RATE = 64, 16, 25
#: Bit lengths of differences in the order of their codes, and the codes' lengths.
CATEGORIES = 7, 4, 3, 2, 1, 5, 0, 6, 8
CODE_BITS = 2, 2, 3, 3, 3, 4, 5, 6, 7
LONGEST = 15  # of a code with its bits


def _codes(bits: tuple[int, ...]) -> list[int]:
    """Canonical Huffman codes of the lengths, which don't fall."""
    out, code = [], 0
    for k, n in enumerate(bits):
        if k:
            code = (code + 1) << (n - bits[k - 1])
        out.append(code)
    return out


def _coder() -> tuple[np.ndarray, np.ndarray]:
    """Code with bits, and its length, for each difference + 255."""
    table = {c: (code, n) for c, code, n in zip(CATEGORIES, _codes(CODE_BITS), CODE_BITS, strict=True)}
    values, lengths = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = table[size]
        values[d + 255] = code << size | (d if d >= 0 else d + (1 << size) - 1)
        lengths[d + 255] = n + size
    return values, lengths


VALUES, LENGTHS = _coder()


def frame_header(width: int = WIDTH, height: int = HEIGHT) -> bytes:
    counts = bytes(sum(n == k for n in CODE_BITS) for k in range(1, 17))
    table = b"\x00" + counts + bytes(CATEGORIES)
    return (
        b"\xff\xd8"
        + b"\xff\xc4" + struct.pack(">H", 2 + len(table)) + table
        + b"\xff\xc3" + struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\x01\x11\x00"
        + b"\xff\xdd" + struct.pack(">HH", 4, width)
        + b"\xff\xda" + struct.pack(">HB", 8, 1) + b"\x01\x00" + b"\x01\x00\x00"
    )


def coded_lines(lines: np.ndarray, per_frame: int = HEIGHT) -> tuple[bytes, np.ndarray]:
    """The entropy-coded segments of all lines, each with its marker, and where
    each line's ends."""
    n, width = lines.shape
    before = np.empty_like(lines, np.int16)
    before[:, 0] = 128
    before[:, 1:] = lines[:, :-1]
    which = lines.astype(np.int16) - before + 255
    values, lengths = VALUES[which].reshape(n, -1, 4), LENGTHS[which].reshape(n, -1, 4)
    unit, bits = values[:, :, 0], lengths[:, :, 0]
    for k in range(1, 4):  # four codes of at most 15 bits to a unit
        unit, bits = (unit << lengths[:, :, k].astype(np.uint64)) | values[:, :, k], bits + lengths[:, :, k]
    ends = np.cumsum(bits, axis=1)
    room = width * LONGEST // 8 + 16
    out = np.zeros((n, room), np.uint8)
    flat, base = out.reshape(-1), np.arange(n)[:, None] * room + np.arange(9)
    for u in range(unit.shape[1]):
        at = ends[:, u] - bits[:, u]
        aligned, shift = unit[:, u] << (64 - bits[:, u]).astype(np.uint64), (at & 7).astype(np.uint64)
        nine = np.empty((n, 9), np.uint8)
        nine[:, :8] = (aligned >> shift).byteswap().view(np.uint8).reshape(n, 8)
        nine[:, 8] = ((aligned << (np.uint64(8) - shift)) & np.uint64(255)).astype(np.uint8)
        flat[base + (at >> 3)[:, None]] |= nine
    total = ends[:, -1]
    sizes = (total + 7) >> 3
    odd = np.flatnonzero(total & 7)
    out[odd, sizes[odd] - 1] |= (0xFF >> (total[odd] & 7)).astype(np.uint8)
    raw = out[np.arange(room) < sizes[:, None]]
    full = raw == 255
    line = np.repeat(np.arange(n), sizes)
    place = np.arange(len(raw)) + np.cumsum(full) - full + 2 * line
    stops = np.cumsum(sizes) + np.add.reduceat(full, np.cumsum(sizes) - sizes).cumsum() + 2 * np.arange(1, n + 1)
    done = np.zeros(int(stops[-1]), np.uint8)
    done[place] = raw
    number = np.arange(n) % per_frame
    done[stops - 2] = 255
    done[stops - 1] = np.where(number == per_frame - 1, 0xD9, 0xD0 + number % 8)
    return done.tobytes(), stops


def chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)


def riff(frames: list[bytes], payload: int) -> bytes:
    largest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // RATE, largest * RATE, 0, 0x10, len(frames), 0, 1, largest, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIIIHHHH", b"vids", b"MJPG", 0, 0, 0, 0, 1, RATE, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", WIDTH * HEIGHT, 0, 0, 0, 0)
    hdrl = chunk(b"LIST", b"hdrl" + chunk(b"avih", avih) + chunk(b"LIST", b"strl" + chunk(b"strh", strh) + chunk(b"strf", strf)))
    info = chunk(b"LIST", b"INFO" + chunk(b"ICMT", b"payload %d\0" % payload))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        movi.append(chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(movi[-1])
    body = b"AVI " + hdrl + info + chunk(b"LIST", b"".join(movi)) + chunk(b"idx1", b"".join(index))
    return b"RIFF" + struct.pack("<I", len(body)) + body


def encode(payloads: list[bytes]) -> list[bytes]:
    """An AVI of each payload; lengths are positive multiples of WIDTH."""
    lines = [len(p) // WIDTH for p in payloads]
    frames = [-(-n // HEIGHT) for n in lines]
    filled = b"".join(p + bytes(f * HEIGHT * WIDTH - len(p)) for p, f in zip(payloads, frames, strict=True))
    data, stops = coded_lines(np.frombuffer(filled, np.uint8).reshape(-1, WIDTH))
    ends = [0, *stops[HEIGHT - 1 :: HEIGHT].tolist()]
    header, out, at = frame_header(), [], 0
    for p, n in zip(payloads, frames, strict=True):
        out.append(riff([header + data[ends[k] : ends[k + 1]] for k in range(at, at + n)], len(p)))
        at += n
    return out


def chunks(data: bytes, at: int, end: int) -> dict[bytes, tuple[int, int]]:
    """Start and size of each chunk, lists under their kind."""
    found = {}
    while at + 8 <= end:
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        if name == b"LIST":
            found[data[at + 8 : at + 12]] = at + 12, size - 4
        else:
            found[name] = at + 8, size
        at += 8 + size + size % 2
    return found


def indexed(data: bytes) -> tuple[list[bytes], int]:
    """The frames by the index, and the payload's length."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI")
    top = chunks(data, 12, 8 + int.from_bytes(data[4:8], "little"))
    at, size = top[b"idx1"]
    movi = top[b"movi"][0] - 4
    frames = []
    for name, _, offset, n in struct.iter_unpack("<4sIII", data[at : at + size]):
        start = movi + offset
        if data[start : start + 4] != name:
            raise ValueError("the index doesn't point to a chunk")
        frames.append(data[start + 8 : start + 8 + n])
    at, size = top[b"INFO"]
    at, size = chunks(data, at, at + size)[b"ICMT"]
    return frames, int(data[at : at + size].rstrip(b"\0").split()[1])


@lru_cache(64)
def parsed(header: bytes) -> tuple[int, int, bytes]:
    """Width, height and Huffman table of a frame's header."""
    at, width, height, table = 2, 0, 0, b""
    while at < len(header):
        marker, size = header[at + 1], int.from_bytes(header[at + 2 : at + 4])
        body = header[at + 4 : at + 2 + size]
        if marker == 0xC4:
            table = body[1:]
        elif marker == 0xC3:
            bits, height, width, parts = struct.unpack_from(">BHHB", body)
            if bits != 8 or parts != 1:
                raise ValueError("only grey 8-bit frames are read")
        elif marker == 0xDD and int.from_bytes(body) != width:
            raise ValueError("a restart after each line is needed")
        elif marker == 0xDA and body[3:] != b"\x01\x00\x00":
            raise ValueError("only the left neighbour predicts")
        at += 2 + size
    return width, height, table


@lru_cache(8)
def decoder(table: bytes) -> np.ndarray:
    """For the next LONGEST bits: (difference + 256) << 8 | bits used."""
    counts, categories = table[:16], table[16:]
    bits = tuple(k + 1 for k, n in enumerate(counts) for _ in range(n))
    out = np.zeros(1 << LONGEST, np.int32)
    for category, code, n in zip(categories, _codes(bits), bits, strict=True):
        for extra in range(1 << category):
            d = extra if not category or extra >> (category - 1) else extra - (1 << category) + 1
            used = n + category
            first = (code << category | extra) << (LONGEST - used)
            out[first : first + (1 << (LONGEST - used))] = (d + 256) << 8 | used
    return out


def header_end(frame: bytes) -> int:
    at = 2
    while frame[at + 1] != 0xDA:
        at += 2 + int.from_bytes(frame[at + 2 : at + 4])
    return at + 2 + int.from_bytes(frame[at + 2 : at + 4])


def decoded_lines(frames: list[bytes]) -> np.ndarray:
    """The samples of all frames, line by line; frames share width and table."""
    starts = [header_end(f) for f in frames]
    heads = {parsed(f[:s]) for f, s in zip(frames, starts, strict=True)}
    if len(heads) != 1:
        raise ValueError("frames differ in size or table")
    width, height, table = heads.pop()
    coded = np.frombuffer(b"".join(f[s:] for f, s in zip(frames, starts, strict=True)), np.uint8)
    after = np.append(coded[1:], 0)
    mark = (coded == 255) & (after != 0)
    ends = np.flatnonzero(mark)
    if len(ends) != len(frames) * height:
        raise ValueError("lines are missing")
    number = np.arange(len(ends)) % height
    if (after[ends] != np.where(number == height - 1, 0xD9, 0xD0 + number % 8)).any():
        raise ValueError("restart markers are out of order")
    drop = mark.copy()
    drop[ends + 1] = True
    stuffed = np.flatnonzero((coded == 255) & (after == 0)) + 1
    drop[stuffed] = True
    data = np.append(coded[~drop], np.zeros(3, np.uint8)).astype(np.uint32)
    windows = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    kept = np.cumsum(~drop)
    position = np.concatenate([[0], kept[ends[:-1] + 1]]).astype(np.int64) * 8
    steps = decoder(table)
    out = np.empty((len(ends), width), np.uint8)
    value = np.full(len(ends), 128, np.int32)
    for column in range(width):
        bits = ((windows[position >> 3] << (position & 7).astype(np.uint32)) & 0xFFFFFF) >> (24 - LONGEST)
        step = steps[bits]
        value += (step >> 8) - 256
        out[:, column] = value
        position += step & 255
    return out


def decode(files: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """Payload and frames (number, HEIGHT, WIDTH) of each file."""
    found = [indexed(f) for f in files]
    lines = decoded_lines([f for frames, _ in found for f in frames])
    out, at = [], 0
    for frames, payload in found:
        own = lines[at : at + len(frames) * HEIGHT]
        at += len(own)
        out.append((own.tobytes()[:payload], own.reshape(len(frames), HEIGHT, -1)))
    return out
