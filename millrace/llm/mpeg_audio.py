"""MPEG audio columns: frame resynchronisation, tags, variable-bitrate tables, checksums, exact durations, seek offsets.

scan() reads any MPEG-1/2/2.5 stream of Layers I to III, free format too, with tags (ID3v1, ID3v2.2 to 2.4, APE) and junk
between the frames. It verifies the checksums of all layers, and takes the encoder's delay and padding, where the first
frame states them, off the duration. pack() writes bytes
losslessly as a stream of this format: an ID3v2 tag, a Xing header with frame count, byte count and seek table,
then checksummed Layer III frames of silence whose ancillary bytes carry the payload, one to four units of 192
bytes a frame as its bitrate allows (so the stream is of variable bitrate), then an ID3v1 tag.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from millrace.llm._common import map_steps

UNIT = 192
# Fixed values of the format (ISO/IEC 11172-3 and 13818-3): kbit/s by version group and layer, Hz of MPEG-1.
KBPS = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = (44100, 48000, 32000)
# Fixed values of the format: bits of Layer II's allocation, as (subbands, bits) from the lowest up.
ALLOCATIONS = {"a": ((11, 4), (12, 3), (4, 2)), "b": ((11, 4), (12, 3), (7, 2)), "c": ((2, 4), (6, 3)), "d": ((2, 4), (10, 3)), "lsf": ((4, 4), (7, 3), (19, 2))}


@dataclass(frozen=True)
class Header:
    version: float  # 1, 2 or 2.5
    layer: int
    kbps: int
    hertz: int
    channels: int
    checked: bool  # a checksum follows
    size: int
    samples: int
    side: int  # bytes of Layer III side information
    bound: int  # subbands from here on have one allocation for both channels
    pad: int


@functools.lru_cache(4096)
def header(four: bytes, free: int = 0) -> Header | None:
    """The frame header in four bytes; None if they are none. free: bytes of a frame of free format without padding; unless given, such frames are none."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    v, lay, rate, hz = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3), four[2] >> 4, four[2] >> 2 & 3
    if v == 1 or lay == 4 or rate == 15 or (rate == 0 and not free) or hz == 3 or four[3] & 3 == 2:
        return None
    version = {3: 1, 2: 2, 0: 2.5}[v]
    group = 1 if version == 1 else 2
    kbps, hertz, pad, mono = KBPS[group, lay][rate], HERTZ[hz] >> {1: 0, 2: 1, 2.5: 2}[version], four[2] >> 1 & 1, four[3] >> 6 == 3
    samples = 384 if lay == 1 else 576 if lay == 3 and group == 2 else 1152
    size = (12000 * kbps // hertz + pad) * 4 if lay == 1 else samples // 8 * 1000 * kbps // hertz + pad
    if rate == 0:
        size = free + pad * (4 if lay == 1 else 1)
        kbps = 8 * free * hertz // samples // 1000
    side = 0 if lay < 3 else (17 if mono else 32) if group == 1 else (9 if mono else 17)
    bound = 4 * ((four[3] >> 4 & 3) + 1) if four[3] >> 6 == 1 else 32
    return Header(version, lay, kbps, hertz, 1 if mono else 2, not four[1] & 1, size, samples, side, bound, pad)


def free_size(data: bytes, at: int, end: int) -> int:
    """Bytes of the frame of free format that may begin here, without padding: as far as to the next header that agrees with it, if the one after stands as far again; else 0."""
    four = data[at : at + 4]
    one = header(four, 1)
    if one is None or four[2] >> 4:
        return 0
    slot, go = 4 if one.layer == 1 else 1, at + 32
    while 0 <= (go := data.find(four[:2], go, min(end, at + 8192))):
        n = go - at - one.pad * slot
        next_ = header(data[go : go + 4], n)
        if next_ and not data[go + 2] >> 4 and agree(one, next_) and (go + next_.size >= end or data[go + next_.size : go + next_.size + 2] == four[:2]):
            return n
        go += 1
    return 0


@functools.lru_cache(4096)
def crc16(data: bytes) -> int:
    """The format's checksum: polynomial 0x8005, from 0xFFFF, high bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ (0x8005 if crc & 0x8000 else 0)) & 0xFFFF
    return crc


def crc16_bits(data: bytes, bits: int) -> int:
    """The same over so many bits."""
    crc = crc16(data[: bits // 8])
    for k in range(bits % 8):
        bit = data[bits // 8] >> 7 - k & 1
        crc = (crc << 1 ^ (0x8005 if (crc >> 15) ^ bit else 0)) & 0xFFFF
    return crc


def allocation(h: Header) -> list[int]:
    """Bits of the allocation of each subband of Layer II."""
    each = h.kbps // h.channels
    if h.version != 1:
        name = "lsf"
    elif each >= 56:
        name = "a" if h.hertz == 48000 or each <= 80 else "b"
    else:
        name = "d" if h.hertz == 32000 else "c"
    return [bits for n, bits in ALLOCATIONS[name] for _ in range(n)]


def checked_bits(data: bytes, at: int, h: Header) -> int:
    """How many bits behind header and checksum the checksum covers: side information in Layer III, allocation in Layer I, allocation and scale factor selection in Layer II."""
    if h.layer == 3:
        return 8 * h.side
    if h.layer == 1:
        return 4 * (h.channels * min(h.bound, 32) + 32 - min(h.bound, 32))
    value, place, chosen = int.from_bytes(data[at + 6 : at + 6 + 64].ljust(64, b"\0"), "big"), 512, 0
    for band, bits in enumerate(allocation(h)):
        own = h.channels if band < h.bound else 1
        for _ in range(own):
            place -= bits
            chosen += (value >> place & (1 << bits) - 1 != 0) * (h.channels // own)
    return 512 - place + 2 * chosen


def checksum_holds(data: bytes, at: int, h: Header) -> bool:
    bits = checked_bits(data, at, h)
    return crc16_bits(data[at + 2 : at + 4] + data[at + 6 : at + 6 + (bits + 7) // 8], 16 + bits) == int.from_bytes(data[at + 4 : at + 6], "big")


def syncsafe(n: int) -> bytes:
    return bytes(n >> s & 127 for s in (21, 14, 7, 0))


def unsafe(four: bytes) -> int:
    return sum((b & 127) << s for b, s in zip(four, (21, 14, 7, 0)))


@dataclass
class Scan:
    """What a stream holds. offsets: where each audio frame begins; a frame's time is its number times samples / hertz."""

    first: Header | None = None
    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    samples: int = 0
    skipped: int = 0  # bytes that belong to no tag and no frame
    resyncs: int = 0
    crc_good: int = 0
    crc_bad: int = 0
    kbps: set[int] = field(default_factory=set)
    tags: dict[str, str] = field(default_factory=dict)
    vbr: str | None = None
    vbr_frames: int | None = None
    vbr_bytes: int | None = None
    toc: bytes | None = None
    delay: int = 0  # samples that the encoder has put before and behind the sound
    padding: int = 0

    @property
    def duration(self) -> int:
        """Samples of sound."""
        return max(0, self.samples - self.delay - self.padding)

    def feature(self) -> str:
        h = self.first
        if h is None:
            return f"no frames;skipped={self.skipped}"
        seek = zlib.crc32(b"".join(x.to_bytes(8, "little") for x in self.offsets))
        return f"mpeg{h.version:g} layer{h.layer} {h.hertz}Hz {h.channels}ch;frames={len(self.offsets)};duration={self.duration}/{h.hertz}s;kbps={min(self.kbps)}-{max(self.kbps)};vbr={self.vbr};vbr_frames={self.vbr_frames};vbr_bytes={self.vbr_bytes};crc={self.crc_good}+{self.crc_bad};tags={','.join(sorted(self.tags))};skipped={self.skipped};resyncs={self.resyncs};seek_crc32={seek:08x}"


def id3v2(data: bytes, at: int) -> tuple[int, dict[str, str]]:
    """Length of the ID3v2 tag at this place, with its text frames: versions 2.2, 2.3 and 2.4, extended headers, unsynchronised bytes and footers."""
    version, flags, size = data[at + 3], data[at + 5], unsafe(data[at + 6 : at + 10])
    body, found, p = data[at + 10 : at + 10 + size], {}, 0
    length = min(len(data) - at, 10 + size + (10 if version >= 4 and flags & 0x10 else 0))
    joined = lambda b: b.replace(b"\xff\0", b"\xff")
    if flags & 0x80 and version < 4:
        body = joined(body)
    if flags & 0x40 and version >= 3:
        p = unsafe(body[:4]) if version >= 4 else 4 + int.from_bytes(body[:4], "big")
    name_size, head = (3, 6) if version < 3 else (4, 10)
    while p + head <= len(body) and body[p : p + name_size].strip(b"\0"):
        name = body[p : p + name_size].decode("latin-1")
        n = int.from_bytes(body[p + 3 : p + 6], "big") if version < 3 else unsafe(body[p + 4 : p + 8]) if version >= 4 else int.from_bytes(body[p + 4 : p + 8], "big")
        text = body[p + head : p + head + n]
        if version >= 4:
            text = joined(text) if body[p + 9] & 2 or flags & 0x80 else text
            text = text[4:] if body[p + 9] & 1 else text  # a data length stands in front
        if name[:1] == "T" and text:
            found[name] = text[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be"}.get(text[0], "utf-8"), "replace").strip("\0")
        p += head + n
    return length, found


def ape_items(body: bytes) -> dict[str, str]:
    found, p = {}, 0
    while p + 9 <= len(body):
        n, flags, end = int.from_bytes(body[p : p + 4], "little"), body[p + 4], body.find(b"\0", p + 8)
        if end < 0:
            break
        if not flags & 6:  # text
            found["ape." + body[p + 8 : end].decode("latin-1").lower()] = body[end + 1 : end + 1 + n].decode("utf-8", "replace")
        p = end + 1 + n
    return found


def ape(data: bytes, at: int, end: int) -> tuple[int, dict[str, str]]:
    """Length and text items of an APE tag whose header stands here."""
    size = int.from_bytes(data[at + 12 : at + 16], "little")
    return min(end - at, 32 + size), ape_items(data[at + 32 : at + max(32, size)])


def ape_before(data: bytes, end: int) -> tuple[int, dict[str, str]]:
    """Length and text items of an APE tag whose footer ends here."""
    if end < 32 or data[end - 32 : end - 24] != b"APETAGEX" or data[end - 9] & 0x20:
        return 0, {}
    size = int.from_bytes(data[end - 20 : end - 16], "little")
    if not 32 <= size <= end:
        return 0, {}
    return min(end, size + (32 if data[end - 9] & 0x80 else 0)), ape_items(data[end - size : end - 32])


def vbr_table(data: bytes, at: int, h: Header, out: Scan) -> bool:
    """Reads a Xing, Info or VBRI table in the frame at this place."""
    p = at + 4 + 2 * h.checked + h.side
    if data[p : p + 4] in (b"Xing", b"Info"):
        out.vbr, flags, p = data[p : p + 4].decode(), int.from_bytes(data[p + 4 : p + 8], "big"), p + 8
        if flags & 1:
            out.vbr_frames, p = int.from_bytes(data[p : p + 4], "big"), p + 4
        if flags & 2:
            out.vbr_bytes, p = int.from_bytes(data[p : p + 4], "big"), p + 4
        if flags & 4:
            out.toc, p = data[p : p + 100], p + 100
        p += 4 * bool(flags & 8)
        if data[p : p + 4] in (b"LAME", b"Lavf", b"Lavc", b"GOGO"):
            both = int.from_bytes(data[p + 21 : p + 24], "big")
            out.delay, out.padding = both >> 12, both & 0xFFF
        return True
    if data[at + 36 : at + 40] == b"VBRI":
        out.vbr, out.vbr_bytes, out.vbr_frames = "VBRI", int.from_bytes(data[at + 46 : at + 50], "big"), int.from_bytes(data[at + 50 : at + 54], "big")
        return True
    return False


def agree(a: Header, b: Header) -> bool:
    return (a.version, a.layer, a.hertz) == (b.version, b.layer, b.hertz)


def scan(data: bytes) -> Scan:
    """All frames of the stream. Between frames it looks for the next sync whose following frame agrees, or which ends the stream."""
    out, at, synced, n, free = Scan(), 0, True, len(data), 0
    audio_end = n - 128 if n >= 128 and data[-128:-125] == b"TAG" else n
    if audio_end < n:
        named = {"v1.title": data[-125:-95], "v1.artist": data[-95:-65]}
        out.tags |= {k: v.rstrip(b"\0 ").decode("latin-1") for k, v in named.items() if v.strip(b"\0 ")}
    length, found = ape_before(data, audio_end)
    audio_end -= length
    out.tags |= found
    while at < audio_end:
        start = data[at : at + 3]
        if start == b"ID3" and at + 10 <= audio_end and data[at + 3] < 255:
            length, found = id3v2(data, at)
            out.tags |= found
            at += length
            continue
        if start == b"APE" and data[at : at + 8] == b"APETAGEX" and at + 32 <= audio_end:
            length, found = ape(data, at, audio_end)
            out.tags |= found
            at += length
            continue
        four = data[at : at + 4]
        if not free and out.first is None and len(four) == 4 and four[0] == 0xFF and not four[2] >> 4:
            free = free_size(data, at, audio_end)
        h = header(four, free)
        good = h is not None and at + h.size <= audio_end and (out.first is None or agree(h, out.first))
        if good and not synced:
            follows = header(data[at + h.size : at + h.size + 4], free)
            good = at + h.size == audio_end or follows is not None and agree(h, follows)
        if not good:
            if synced:
                out.resyncs += 1
            synced = False
            if out.first is None:
                free = 0
            go = data.find(b"\xff", at + 1, audio_end)
            go = go if go >= 0 else audio_end
            out.skipped += go - at
            at = go
            continue
        synced = True
        if h.checked:
            ok = checksum_holds(data, at, h)
            out.crc_good, out.crc_bad = out.crc_good + ok, out.crc_bad + (not ok)
        if out.first is None:
            out.first = h
            if h.layer == 3 and vbr_table(data, at, h, out):
                at += h.size
                continue
        out.offsets.append(at)
        out.sizes.append(h.size)
        out.samples += h.samples
        out.kbps.add(h.kbps)
        at += h.size
    return out


def seek(found: Scan, sample: int) -> int | None:
    """The offset of the frame that holds a sample of the stream."""
    return None if found.first is None or not 0 <= sample < found.samples else found.offsets[sample // found.first.samples]


# 48 kHz mono Layer III of MPEG-1: a frame of k kbit/s has 3 k bytes; head, checksum and side information take 23.
FRAMES = {1: 80, 2: 160, 3: 224, 4: 320}


@functools.lru_cache(8)
def frame_head(units: int) -> bytes:
    """Header, checksum and side information (no main data: silence) of a frame that carries so many units."""
    head = bytes((0xFF, 0xFA, KBPS[1, 3].index(FRAMES[units]) << 4 | 1 << 2, 0xC0))
    side = bytes(17)
    return head + crc16(head[2:] + side).to_bytes(2, "big") + side


def pack(payload: bytes) -> bytes:
    """The payload, a multiple of 192 bytes long, as an MPEG stream; equal payloads give equal streams."""
    if len(payload) % UNIT:
        raise ValueError("the payload is no multiple of 192 bytes")
    frames = []
    for at in range(0, len(payload), 4 * UNIT):
        piece = payload[at : at + 4 * UNIT]
        head = frame_head(len(piece) // UNIT)
        frames.append(head + piece + bytes(3 * FRAMES[len(piece) // UNIT] - len(head) - len(piece)))
    offsets, total = [], 960
    for f in frames:
        offsets.append(total)
        total += len(f)
    toc = bytes(min(255, 256 * offsets[i * len(frames) // 100] // total) if frames else 0 for i in range(100))
    xing = b"Xing" + (7).to_bytes(4, "big") + len(frames).to_bytes(4, "big") + total.to_bytes(4, "big") + toc
    first = frame_head(4) + xing
    text = b"\x03" + str(len(payload)).encode()
    tag = b"TSIZ" + syncsafe(len(text)) + bytes(2) + text
    return b"".join([b"ID3\x04\x00\x00", syncsafe(len(tag)), tag, first, bytes(960 - len(first)), *frames, b"TAG", b"payload".ljust(124, b"\0"), b"\xff"])


def unpack(data: bytes, found: Scan | None = None) -> bytes:
    """The payload of a stream that pack() wrote, by its frames' offsets."""
    found = found or scan(data)
    units = {3 * k: n for n, k in FRAMES.items()}
    return b"".join(data[at + 23 : at + 23 + UNIT * units[size]] for at, size in zip(found.offsets, found.sizes))


def padded(text: str) -> bytes:
    raw = text.encode()
    return raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b" ")


def store_media(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, media (binary): each text as a stream of MPEG audio. A null text is an empty one; ids may be null or repeat; other columns are not read; an empty table gives an empty result."""
    from millrace.llm._common import text_of

    def make(part):
        texts = part.column(text_col).to_pylist()
        return part.column(id_col), [len(t.encode()) for t in texts], [pack(padded(t)) for t in texts]

    return map_steps(text_of(rows, id_col, text_col), text_col, make, f"`{id_col}` long, n_bytes long, media binary")


MEDIA = "payload binary, duration_samples long, sample_rate int, frames long, seek_offsets array<long>, crc_good long, crc_bad long, vbr string, tags map<string,string>, skipped long, resyncs long, feature string"


def read_media(media: DataFrame, keep: tuple[str, ...] = ("doc_id", "n_bytes"), columns: str = MEDIA) -> DataFrame:
    """The columns keep, media, and what scan() finds in media (columns: which of MEDIA). A null stream, or bytes without any frame, give zeros, nulls and an empty payload; an empty table gives an empty result."""
    wanted = [c.split()[0] for c in columns.split(", ")]

    def make(part):
        rows = [m or b"" for m in part.column("media").to_pylist()]
        found = [scan(m) for m in rows]
        get = {
            "payload": lambda m, s: unpack(m, s) if s.first and (s.first.layer, s.first.hertz) == (3, 48000) and all(x // 3 in FRAMES.values() for x in s.sizes) else b"",
            "duration_samples": lambda m, s: s.duration, "sample_rate": lambda m, s: s.first.hertz if s.first else None, "frames": lambda m, s: len(s.offsets), "seek_offsets": lambda m, s: s.offsets,
            "crc_good": lambda m, s: s.crc_good, "crc_bad": lambda m, s: s.crc_bad, "vbr": lambda m, s: s.vbr, "tags": lambda m, s: list(s.tags.items()), "skipped": lambda m, s: s.skipped, "resyncs": lambda m, s: s.resyncs, "feature": lambda m, s: s.feature(),
        }
        return [*(part.column(c) for c in keep), rows, *([get[c](m, s) for m, s in zip(rows, found)] for c in wanted)]

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.select(*keep).schema)
    return map_steps(media.select(*keep, "media"), "media", make, f"{kept}, media binary, {columns}")
