"""Op 3.  Media columns: telephony audio.

A payload of 8-bit units is stored verbatim in a WAV container as mu-law or A-law samples or as IMA ADPCM
blocks of 64 bytes; reading takes the data chunk back bit for bit.  Decoding expands mu-law and A-law through
256-entry tables, decodes ADPCM step by step with numpy across all blocks of a slice at once, and resamples the
8 kHz PCM to 16 kHz with an integer half-band filter.  The resampled PCM is stored losslessly: samples at even places as
they are, those between as residuals against the filter, which are left out if all are zero.

Null and empty texts give a payload of 64 zero bytes.  Equal texts give equal values: the codec follows from the
payload alone.  An empty table gives no rows; other columns are not read.
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

from .common import buffers, materialize, read_table, slices

UNIT = 64
RATE, OUT_RATE = 8000, 16000
#: Level of zstd under both stored columns, and bytes of a page.
LEVEL, PAGE_BYTES = 12, 8 << 20
#: WAVE format tags (fixed values of the RIFF registry).
TAGS = {"alaw": 6, "mulaw": 7, "ima": 0x11}
CODECS = ("mulaw", "alaw", "ima")


def mulaw_table() -> np.ndarray:
    """G.711 mu-law code to 14-bit linear PCM, scaled to 16 bits."""
    u = ~np.arange(256, dtype=np.int32) & 0xFF
    x = (((u & 0x0F) << 3) + 0x84) << ((u & 0x70) >> 4)
    return np.where(u & 0x80, 0x84 - x, x - 0x84).astype(np.int16)


def alaw_table() -> np.ndarray:
    """G.711 A-law code to 13-bit linear PCM, scaled to 16 bits."""
    a = np.arange(256, dtype=np.int32) ^ 0x55
    seg, base = (a & 0x70) >> 4, ((a & 0x0F) << 4) + 8
    x = np.where(seg > 0, (base + 0x100) << np.maximum(seg - 1, 0), base)
    return np.where(a & 0x80, x, -x).astype(np.int16)


def ima_steps() -> np.ndarray:
    """IMA step sizes, 7 to 32767.

    The standard's 89 sizes, fixed values in their order.
    """
    return np.array([7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int32)


MULAW, ALAW, STEPS = mulaw_table(), alaw_table(), ima_steps()
INDEX_MOVE = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)
#: Difference of nibble n at step index i.
DELTA = np.array([[(-1 if n & 8 else 1) * ((s >> 3) + (s if n & 4 else 0) + (s >> 1 if n & 2 else 0) + (s >> 2 if n & 1 else 0)) for n in range(16)] for s in STEPS.tolist()], np.int32)
NEXT_INDEX = np.clip(np.arange(89)[:, None] + INDEX_MOVE[None, :], 0, 88).astype(np.int32)


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """IMA ADPCM blocks (rows of 4 header bytes and nibbles, low first) to samples: one numpy step for all blocks at each nibble."""
    head = blocks[:, :4].astype(np.int32)
    value = (head[:, 0] | head[:, 1] << 8).astype(np.int16).astype(np.int32)
    index = np.minimum(head[:, 2], 88)
    nibbles = np.empty((blocks.shape[1] * 2 - 8, len(blocks)), np.uint8)
    body = blocks[:, 4:].T
    nibbles[0::2], nibbles[1::2] = body & 15, body >> 4
    out = np.empty((len(nibbles) + 1, len(blocks)), np.int16)
    out[0] = value
    for k, n in enumerate(nibbles):
        value = np.clip(value + DELTA[index, n], -32768, 32767)
        index = NEXT_INDEX[index, n]
        out[k + 1] = value
    return np.ascontiguousarray(out.T)


def container(codec: str, payload: bytes) -> bytes:
    """A WAV file whose data chunk is the payload."""
    ima = codec == "ima"
    per_block = (UNIT - 4) * 2 + 1
    fmt = struct.pack("<HHIIHH", TAGS[codec], 1, RATE, RATE * UNIT // per_block if ima else RATE, UNIT if ima else 1, 4 if ima else 8)
    fmt += struct.pack("<HH", 2, per_block) if ima else struct.pack("<H", 0)
    samples = len(payload) // UNIT * per_block if ima else len(payload)
    body = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(payload)) + payload
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WAVE" + body


def parse(media: bytes) -> tuple[str, memoryview]:
    """Codec and data chunk of a WAV file."""
    view, at, tag = memoryview(media), 12, None
    while at + 8 <= len(view):
        name, size = bytes(view[at : at + 4]), struct.unpack_from("<I", view, at + 4)[0]
        if name == b"fmt ":
            tag = struct.unpack_from("<H", view, at + 8)[0]
        elif name == b"data":
            return next(k for k, v in TAGS.items() if v == tag), view[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


def between(pcm: np.ndarray) -> np.ndarray:
    """The sample after each given one at twice the rate, by the taps (-1, 9, 9, -1) / 16; the ends repeat."""
    x = np.concatenate([pcm[:1], pcm, pcm[-1:], pcm[-1:]]).astype(np.int32)
    return np.clip((9 * (x[1:-2] + x[2:-1]) - x[:-3] - x[3:] + 8) >> 4, -32768, 32767).astype(np.int16)


def resample(pcm: np.ndarray) -> np.ndarray:
    """8 kHz to 16 kHz: samples are kept, new ones stand between them."""
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2], out[1::2] = pcm, between(pcm)
    return out


def pack_pcm(wide: np.ndarray) -> bytes:
    """Any 16 kHz samples (an even number of them), losslessly: a byte that tells whether residuals follow, the even samples, the residuals of the odd ones."""
    even = np.ascontiguousarray(wide[0::2])
    rest = wide[1::2] - between(even) if len(even) else even  # wraps around, as does the way back
    return bytes([int(rest.any())]) + even.astype("<i2").tobytes() + (rest.astype("<i2").tobytes() if rest.any() else b"")


def unpack_pcm(stored: bytes) -> np.ndarray:
    data = np.frombuffer(stored, "<i2", offset=1)
    even, rest = np.split(data, [len(data) // 2]) if stored[0] else (data, np.zeros(len(data), np.int16))
    out = np.empty(2 * len(even), np.int16)
    out[0::2], out[1::2] = even, (between(even) + rest if len(even) else even)
    return out


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and the stored form of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most_bytes=8_000_000):
                data, off = buffers(part.column(1))
                sizes, out = np.diff(off), []
                for a, n in zip(off.tolist(), sizes.tolist()):
                    payload = data[a : a + n].tobytes() + bytes(max(UNIT, -(-n // UNIT) * UNIT) - n)
                    out.append(container(CODECS[zlib.crc32(payload) % 3], payload))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _decode(medias: list[bytes]) -> tuple[list[str], list[memoryview], list[np.ndarray]]:
    parsed = [parse(m) for m in medias]
    codecs, payloads = [c for c, _ in parsed], [p for _, p in parsed]
    pcm: list[np.ndarray] = [np.zeros(0, np.int16)] * len(medias)
    blocked = [i for i, c in enumerate(codecs) if c == "ima"]
    if blocked:
        arrays = [np.frombuffer(payloads[i], np.uint8).reshape(-1, UNIT) for i in blocked]
        flat, at = decode_ima(np.concatenate(arrays)), 0
        for i, a in zip(blocked, arrays):
            pcm[i] = flat[at : at + len(a)].ravel()
            at += len(a)
    for i, c in enumerate(codecs):
        if c != "ima":
            pcm[i] = (MULAW if c == "mulaw" else ALAW)[np.frombuffer(payloads[i], np.uint8)]
    return codecs, payloads, pcm


def decode_media(media: DataFrame) -> DataFrame:
    """Read the stored forms back: payload digests, features of the decoded sound, and the resampled PCM as :func:`pack_pcm` has it."""
    names = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, 2):
                medias = part.column(2).to_pylist()
                codecs, payloads, pcms = _decode(medias)
                rows = []
                for m, c, p, x in zip(medias, codecs, payloads, pcms):
                    y = x.astype(np.int64)
                    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
                    feature = f"{c};samples={len(x)};peak={int(np.abs(y).max())};energy={int(np.dot(y, y)) // len(y)};crossings={crossings}"
                    rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-UNIT:]), len(m), hashlib.sha256(m).hexdigest(), feature, pack_pcm(resample(x))))
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(v, t) for v, t in zip(zip(*rows), types))], [n.split()[0] for n in names.split(", ")])

    return media.mapInArrow(run, names)


def _parts(batch: pa.RecordBatch, column: int, most_bytes: int = 4_000_000, most_rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut a batch by the sizes of a binary column; a longer single value stands alone."""
    size = np.cumsum([len(v.as_buffer()) for v in batch.column(column)])
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(size, (size[begin - 1] if begin else 0) + most_bytes, "right"))
        end = min(max(end, begin + 1), begin + most_rows, batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def read_pcm(sound: DataFrame) -> DataFrame:
    """The stored rows with pcm16k_crc32 and pcm_bytes of the 16 kHz samples that their PCM column holds, in place of it."""
    kept = [c for c in sound.columns if c != "pcm"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, batch.num_columns - 1):
                wide = [unpack_pcm(v).astype("<i2").tobytes() for v in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([zlib.crc32(w) for w in wide]), pa.array([len(w) for w in wide])], [*kept, "pcm16k_crc32", "pcm_bytes"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sound.schema.fields if f.name != "pcm")
    return sound.select(*kept, "pcm").mapInArrow(run, kinds + ", pcm16k_crc32 long, pcm_bytes long")


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(encode_media(read_table(spark, sf_dir, "documents")), "media", LEVEL, PAGE_BYTES)
    sound = materialize(decode_media(stored), "pcm", LEVEL, PAGE_BYTES)
    # what is said of the PCM is taken from what was stored
    return read_pcm(sound).withColumn("feature", F.concat("feature", F.lit(";pcm16k_crc32="), F.col("pcm16k_crc32").cast("string"))).drop("pcm16k_crc32")
