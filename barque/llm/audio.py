"""Audio features of 8-bit samples: polyphase resampling, log-mel filterbanks, hysteresis segments (operator 9)."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 576
RATE_IN, UP, DOWN = 24_000, 2, 3
RATE = RATE_IN * UP // DOWN
FRAME, HOP, FFT, MELS = 400, 160, 512, 40
PATCH = 32  # frames in one tensor
TAPS = 16  # of each phase
BLOCK = 2048  # frames worked on at once; the rest of a long recording waits as bytes
HIGH_DB, LOW_DB = 3.0, -3.0  # about the mean energy


def payload(data: bytes, unit: int = UNIT) -> bytes:
    """data and bytes 255 up to a positive multiple of `unit`."""
    return data + b"\xff" * (max(unit, -(-len(data) // unit) * unit) - len(data))


def to_wav(samples: bytes) -> bytes:
    """Lossless: one channel of unsigned 8-bit samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE_IN)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


@lru_cache
def phases() -> np.ndarray:
    """(UP, TAPS): a windowed-sinc low pass at the lower rate's limit, dealt out to the phases of the upsampled stream."""
    n = UP * TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(UP, DOWN)) * np.kaiser(n, 6.0)
    return np.stack([h[p::UP] / h[p::UP].sum() for p in range(UP)]).astype(np.float32)


def resample(x: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Outputs [first, last) of UP / DOWN of the samples; output m is phase (m * DOWN) mod UP at input (m * DOWN) div UP.
    Bytes stand for samples about 128."""
    last = len(x) * UP // DOWN if last is None else last
    out = np.empty(max(last - first, 0), np.float32)
    if not len(out):
        return out
    low, high = first * DOWN // UP - TAPS // 2, (last - 1) * DOWN // UP - TAPS // 2 + TAPS
    part, a, b = np.zeros(high - low, np.float32), max(low, 0), min(high, len(x))
    part[a - low : b - low] = (x[a:b].astype(np.float32) - 128) / 128 if x.dtype == np.uint8 else x[a:b]
    views = np.lib.stride_tricks.sliding_window_view(part, TAPS)
    for m in range(first, min(first + UP, last)):
        rows = views[m * DOWN // UP - TAPS // 2 - low :: DOWN][: len(range(m, last, UP))]
        out[m - first :: UP] = rows @ phases()[(m * DOWN) % UP][::-1]
    return out


@lru_cache
def mel_bank() -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(0), mel(RATE / 2), MELS + 2) / 2595) - 1)
    bins = np.arange(FFT // 2 + 1) * RATE / FFT
    up = (bins[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[2:] - bins[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


def log_mel(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapped frames of the resampled recording: (frames, MELS) log energies in half precision and each frame's energy
    in dB; at least two frames. Zeros fill up the last, which begins behind the first that reaches the end, so that every
    sample lies well inside a frame, where the window isn't near zero."""
    total = len(samples) * UP // DOWN
    n = -(-max(total - FRAME, 0) // HOP) + 2
    window = np.hanning(FRAME).astype(np.float32)
    mels, energy = np.empty((n, MELS), np.float16), np.empty(n, np.float32)
    for at in range(0, n, BLOCK):
        count = min(BLOCK, n - at)
        size = (count - 1) * HOP + FRAME
        x = resample(samples, at * HOP, min(total, at * HOP + size))
        x = np.concatenate((x, np.zeros(size - len(x), np.float32)))
        part = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP] * window
        spectrum = np.fft.rfft(part, FFT)
        power = spectrum.real**2 + spectrum.imag**2
        mels[at : at + count] = np.log(power.astype(np.float32) @ mel_bank() + np.float32(1e-6))
        energy[at : at + count] = 10 * np.log10((part**2).mean(axis=1) + 1e-9)
    return mels, energy


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frames [s, e): stretches over the low threshold that somewhere pass the high one."""
    mean = float(energy.mean())
    loud = np.concatenate(([0], energy > mean + LOW_DB, [0])).astype(np.int8)
    edge = np.diff(loud)
    passed = np.concatenate(([0], np.cumsum(energy > mean + HIGH_DB)))
    return [(int(s), int(e)) for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True) if passed[e] > passed[s]]


def tensors(mels: np.ndarray) -> pa.Array:
    """Patches of PATCH frames as a fixed-shape tensor array; the last is filled up with zeros."""
    n = -(-len(mels) // PATCH)
    full = np.zeros((n * PATCH, MELS), np.float16)
    full[: len(mels)] = mels
    return pa.FixedShapeTensorArray.from_numpy_ndarray(full.reshape(n, PATCH, MELS))


def ipc(array: pa.Array) -> bytes:
    batch = pa.record_batch([array], names=["log_mel"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_tensors(stored: bytes) -> np.ndarray:
    """(patches, PATCH, MELS) of what `ipc` wrote."""
    with pa.ipc.open_stream(stored) as source:
        return source.read_all().column("log_mel").combine_chunks().to_numpy_ndarray()


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames long, spans array<struct<start:double,end:double>>, feature string, media binary, log_mel binary"


def audio_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's UTF-8 bytes as an 8-bit recording, read back, with its features.

    Returns the digests of the contract, n_frames, spans (seconds of loud segments), feature (frames, segments, digest of
    the log-mel tensors at a hundredth, as read back), media (the WAV file) and log_mel (an Arrow stream of one
    fixed-shape tensor column, PATCH x MELS in half precision). Each document is worked on alone, so equal texts have equal
    values. A null or empty text is one unit of bytes 255; a null id stays null; an empty table gives no rows; other
    columns are ignored.
    """
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "n_frames": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())])), "feature": pa.string(), "media": pa.binary(), "log_mel": pa.binary()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, data in zip(batch.column("doc_id"), batch.column("data"), strict=True):
                data = data.as_py()
                media = to_wav(payload(data))
                back = from_wav(media)
                mels, energy = log_mel(np.frombuffer(back, np.uint8))
                found = segments(energy)
                patches = ipc(tensors(mels))
                digest = hashlib.sha256(np.round(read_tensors(patches).astype(np.float32) * 100).astype(np.int32).tobytes()).hexdigest()
                row = {
                    "doc_id": doc_id.as_py(), "n_bytes": len(data), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-32:]),
                    "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "n_frames": len(mels),
                    "spans": [{"start": s * HOP / RATE, "end": ((e - 1) * HOP + FRAME) / RATE} for s, e in found], "feature": f"{len(mels)}x{MELS}:{len(found)}:{digest[:32]}",
                }
                row |= {"media": media, "log_mel": patches}
                held += len(media) + len(patches)
                rows.append(row)
                if held > 16 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), data).mapInArrow(task, SCHEMA)


def op9_audio(spark, sf_dir: str) -> DataFrame:
    """With the stored recording, the tensors and their time spans beside the digests."""
    out = audio_features(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "spans", "media", "log_mel")
