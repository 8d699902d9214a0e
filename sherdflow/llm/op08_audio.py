"""Media columns: audio features of 8-bit mono sound.

Each row's bytes become a WAV file (unsigned 8-bit PCM, lossless); the stored samples are read back, resampled by a
polyphase filter, cut into overlapped frames, turned into log-mel filterbanks, and segmented by energy with
hysteresis. The frames are stored as an Arrow stream of fixed-shape tensors (fixed_shape_tensor of TENSOR_FRAMES x
n_mels float32; a row's columns: its time span, its frames, how many of them lie in segments, the tensor), which
`tensors_of` reads back. Values are computed in double precision and kept to thousandths.

Cases: null or empty payload: one block of 64 zero bytes; text as long as may be is one clip, never cut; ties and
repeated rows: every row is treated alone, equal payloads give equal features; empty table: empty result; extra
columns: only the two named ones are read, under names given to the operator.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._io import table
from ._text import batches, give_back

BLOCK = 64
TENSOR_FRAMES = 32
_RIFF = struct.Struct("<4sI4s4sIHHIIHH4sI")


def wav_of(samples: bytes, rate: int) -> bytes:
    """A WAV file of unsigned 8-bit mono samples."""
    odd = len(samples) & 1
    return _RIFF.pack(b"RIFF", 36 + len(samples) + odd, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples)) + samples + b"\0" * odd


def samples_of(wav: bytes) -> bytes:
    """The samples of a WAV file, found by walking its chunks."""
    if wav[:4] != b"RIFF" or wav[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while at + 8 <= len(wav):
        kind, n = wav[at : at + 4], int.from_bytes(wav[at + 4 : at + 8], "little")
        if kind == b"data":
            return wav[at + 8 : at + 8 + n]
        at += 8 + n + (n & 1)
    raise ValueError("no data chunk")


def pad(payload: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of BLOCK."""
    return payload + b"\0" * (max(BLOCK, -(-len(payload) // BLOCK) * BLOCK) - len(payload))


@dataclass
class AudioFeatures:
    rate: int = 16_000
    up: int = 5
    down: int = 8
    taps: int = 24
    frame: int = 256
    hop: int = 128
    n_mels: int = 32
    #: dB over the clip's own floor at which a segment begins, and below which it ends
    high_db: float = 6.0
    low_db: float = 3.0

    @property
    def out_rate(self) -> float:
        return self.rate * self.up / self.down

    @cached_property
    def kernel(self) -> np.ndarray:
        """Windowed sinc low-pass of taps * up coefficients, split by phase: (up, taps)."""
        n = self.taps * self.up
        t = np.arange(n) - (n - 1) / 2
        cut = min(1.0, self.up / self.down) / self.up
        h = np.sinc(t * cut) * np.hanning(n + 2)[1:-1]
        h *= self.up / h.sum()
        return np.stack([h[p :: self.up] for p in range(self.up)])

    def resample(self, x: np.ndarray) -> np.ndarray:
        """Polyphase resampling by up/down: each output takes only the taps of its own phase."""
        n_out = -(-len(x) * self.up // self.down)
        wide = np.zeros(len(x) + 2 * self.taps + self.down)
        wide[self.taps // 2 - 1 :][: len(x)] = x
        windows = np.lib.stride_tricks.sliding_window_view(wide, self.taps)
        out = np.empty(n_out)
        for k in range(min(self.up, n_out)):
            first, phase = divmod(k * self.down, self.up)
            n = len(out[k :: self.up])
            out[k :: self.up] = windows[first :: self.down][:n] @ self.kernel[phase][::-1]
        return out

    @cached_property
    def mel(self) -> np.ndarray:
        """Triangular mel filters, (frame // 2 + 1, n_mels)."""
        top = 2595 * np.log10(1 + self.out_rate / 2 / 700)
        edges = 700 * (10 ** (np.linspace(0, top, self.n_mels + 2) / 2595) - 1)
        bins = np.arange(self.frame // 2 + 1) * self.out_rate / self.frame
        left, mid, right = edges[:-2], edges[1:-1], edges[2:]
        up = (bins[:, None] - left) / (mid - left)
        down = (right - bins[:, None]) / (right - mid)
        return np.maximum(0, np.minimum(up, down))

    @cached_property
    def window(self) -> np.ndarray:
        return np.hanning(self.frame)

    def log_mel(self, y: np.ndarray) -> np.ndarray:
        n = max(1, -(-max(0, len(y) - self.frame) // self.hop) + 1)
        wide = np.zeros((n - 1) * self.hop + self.frame)
        wide[: len(y)] = y
        frames = np.lib.stride_tricks.sliding_window_view(wide, self.frame)[:: self.hop]
        out = np.empty((n, self.n_mels), np.float32)
        for i in range(0, n, 2048):
            spec = np.fft.rfft(frames[i : i + 2048] * self.window)
            out[i : i + 2048] = np.round(np.log((spec.real**2 + spec.imag**2) @ self.mel + 1e-6), 3)
        return out

    def segments(self, mel: np.ndarray) -> np.ndarray:
        """Runs of frames over the low threshold that reach the high one: (k, 2) frame numbers, end exclusive."""
        db = 10 / np.log(10) * np.log(np.exp(mel.astype(np.float64)).sum(1) + 1e-9)
        floor = np.percentile(db, 10)
        low, high = db > floor + self.low_db, db > floor + self.high_db
        edge = np.flatnonzero(np.diff(np.concatenate([[False], low, [False]]).astype(np.int8)))
        runs = edge.reshape(-1, 2)
        reached = np.concatenate([[0], np.cumsum(high)])
        return runs[reached[runs[:, 1]] > reached[runs[:, 0]]]

    def clip(self, wav: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Log-mel frames and segments of one stored clip."""
        x = np.frombuffer(samples_of(wav), np.uint8).astype(float)
        mel = self.log_mel(self.resample((x - 128) / 128))
        return mel, self.segments(mel)

    def span_ms(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scale = 1000 / self.out_rate
        return np.round(first * self.hop * scale).astype(int), np.round(((last - 1) * self.hop + self.frame) * scale).astype(int)

    def stored(self, mel: np.ndarray, segs: np.ndarray) -> bytes:
        """The frames as an Arrow stream of fixed-shape tensors with their time spans."""
        n = -(-len(mel) // TENSOR_FRAMES)
        full = np.zeros((n * TENSOR_FRAMES, self.n_mels), np.float32)
        full[: len(mel)] = mel
        first = np.arange(n) * TENSOR_FRAMES
        last = np.minimum(first + TENSOR_FRAMES, len(mel))
        voiced = np.zeros(len(mel) + 1, np.int64)
        voiced[segs[:, 0]] += 1
        voiced[segs[:, 1]] -= 1
        voiced = np.concatenate([[0], np.cumsum(np.cumsum(voiced)[:-1])])
        a, e = self.span_ms(first, last)
        values = pa.FixedShapeTensorArray.from_numpy_ndarray(full.reshape(n, TENSOR_FRAMES, self.n_mels))
        batch = pa.record_batch([pa.array(a), pa.array(e), pa.array(last - first), pa.array(voiced[last] - voiced[first]), values], ["start_ms", "end_ms", "frames", "voiced", "values"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def summary(self, mel: np.ndarray, segs: np.ndarray) -> str:
        means = ",".join(f"{v:.1f}" for v in mel.astype(np.float64).mean(0)[:: max(1, self.n_mels // 8)] + 0.0)
        return f"frames={len(mel)};segments={len(segs)};voiced={int((segs[:, 1] - segs[:, 0]).sum())};mel={means}"

    SCHEMA = "key long, n_bytes long, media binary, segments array<struct<start_ms: long, end_ms: long>>, summary string, tensors binary"

    def rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start_ms", pa.int64()), ("end_ms", pa.int64())])
        for b in batches(it, 500):
            payloads, wavs, spans, sums, kept = b.column(1).to_pylist(), [], [], [], []
            for p in payloads:
                wavs.append(wav_of(pad(p or b""), self.rate))
                mel, segs = self.clip(wavs[-1])
                a, e = self.span_ms(segs[:, 0], segs[:, 1])
                spans.append([{"start_ms": int(x), "end_ms": int(y)} for x, y in zip(a, e)])
                sums.append(self.summary(mel, segs))
                kept.append(self.stored(mel, segs))
            cols = {"key": b.column(0), "n_bytes": pa.array([len(p or b"") for p in payloads], pa.int64()), "media": pa.array(wavs, pa.binary()), "segments": pa.array(spans, pa.list_(span)), "summary": pa.array(sums, pa.string()), "tensors": pa.array(kept, pa.binary())}
            yield pa.RecordBatch.from_pydict(cols)
        give_back()

    def __call__(self, df: DataFrame, key: str, payload: str) -> DataFrame:
        """key, n_bytes, media (WAV), segments, summary and tensors (an Arrow stream) of each row of df."""
        two = df.select(df[key].cast("long").alias("key"), df[payload].cast("binary").alias("payload"))
        return two.mapInArrow(self.rows, self.SCHEMA)


def tensors_of(stored: bytes) -> pa.Table:
    """start_ms, end_ms, frames, voiced and values (fixed-shape tensors) of one clip."""
    with pa.ipc.open_stream(stored) as back:
        return back.read_all()


def op8_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what the operator stores for every document; the payload's digests come from the stored media."""
    out = AudioFeatures()(table(spark, sf_dir, "documents"), "doc_id", "text")
    data = F.expr("substring(media, 45, length(media))")  # what follows the header; its length is even
    return out.select(
        F.col("key").alias("doc_id"),
        "n_bytes",
        F.length(data).cast("long").alias("payload_bytes"),
        F.sha2(data, 256).alias("payload_sha256"),
        F.crc32(F.expr(f"substring(media, length(media) - {BLOCK - 1}, {BLOCK})")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.col("summary").alias("feature"),
        F.length("tensors").cast("long").alias("tensor_bytes"),
        F.sha2("tensors", 256).alias("tensor_sha256"),
    )
