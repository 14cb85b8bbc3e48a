"""Pixel kernels in numpy: grey conversion, scaling, cropping, resizing and perceptual fingerprints.

They run inside Arrow functions, a plane or a series at a time. The resampling primitives follow the
published behaviour of common imaging libraries, but equality to the bit with them is not claimed:
fingerprints agree with each other, not with manifests other software made.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Luminosity weights, and the geometry of a fingerprint.
LUMA = (0.2989, 0.5870, 0.1140)
CROP_SHARE = 0.75
SMOOTH_SIDE, BLUR_RADIUS, GRID = 160, 3, 32
FLAT = 1e-6


def luminosity(rgb: np.ndarray) -> np.ndarray:
    """Grey plane [h, w] of a colour plane [h, w, 3]."""
    return rgb[..., 0] * LUMA[0] + rgb[..., 1] * LUMA[1] + rgb[..., 2] * LUMA[2]


def as_plane(pixels: np.ndarray, colour: bool = False) -> np.ndarray | None:
    """A grey plane, or None for ranks that are not decoded (colour only on request)."""
    if pixels.ndim == 2:
        return pixels
    if colour and pixels.ndim == 3 and pixels.shape[-1] == 3:
        return luminosity(pixels)
    return None


def three_channels(plane: np.ndarray) -> np.ndarray:
    return np.broadcast_to(plane, (3, *plane.shape))


def frames_first(array: np.ndarray, layout: str, channel: int = 0) -> np.ndarray:
    """[frames, h, w] of a stored array whose axes mean what ``layout`` says; one channel of several."""
    if layout == "single":
        return array[None]
    if layout == "channels_first":
        return array[channel][None]
    if array.ndim == 3:
        return array
    moved = array if layout == "cine0" else np.swapaxes(array, 0, 1)
    return moved[:, min(channel, moved.shape[1] - 1)]


def channels_last(array: np.ndarray) -> np.ndarray:
    """[.., h, w, channels] of [.., channels, h, w], as viewers and encoders want it."""
    return np.moveaxis(array, -3, -1)


def check_channels(shape: tuple[int, ...], channels: str) -> None:
    """grey arrays have fewer than four axes, rgb ones a channel axis of three."""
    if channels == "grey" and len(shape) >= 4:
        raise ValueError(f"not a grey series: {shape}")
    if channels == "rgb" and (len(shape) < 3 or shape[-3] != 3):
        raise ValueError(f"not an rgb series: {shape}")


def stack(planes: list[bytes], h: int, w: int, dtype: str) -> np.ndarray:
    """[frames, h, w] of ordered frame payloads of the store."""
    return np.stack([np.frombuffer(p, "<f4" if dtype == "f4" else "u1").reshape(h, w) for p in planes])


def to_u8(x: np.ndarray, low: float | None = None, high: float | None = None) -> np.ndarray:
    """Min-max scaling to 0..255, truncated; with the bounds given or the array's own."""
    low = float(x.min()) if low is None else low
    high = float(x.max()) if high is None else high
    return np.clip((x.astype(np.float64) - low) / (high - low + 1e-8) * 255, 0, 255).astype(np.uint8)


@lru_cache(maxsize=64)
def _weights(n: int, m: int) -> np.ndarray:
    """Rows of triangle-filter weights from n samples to m; the filter widens when shrinking."""
    scale = n / m
    support = max(scale, 1.0)
    centre = (np.arange(m) + 0.5) * scale
    w = np.maximum(0.0, 1 - np.abs((np.arange(n) + 0.5)[None, :] - centre[:, None]) / support)
    return w / w.sum(axis=1, keepdims=True)


def resize(plane: np.ndarray, height: int, width: int, steps: bool = False) -> np.ndarray:
    """Bilinear with antialiasing, columns then rows; with ``steps`` rounded to 8 bits after each pass."""
    settle = (lambda a: np.clip(np.floor(a + 0.5), 0, 255)) if steps else (lambda a: a)
    across = settle(plane.astype(np.float64) @ _weights(plane.shape[1], width).T)
    return settle(_weights(plane.shape[0], height) @ across)


def crop_side(frame_size: int) -> int:
    return round(CROP_SHARE * frame_size)


def centre_crop(plane: np.ndarray, side: int) -> np.ndarray:
    """The central side x side part, zero-padded where the plane is smaller."""
    h, w = plane.shape
    if h < side or w < side:
        top, left = max(0, (side - h) // 2), max(0, (side - w) // 2)
        plane = np.pad(plane, ((top, max(0, side - h - top)), (left, max(0, side - w - left))))
        h, w = plane.shape
    y, x = round((h - side) / 2), round((w - side) / 2)
    return plane[y : y + side, x : x + side]


def fit_frame(plane: np.ndarray, frame_size: int | None) -> np.ndarray:
    """Shorter side to ``frame_size`` and centre crop; None keeps the original."""
    if frame_size is None:
        return plane
    h, w = plane.shape
    s = frame_size / min(h, w)
    return centre_crop(resize(plane, max(1, int(h * s)), max(1, int(w * s))), crop_side(frame_size))


def box_blur(plane: np.ndarray, radius: int) -> np.ndarray:
    side = 2 * radius + 1
    padded = np.pad(plane.astype(np.float64), radius, mode="edge")
    sums = np.pad(padded.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return np.floor((sums[side:, side:] - sums[:-side, side:] - sums[side:, :-side] + sums[:-side, :-side]) / side**2 + 0.5)


def stretch(plane: np.ndarray) -> np.ndarray:
    low, high = plane.min(), plane.max()
    return plane if high <= low else np.clip(np.floor((plane - low) * (255.0 / (high - low))), 0, 255)


def equalize(plane: np.ndarray) -> np.ndarray:
    levels = plane.astype(np.int64)
    counts = np.bincount(levels.ravel(), minlength=256)
    used = np.flatnonzero(counts)
    step = (counts.sum() - counts[used[-1]]) // 255
    if not step:
        return plane
    below = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.minimum((step // 2 + below) // step, 255)[levels].astype(np.float64)


def median_bits(plane: np.ndarray) -> np.ndarray:
    """The values above the median of a plane, as booleans; values at the median are not."""
    return plane > np.median(plane)


def fingerprint(plane: np.ndarray) -> bytes | None:
    """128 bytes of a plane: bits above the median of a smoothed, equalised 32 x 32 thumbnail.

    None for planes without contrast. Values at the median are 0, so two-valued planes may come out
    nearly empty.
    """
    plane = plane.astype(np.float64)
    low, high = plane.min(), plane.max()
    if not np.isfinite(high - low) or high - low < FLAT:
        return None
    grey = np.floor((plane - low) / (high - low) * 255)
    thumb = equalize(stretch(box_blur(resize(grey, SMOOTH_SIDE, SMOOTH_SIDE, steps=True), BLUR_RADIUS)))
    thumb = resize(thumb, GRID, GRID, steps=True)
    return np.packbits(median_bits(thumb)).tobytes()
