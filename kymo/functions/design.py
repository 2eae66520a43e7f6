"""Filter design: windowed-sinc taps from transition widths, recursive sections from poles."""

from __future__ import annotations

import math

import numpy as np


def sinc_low_pass(cut: float, rate: float, half: int) -> np.ndarray:
    """Hamming-windowed sinc with ``2 * half + 1`` taps, unit gain at zero."""
    k = np.arange(-half, half + 1)
    taps = np.sinc(2.0 * cut / rate * k) * (0.54 + 0.46 * np.cos(math.pi * k / (half or 1)))
    return taps / taps.sum()


def half_length(transition: float, rate: float) -> int:
    """Half the taps of a Hamming-windowed filter with that transition width in Hz."""
    return math.ceil(3.3 / transition * rate / 2.0)


def designed(low: float | None, high: float | None, rate: float) -> np.ndarray:
    """Taps that pass ``low`` to ``high`` Hz; None, or a limit at half the rate, is open.

    Transitions are a quarter of the limit wide, 2 Hz at least, but reach neither below zero
    nor beyond half the rate; the narrower one decides the length.
    """
    top = rate / 2.0
    high = None if high is not None and high >= top else high
    widths = []
    if low is not None:
        widths.append(min(max(0.25 * low, 2.0), low))
    if high is not None:
        widths.append(min(max(0.25 * high, 2.0), top - high))
    half = half_length(min(widths), rate) if widths else 0
    taps = np.zeros(2 * half + 1)
    taps[half] = 1.0
    if high is not None:
        taps = sinc_low_pass(high + widths[-1] / 2.0, rate, half)
    if low is not None:
        taps = taps - sinc_low_pass(low - widths[0] / 2.0, rate, half)
    return taps


def notch(line: float, rate: float, harmonics: int = 5) -> np.ndarray:
    """Taps that stop the line frequency and its harmonics below half the rate, each a
    two-hundredth of itself wide with transitions of 1 Hz."""
    half = half_length(1.0, rate)
    taps = np.zeros(2 * half + 1)
    taps[half] = 1.0
    for i in range(1, harmonics + 1):
        at = line * i
        side = at / 400.0 + 0.5
        if at + side >= rate / 2.0:
            break
        taps = taps - (sinc_low_pass(at + side, rate, half) - sinc_low_pass(at - side, rate, half))
    return taps


def butterworth(cut: float, rate: float) -> list[tuple[float, float, float, float, float]]:
    """Fourth-order low-pass as two sections ``(b0, b1, b2, a1, a2)``."""
    if not 0 < cut < rate / 2.0:
        raise ValueError(f"the cut-off must lie between 0 and half the rate, got {cut} of {rate}")
    w = math.tan(math.pi * cut / rate)
    sections = []
    for k in (0, 1):
        damping = 2.0 * math.cos(math.pi * (2 * k + 1) / 8.0)
        norm = 1.0 + damping * w + w * w
        b0 = w * w / norm
        sections.append((b0, 2.0 * b0, b0, 2.0 * (w * w - 1.0) / norm, (1.0 - damping * w + w * w) / norm))
    return sections


def state_space(sections: list[tuple[float, float, float, float, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """``s' = A s + B x``, ``y = C s + D x`` of the sections one after another."""
    a, b, c, d = np.zeros((0, 0)), np.zeros(0), np.zeros(0), 1.0
    for b0, b1, b2, a1, a2 in sections:
        own = np.array([[-a1, 1.0], [-a2, 0.0]])
        feed = np.array([b1 - a1 * b0, b2 - a2 * b0])
        n = len(b)
        grown = np.zeros((n + 2, n + 2))
        grown[:n, :n] = a
        grown[n:, :n] = np.outer(feed, c)
        grown[n:, n:] = own
        a, b = grown, np.concatenate([b, feed * d])
        c, d = np.concatenate([b0 * c, [1.0, 0.0]]), b0 * d
    return a, b, c, d
