"""Myers' bit-parallel approximate matching of one pattern in a text."""

from __future__ import annotations


def masks(pattern: str) -> dict[str, int]:
    """For each character the positions of the pattern that hold it."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_end(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern of length m to a substring of text, where the first such substring ends).

    Two integers hold the column of the distance matrix as vertical steps of +1 and -1.
    """
    if not m:
        return 0, 0
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        down = eq | minus
        same = (((eq & plus) + plus) ^ plus) | eq
        right_plus = minus | (full & ~(same | plus))
        right_minus = plus & same & full
        if right_plus & top:
            score += 1
        elif right_minus & top:
            score -= 1
        right_plus = (right_plus << 1) & full  # no cost enters from above: a match may begin anywhere
        right_minus = (right_minus << 1) & full
        plus = right_minus | (full & ~(down | right_plus))
        minus = right_plus & down
        if score < best:
            best, at = score, j
    return best, at
