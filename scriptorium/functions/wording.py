"""Words for counts, losses and times, and text cut to columns of a terminal; driver side."""

from __future__ import annotations

import unicodedata

THIN = " "
CUT = "…"


def grouped(number: int) -> str:
    return f"{number:,}".replace(",", THIN)


def one_of(unit: str) -> str:
    return f"{unit[:-3]}y" if unit.endswith("ies") else unit.removesuffix("s")


def plural(count: int, noun: str) -> str:
    return f"{count} {noun}{'' if count == 1 else 's'}"


def counted(count: int, total: int | None, unit: str) -> str:
    """'2 of 3 lines'; a count without a sound total is an error."""
    if total is None or not 0 <= count <= total:
        raise ValueError(f"{count} of {total} {unit} is no count")
    return f"{grouped(count)} of {grouped(total)} {unit}"


def phase(state: str, count: int = 0, total: int | None = None, unit: str = "lines", reason: str | None = None, verb: str = "enrich") -> str:
    """What is said of a phase, by its state first and only then by its numbers."""
    match state:
        case "pending":
            return "pending"
        case "off":
            return f"off ({reason})" if reason else "off"
        case "unavailable":
            return f"off · {reason or 'unavailable'}"
        case "lost" if not reason:
            raise ValueError("a phase is lost for a reason")
        case "lost":
            return f"LOST · {counted(count, total, unit)} — {reason}"
    said = counted(count, total, unit)
    if total == 0:
        return f"no {one_of(unit)} to {verb} (0 found)"
    return said if count else f"nothing lost (0 of {grouped(total or 0)})"


def duration(seconds: float) -> str:
    """As 4h 51m 31s."""
    minutes, s = divmod(int(seconds), 60)
    hours, m = divmod(minutes, 60)
    return f"{hours}h {m:02d}m {s:02d}s" if hours else f"{m}m {s:02d}s" if m else f"{s}s"


def columns(text: str) -> int:
    """How many columns a terminal needs, two for wide letters."""
    return sum(1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


def _tidy(text: str) -> str:
    return "".join(" " if unicodedata.category(c) == "Cc" else c for c in text)


def clip(text: str, room: int, left: bool = False) -> str:
    """text in so many columns, cut at the end, or at the start where the end tells more."""
    text = _tidy(text)
    if room <= 0 or columns(text) <= room:
        return text if room > 0 else ""
    kept = text[::-1] if left else text
    while columns(kept) > room - 1:
        kept = kept[:-1]
    return CUT + kept[::-1] if left else kept + CUT


def short_path(path: str, room: int) -> str:
    """A path whose last part stays whole if it fits at all."""
    head, slash, leaf = path.rpartition("/")
    if columns(_tidy(path)) <= room or not slash or columns(leaf) + 2 >= room:
        return clip(path, room, left=True)
    return f"{clip(head, room - columns(leaf) - 1)}/{leaf}"


def pad(left: str, right: str, room: int) -> str:
    """Two texts at the ends of a line; the left one gives way."""
    right = clip(right, room)
    left = clip(left, max(0, room - columns(right) - 1))
    return left + " " * max(0, room - columns(left) - columns(right)) + right
