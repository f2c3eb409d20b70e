from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the twelve pitch classes from 0 to 11, and of the modes 0 and 1.
PITCHES = ["C", "C♯/D♭", "D", "D♯/E♭", "E", "F", "F♯/G♭", "G", "G♯/A♭", "A", "A♯/B♭", "B"]
MODES = ["Minor", "Major"]


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding of a measure."""
    return F.round(c.try_cast("double"), digits)


def whole_seconds(ms: Column) -> Column:
    """Milliseconds to whole seconds, kept as a double."""
    return F.round(ms.try_cast("double") / 1000, 0)


def whole_seconds_int(ms: Column) -> Column:
    return whole_seconds(ms).try_cast("int")


def _named(c: Column, names: list[str]) -> Column:
    # The array lookup is by position; numbers that came as 0.0 or "0" first become whole ones.
    code = c.cast("string").try_cast("double")
    whole = F.when(code == F.floor(code), code.try_cast("int"))
    return F.get(F.array(*[F.lit(n) for n in names]), whole)


def pitch_name(c: Column) -> Column:
    """Pitch class number to its name; anything outside 0-11 gives NULL."""
    return _named(c, PITCHES)


def mode_name(c: Column) -> Column:
    """0 to Minor, 1 to Major, anything else NULL."""
    return _named(c, MODES)
