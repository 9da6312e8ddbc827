"""Column-name handling. Names are schema metadata, so this runs on the driver."""

from __future__ import annotations

from itertools import chain, count

_SEPARATORS = str.maketrans({" ": "_", "-": "_"})
#: Stands in for a name of which no letter, digit or underscore is left.
NAMELESS = "column"


def quote(name: str) -> str:
    """Back-tick a column name so dots and brackets are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def bracketed(name: str) -> str:
    """What stands in the first pair of brackets (``Table[Col Name]`` -> ``Col Name``), else the whole name."""
    _, opened, rest = name.partition("[")
    inner, closed, _ = rest.partition("]")
    return inner if opened and closed else name


def normalize_name(name: str, bracket: bool = False) -> str:
    """lower case, spaces and hyphens to ``_``, keep Unicode letters, digits and ``_``.

    With ``bracket=True`` the text inside the first ``[...]`` is used
    (``Table[Col Name]`` -> ``col_name``).
    """
    kept = [c for c in (bracketed(name) if bracket else name).lower().translate(_SEPARATORS) if c == "_" or c.isalnum()]
    return "".join(kept)


def normalize_names(names: list[str], bracket: bool = False) -> list[str]:
    """Normalise a list of names: the first to claim a name has it, later ones get the lowest
    free number (``id, id_1, id_2``); a name that loses all its characters becomes :data:`NAMELESS`."""
    taken: dict[str, str] = {}  # in order: given name -> nothing else has it
    for raw in names:
        wanted = normalize_name(raw, bracket) or NAMELESS
        free = next(n for n in chain([wanted], (f"{wanted}_{i}" for i in count(1))) if n not in taken)
        taken[free] = raw
    return list(taken)
