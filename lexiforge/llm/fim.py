"""Fill-in-middle transformation by an Aho-Corasick event scan.

A text is a row of runs of two classes: separators (a few ASCII characters) and everything else. Each class says how many
code points of a run are one unit. One automaton holds the separators and the sentinels; its matches are all that is
looked at. Between two of them the class does not change, so a gap's units are its length divided by the class's width.
Only the places where the class changes are kept, with the units up to each of them; the place of the r-th unit is found
by a binary search among them and a multiplication inside the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, col, release, slices
from .tokens import strings

#: Marks of the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Rows of one step of a task.
ROWS = 512


@dataclass(frozen=True)
class Units:
    """Code points of a unit inside runs of separators (between) and of all other characters (inside); 0: a run is one unit."""

    separators: str = SPACES
    between: int = 1
    inside: int = 1

    def __post_init__(self):
        if not self.separators.isascii() or min(self.between, self.inside) < 0:
            raise ValueError("separators must be ASCII and widths not negative")


CODE_POINTS = Units()
#: Runs of white space, and of everything else.
RUNS = Units(between=0, inside=0)
#: Lines: the text between line feeds, and each line feed.
LINES = Units(separators="\n", between=1, inside=0)


def check_sentinels(sentinels: tuple[str, ...]) -> None:
    """Raises unless marks can always be told apart: none is empty, inside another, or begins with the end of one."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"sentinels {a!r} and {b!r} overlap")


def automaton(units: Units = CODE_POINTS, sentinels: tuple[str, ...] = SENTINELS):
    """Separators (value 1) and sentinels (value 0) in one automaton; a separator that is a sentinel too has value 2."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for s in sentinels:
        found.add_word(s, 0)
    for c in units.separators:
        found.add_word(c, 2 if c in sentinels else 1)
    found.make_automaton()
    return found


class Ranks:
    """Unit counts of one text: n, marked (a sentinel occurs) and the place of any unit's end."""

    def __init__(self, text: str, events, units: Units = CODE_POINTS):
        at, self.marked = [], False
        for end, kind in events.iter(text):
            if kind:
                at.append(end)
            if kind != 1:
                self.marked = True
        places = np.array(at, np.int64)
        # The class changes where a run of separators begins and where it ends.
        first = np.flatnonzero(np.diff(places, prepend=-2) > 1)
        begins = places[first]
        ends = places[np.r_[first[1:] - 1, len(places) - 1]] + 1 if len(places) else places
        edges = np.stack([begins, ends], 1).ravel()
        lengths = np.diff(np.r_[0, edges, len(text)])
        widths = np.where(np.arange(len(lengths)) % 2 == 1, units.between, units.inside)
        counts = np.where(widths == 0, lengths > 0, -(-lengths // np.maximum(widths, 1)))
        self.starts, self.lengths, self.widths = np.r_[0, edges], lengths, widths
        self.upto = np.cumsum(counts)
        self.n = int(self.upto[-1])

    def place(self, rank: int) -> int:
        """Code points of the text's first `rank` units."""
        if not rank:
            return 0
        k = int(np.searchsorted(self.upto, rank))
        before = int(self.upto[k - 1]) if k else 0
        width = int(self.widths[k])
        inside = min(int(self.lengths[k]), (rank - before) * width) if width else int(self.lengths[k])
        return int(self.starts[k]) + inside


def transformed(text: str, h: tuple[int, int, int, int], events, units: Units, sentinels: tuple[str, ...], fim_percent: int, spm_percent: int) -> tuple:
    """(n, form, units of the prefix, units of the middle, output) of one text."""
    ranks = Ranks(text, events, units)
    n = ranks.n
    if not n or ranks.marked or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    i, j = ranks.place(a), ranks.place(z)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    p, s, m = sentinels
    if h[3] % 100 < spm_percent:
        return n, "spm", a, z - a, "".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a, z - a, "".join((p, prefix, s, suffix, m, middle))


def draws(id_: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of `seed:id`; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    units: Units = CODE_POINTS,
    sentinels: tuple[str, str, str] = SENTINELS,
    seed: int = 1,
    fim_percent: int = 90,
    spm_percent: int = 20,
) -> DataFrame:
    """One row per input row: id, n (units), form (plain, psm or spm), prefix_units, middle_units (null if plain), output.

    The draws depend on the id and the seed alone, so that runs agree and repeated rows have equal outputs. A text without
    units (null counts as empty) and one that holds a sentinel stay plain. Rows with a null id are drawn as the empty id.
    Other columns are ignored, whatever their names; an empty table gives an empty result. Texts are read whole; a task
    holds some hundred of them, or one very long one. There is no shuffle.
    """
    import pyarrow as pa

    check_sentinels(sentinels)

    def run(batches: Iterator) -> Iterator:
        events = automaton(units, sentinels)
        for b in (part for whole in batches for part in slices(whole, ROWS)):
            texts = strings(b.column(1)).to_pylist()
            h = zip(*(b.column(k).to_pylist() for k in range(2, 6)), strict=True)
            rows = [transformed(t, x, events, units, sentinels, fim_percent, spm_percent) for t, x in zip(texts, h, strict=True)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["id", "n", "form", "prefix_units", "middle_units", "output"])
        release()

    id_ = col(docs, id_col)
    rows = docs.select(id_.alias("id"), col(docs, text_col).alias("t"), *(h.alias(f"h{k}") for k, h in enumerate(draws(id_, seed))))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, form string, prefix_units long, middle_units long, output string")
    return out.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output of this form was made of, from the two alone; null where the output lacks its marks."""
    quoted = lambda s: "\\Q" + s + "\\E"
    parts = F.split(output, "|".join(map(quoted, sentinels)))  # nothing before the first mark, then the three parts in the form's order
    part = lambda k: F.get(parts, F.lit(k))
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1)))
