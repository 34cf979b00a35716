"""Fill-in-middle: a text's middle goes behind its prefix and suffix, cut between units of one match."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# What a text is cut between: code points.
CODE_POINT = "."
# Of a hundred texts, so many stay as they are; of the others so many have the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
# One match holds the ends of so many units at most (some 100 bytes each).
MATCH_UNITS = 1_000_000
# Texts of so many characters are handed on at once.
SLICE_CHARS = 2_000_000

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Units:
    """Finds where the units of a text end, by a pattern that must match at every place of every text."""

    def __init__(self, unit: str, match_units: int):
        import regex

        self.all = regex.compile(f"({unit})*", regex.DOTALL)
        self.some = regex.compile(f"({unit}){{1,{match_units}}}+", regex.DOTALL)
        self.match_units = match_units

    def ends(self, text: str) -> np.ndarray | list[int]:
        """One match of the whole text keeps every repetition of its group. A text that may have more
        than `match_units` is matched that many at a time, each match from the end of the one before."""
        if len(text) <= self.match_units:
            match = self.all.fullmatch(text)
            if match is None:
                raise ValueError("a text that is not made of units")
            return match.ends(1)
        found, at = [], 0
        while at < len(text):
            match = self.some.match(text, at)
            if match is None or match.end() == at:
                raise ValueError("a text that is not made of units")
            found.append(np.array(match.ends(1), np.int64))
            at = match.end()
        return np.concatenate(found)


def numbers(seed: int, doc_id: int | None) -> list[int]:
    """Four unsigned 32-bit numbers by a hash of seed and doc_id (null: nothing)."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(found[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, doc_id: int | None, units: Units, seed: int) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    ends = units.ends(text)
    n = len(ends)
    h1, h2, h3, h4 = numbers(seed, doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, len(prefix), len(middle), output


def fill_in_middle(docs: DataFrame, unit: str = CODE_POINT, seed: int = 1, match_units: int = MATCH_UNITS) -> DataFrame:
    """Each text of `docs` (doc_id, text) with its middle last: SCHEMA.

    A text is n units. Two hashes of `seed` and doc_id say after how many of them its prefix and its middle end, a third
    whether the text stays as it is (`plain`, with null lengths), a fourth whether its suffix comes first (`spm`) or
    its prefix (`psm`). A text that holds one of the marks stays plain, so that marks are never ambiguous.
    Lengths are in code points. Nothing is shuffled, and memory is bounded by the longest text and `match_units`.

    Null texts are empty and plain; a null doc_id hashes as nothing; rows that share a doc_id and a text give the same
    row each; an empty table gives none. Other columns are not used.
    """
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(unit, match_units)
        for batch in batches:
            found, size = [], 0
            for doc_id, text in zip(*(batch.column(c) for c in ("doc_id", "text"))):
                doc_id, text = doc_id.as_py(), text.as_py() or ""
                found.append((doc_id, *transform(text, doc_id, units, seed)))
                size += len(text)
                if size > SLICE_CHARS:
                    yield rows(found)
                    found, size = [], 0
            yield rows(found)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(convert, SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text that `output` was made of; null where either is null or the form is unknown."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(output, second, 1)
        tail = F.substr(output, F.length(head) + len(second) + 1)
        inner = F.substring_index(tail, MIDDLE, 1)
        return F.substr(head, F.lit(len(first) + 1)), inner, F.substr(tail, F.length(inner) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix_2, prefix_2, middle_2 = parts(SUFFIX, PREFIX)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2))
    )
