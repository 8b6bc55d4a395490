"""Fill-in-middle transformation with piece tables.

A document is a list of descriptors (buffer, start, end) over two immutable buffers: its own UTF-8
bytes and the sentinels.  Cutting splits descriptors, an arrangement permutes them and puts sentinel
descriptors between, the inverse permutation restores the text; texts and hashes are streamed from
the descriptors, so no intermediate copy of a text is made.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from catalogia.llm.common import OUTPUT_CHARS

# The sentinels, and the forms as sequences of sentinels and parts
# (0 prefix, 1 middle, 2 suffix).
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
PLAIN, PSM, SPM = "plain", "psm", "spm"
ARRANGEMENTS = {
    PSM: (PREFIX, 0, SUFFIX, 2, MIDDLE, 1),
    SPM: (SUFFIX, 2, PREFIX, 0, MIDDLE, 1),
}
PLAIN_PERCENT, SPM_PERCENT = 10, 20


@dataclass
class PieceTable:
    """Descriptors (buffer, start, end) whose stretches, one after another, are the content."""

    pieces: list[tuple[memoryview, int, int]]

    @classmethod
    def over(cls, content: bytes) -> PieceTable:
        return cls([(memoryview(content), 0, len(content))])

    def cut(self, *places: int) -> list[PieceTable]:
        """The tables between ascending byte places; descriptors that a place falls into are split."""
        parts, at, left = [[]], 0, list(places)
        for buffer, start, end in self.pieces:
            while left and left[0] < at + end - start:
                inside = start + left.pop(0) - at
                parts[-1].append((buffer, start, inside))
                parts.append([])
                at, start = at + inside - start, inside
            parts[-1].append((buffer, start, end))
            at += end - start
        parts.extend([] for _ in left)
        return [PieceTable([p for p in part if p[1] < p[2]]) for part in parts]

    @classmethod
    def joined(cls, tables: list[PieceTable]) -> PieceTable:
        return cls([piece for table in tables for piece in table.pieces])

    def stretches(self):
        for buffer, start, end in self.pieces:
            yield buffer[start:end]

    def content(self) -> bytes:
        return b"".join(self.stretches())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for stretch in self.stretches():
            digest.update(stretch)
        return digest.hexdigest()


_SENTINEL_VIEW = memoryview(SENTINELS)


def _sentinel(text: bytes) -> PieceTable:
    start = SENTINELS.index(text)
    return PieceTable([(_SENTINEL_VIEW, start, start + len(text))])


def arrange(parts: list[PieceTable], form: str) -> PieceTable:
    """Prefix, middle and suffix in the order of the form, sentinels between them."""
    return PieceTable.joined([parts[x] if isinstance(x, int) else _sentinel(x) for x in ARRANGEMENTS[form]])


def restore(output: bytes, form: str) -> PieceTable:
    """The text as descriptors over an output: its sentinels are found, its parts put back in order.

    A text that is cut holds no sentinel, and none can arise across a cut, so each occurs once.
    """
    whole = PieceTable.over(output)
    if form == PLAIN:
        return whole
    order = ARRANGEMENTS[form]
    marks = [(x, output.index(x)) for x in order if not isinstance(x, int)]
    cuts = sorted(place for x, at in marks for place in (at, at + len(x)))
    found = whole.cut(*cuts)[1:]
    parts = {x: table for x, table in zip(order, found, strict=True) if isinstance(x, int)}
    return PieceTable.joined([parts[i] for i in range(3)])


def byte_place(content: bytes, n_chars: int, chars: int) -> int:
    """Byte place of the code point number ``chars``; ``n_chars`` code points in all."""
    if len(content) == n_chars or not chars:
        return chars
    if chars >= n_chars:
        return len(content)
    return int(np.flatnonzero((np.frombuffer(content, np.uint8) & 0xC0) != 0x80)[chars])


def choose(doc_id: int | None, n: int, marked: bool, seed: int = 1) -> tuple[str, int, int]:
    """(form, first cut, second cut) of a text of ``n`` code points, from its id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not n or marked or h3 % 100 >= 100 - PLAIN_PERCENT:
        return PLAIN, 0, n
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    return SPM if h4 % 100 < SPM_PERCENT else PSM, first, second


OUTPUT = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, "
    "output_sha256 string, restored_sha256 string"
)


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output and two hashes of each row of ``docs``.

    The text is cut at two code points that follow from ``seed`` and the id, and rearranged as
    psm (prefix, suffix, middle) or spm (suffix, prefix, middle); a tenth of the texts, empty and
    null ones and those that hold a sentinel stay plain (null counts as empty; part lengths are
    null).  ``restored_sha256`` is of the text rebuilt from output and form alone.  A row without
    an id takes the cuts of an empty id.  Rows are judged one by one: repeated rows give equal
    rows, an empty table none, and other columns are ignored.
    """
    def run(batches):
        held, size = [], 0

        def rows():
            columns = zip(*held, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            names = [part.split()[0] for part in OUTPUT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                content = text.as_py() or ""
                n, content = len(content), content.encode()
                marked = PREFIX in content or SUFFIX in content or MIDDLE in content
                form, first, second = choose(doc, n, marked, seed)
                table = PieceTable.over(content)
                lengths = (None, None)
                if form != PLAIN:
                    parts = table.cut(byte_place(content, n, first), byte_place(content, n, second))
                    table, lengths = arrange(parts, form), (first, second - first)
                output = table.content()
                held.append((doc, n, form, *lengths, output, table.sha256(), restore(output, form).sha256()))
                size += n
                if size >= OUTPUT_CHARS:
                    yield rows()
                    held, size = [], 0
        if held:
            yield rows()

    return docs.select("doc_id", "text").mapInArrow(run, OUTPUT)


def restored(output: Column, form: Column) -> Column:
    """The text of an output, as a column expression."""
    parts = [rf"(?s)^{a.decode()}(.*?){b.decode()}(.*?){MIDDLE.decode()}(.*)$"
             for a, b in ((PREFIX, SUFFIX), (SUFFIX, PREFIX))]
    psm = F.regexp_replace(output, parts[0], "$1$3$2")
    spm = F.regexp_replace(output, parts[1], "$2$3$1")
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
