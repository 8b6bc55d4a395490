"""Dictionary matching by Aho-Corasick automata: every list of a profile in one pass over a text.

An automaton is compiled once per profile and Python worker from dictionaries that are broadcast
after their size has been measured.  What it finds in the texts of an item is the part of the
profile's dictionaries that the item needs: rules and scores run on that part unchanged, so their
cost follows the names that occur in a title and not the names that a profile lists.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from catalogia.functions import title, who
from catalogia.operators import distribution
from catalogia.operators.profiles import DICTIONARY, wide

# Names of one profile above which an automaton pays for the way to Python and back.
AUTOMATON_TERMS = 1_000


# Fields of an entry that are names by which it is looked up.
NAMES = ("name", "name_lc", "track")


def _automaton(terms: Iterable[str]) -> tuple[ahocorasick.Automaton, list[int]]:
    """The automaton of numbered distinct terms, and the numbers of those that are in any text."""
    automaton, always = ahocorasick.Automaton(ahocorasick.STORE_INTS), []
    for i, term in enumerate(terms):
        if term:
            automaton.add_word(term, i)
        else:
            always.append(i)
    if len(automaton):
        automaton.make_automaton()
    return automaton, always


def _inside(automaton: ahocorasick.Automaton, always: list[int], texts: Iterable[str | None]) -> set[int]:
    found = set(always)
    if len(automaton):
        for text in set(texts):
            if text:
                found.update(i for _, i in automaton.iter(text))
    return found


class Terms:
    """Numbered terms and the automaton that finds them."""

    def __init__(self, terms: Iterable[str]):
        self.terms = list(dict.fromkeys(terms))
        self.automaton, self.always = _automaton(self.terms)

    def inside(self, *texts: str | None) -> set[int]:
        """Numbers of the terms that are a substring of one of the texts; the empty one always is."""
        return _inside(self.automaton, self.always, texts)


# An entry's number is its list's number times ENTRIES plus its place among the entries of all profiles.
ENTRIES = 1 << 40


class Dictionary:
    """The terms of one profile's lists, their automaton, and the numbers of the entries that a term leads to."""

    def __init__(self, lists: list[pa.ListArray], row: int):
        terms, numbers = [pa.array([], pa.string())], [np.zeros(0, np.int64)]
        for k, entries in enumerate(lists):
            first, last = entries.offsets[row].as_py(), entries.offsets[row + 1].as_py()
            values = entries.values.slice(first, last - first)
            places = np.arange(first, last) + k * ENTRIES
            # An entry is looked up by its text, or by its fields that are names.
            for keys in [values] if pa.types.is_string(values.type) else [
                    pc.struct_field(values, n) for n in NAMES if values.type.get_field_index(n) >= 0]:
                known = keys.is_valid()
                terms.append(keys.filter(known))
                numbers.append(places[known.to_numpy(zero_copy_only=False)])
        coded = pa.concat_arrays(terms).dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        self.entries = np.concatenate(numbers)[order]
        self.bounds = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
        self.automaton, self.always = _automaton(t.as_py() for t in coded.dictionary)

    def inside(self, *texts: str | None) -> np.ndarray:
        """Ascending numbers of the entries with a name inside one of the texts."""
        found = _inside(self.automaton, self.always, texts)
        return np.unique(np.concatenate([self.entries[:0], *(self.entries[self.bounds[i]:self.bounds[i + 1]] for i in found)]))


class Dictionaries:
    """The dictionaries of all profiles in Arrow buffers; a profile is compiled when an item first asks for it."""

    def __init__(self, data: bytes, kind: T.StructType):
        table = pa.ipc.open_stream(data).read_all().combine_chunks()
        self.row = {name: i for i, name in enumerate(table.column("profile").to_pylist())}
        self.fields = list(to_arrow_type(kind))
        held = pa.StructArray.from_arrays([], fields=[], mask=pa.array([], pa.bool_())) if not table.num_rows else table.column(DICTIONARY).chunk(0)
        self.columns = {f.name: held.field(f.name) if table.num_rows else pa.array([], f.type) for f in self.fields}
        self.lists = [name for name, column in self.columns.items() if pa.types.is_list(column.type)]
        self.compiled: dict[int, Dictionary] = {}

    def part(self, profiles: list[str | None], texts: list[tuple]) -> pa.StructArray:
        """Per item the dictionaries of its profile reduced to entries with a name inside one of its
        texts, in their order; null where the profile is unknown."""
        rows = np.array([self.row.get(name, -1) for name in profiles], np.int64)
        found = []
        for row, some in zip(rows.tolist(), texts, strict=True):
            if row >= 0 and row not in self.compiled:
                self.compiled[row] = Dictionary([self.columns[n] for n in self.lists], row)
            found.append(self.compiled[row].inside(*some) if row >= 0 else np.zeros(0, np.int64))
        item = np.repeat(np.arange(len(found)), [len(f) for f in found])
        numbers = np.concatenate([np.zeros(0, np.int64), *found])
        of_list, unknown = numbers // ENTRIES, rows < 0
        asked = pa.array(rows, pa.int64(), mask=unknown)
        arrays = []
        for field in self.fields:
            column = self.columns[field.name]
            if field.name not in self.lists:
                arrays.append(column.take(asked).cast(field.type))
                continue
            here = of_list == self.lists.index(field.name)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(item[here], minlength=len(found)))])
            values = column.values.take(pa.array(numbers[here] % ENTRIES)).cast(field.type.value_type)
            none = pc.fill_null(column.is_null().take(asked), True)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, type=field.type, mask=none))
        return pa.StructArray.from_arrays(arrays, fields=self.fields, mask=pa.array(unknown))


# What this Python worker has compiled: mark and dictionaries of the last query that asked.
_held: list = [None, None]


def _dictionaries(mark: str, known, kind: T.StructType) -> Dictionaries:
    if _held[0] != mark:
        _held[:] = mark, Dictionaries(known.value, kind)
    return _held[1]


def _largest(dictionaries: DataFrame) -> int:
    """Entries of the largest profile."""
    lists = [f.name for f in dictionaries.schema[DICTIONARY].dataType.fields if isinstance(f.dataType, T.ArrayType)]
    entries = sum((F.coalesce(F.size(f"{DICTIONARY}.{name}"), F.lit(0)) for name in lists), F.lit(0))
    return dictionaries.agg(F.max(entries).alias("n")).first()["n"] or 0


def worthwhile(dictionaries: DataFrame, terms: int = AUTOMATON_TERMS) -> bool:
    """Whether some profile is large enough for an automaton while all of them fit a broadcast."""
    return _largest(dictionaries) > terms and distribution.fits_broadcast(dictionaries)


def attach_found(items: DataFrame, profiles: DataFrame, **lists) -> DataFrame:
    """Items with the part of their profile's dictionaries that their title or channel needs.

    The same column that ``with_dictionary`` adds, reduced to entries that occur; an item of an
    unknown profile has null.
    """
    dictionaries = wide(profiles, **lists)
    kind = dictionaries.schema[DICTIONARY].dataType
    table, sink = dictionaries.toArrow(), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    known, mark = items.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes()), uuid.uuid4().hex

    @F.arrow_udf(kind)
    def found(profile: pa.Array, text: pa.Array, text_lc: pa.Array, by: pa.Array, by_lc: pa.Array) -> pa.Array:
        texts = list(zip(*[c.to_pylist() for c in (text, text_lc, by, by_lc)], strict=True))
        return _dictionaries(mark, known, kind).part(profile.to_pylist(), texts)

    return items.withColumn(DICTIONARY, found("profile", title(), F.lower(title()), who(), F.lower(who())))


def matched_terms(texts: DataFrame, column: Column, terms: DataFrame, by: str = "profile") -> DataFrame:
    """Add ``terms``: the dictionary terms (distinct, ascending) that are substrings of a text column.

    ``terms(<by>, term)`` are the dictionaries, one per value of ``by``; their size is measured, and
    above the broadcast limit each term meets the texts in a join on a substring of its own
    length instead.  Null texts hold nothing; null terms are ignored.
    """
    listed = terms.filter("term is not null").select(by, "term").distinct()
    if not distribution.fits_broadcast(listed):
        return _matched_by_join(texts, column, listed, by)
    grouped = listed.groupBy(by).agg(F.collect_list("term").alias("terms"))
    known = texts.sparkSession.sparkContext.broadcast({row[by]: row["terms"] for row in grouped.toLocalIterator()})
    compiled: dict = {}

    @F.arrow_udf("array<string>")
    def found(key: pa.Array, text: pa.Array) -> pa.Array:
        rows = []
        for name, one in zip(key.to_pylist(), text.to_pylist(), strict=True):
            if name not in compiled:
                compiled[name] = Terms(known.value.get(name, []))
            held = compiled[name]
            rows.append(sorted(held.terms[i] for i in held.inside(one)) if one is not None else [])
        return pa.array(rows, pa.list_(pa.string()))

    return texts.withColumn("terms", found(by, column))


def _matched_by_join(texts: DataFrame, column: Column, terms: DataFrame, by: str) -> DataFrame:
    """``matched_terms`` for dictionaries of any size: substrings of the lengths that terms have."""
    lengths = terms.select(by, F.char_length("term").alias("size")).groupBy(by).agg(F.collect_set("size").alias("sizes"))
    keyed = texts.withColumns({"_id": F.monotonically_increasing_id(), "_text": column})
    keyed = distribution.cut_lineage(keyed)
    sized = keyed.select("_id", by, "_text").join(lengths, by)
    starts = F.transform("sizes", lambda n: F.when(
        F.char_length("_text") >= n, F.sequence(F.lit(1), F.char_length("_text") - n + 1)).otherwise(F.array().cast("array<int>")))
    pieces = F.flatten(F.zip_with("sizes", starts, lambda n, at: F.transform(
        at, lambda i: F.when(n == 0, F.lit("")).otherwise(F.substr("_text", i, n)))))
    met = sized.select("_id", by, F.explode(F.array_distinct(pieces)).alias("term")).join(terms, [by, "term"])
    found = met.groupBy("_id").agg(F.array_sort(F.collect_list("term")).alias("terms"))
    none = F.array().cast("array<string>")
    return keyed.join(found, "_id", "left").withColumn("terms", F.coalesce("terms", none)).drop("_id", "_text")
