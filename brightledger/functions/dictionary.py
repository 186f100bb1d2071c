"""Many words looked for at once: one Aho-Corasick automaton for a whole dictionary.

A scan for each word reads a text as often as there are words; the automaton reads it once, whatever the dictionary. It is
built once in each task, from words that travel with the plan, and fed with Arrow batches. What it returns is small (the words
found, or their positions), and scores, categories and choices made of that are column expressions again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def automaton(words: Sequence[str]) -> ahocorasick.Automaton:
    """An automaton that yields ``(end, number)`` for each occurrence of a word, overlapping ones too."""
    found = ahocorasick.Automaton()
    for i, word in enumerate(words):
        if word:
            found.add_word(word, i)
    if len(found):
        found.make_automaton()
    return found


def found_words(text: Column | str, words: Sequence[str], lower: bool = True) -> Column:
    """``array<string>``: the distinct words that a text contains, in the dictionary's order; null for a null text.

    ``lower`` compares lower-cased texts with lower-cased words; what is returned are the words as given.
    """
    distinct = list(dict.fromkeys(words))
    patterns = [w.lower() for w in distinct] if lower else distinct
    # Words that differ in case alone are one pattern.
    numbers: dict[str, list[int]] = {}
    for i, p in enumerate(patterns):
        numbers.setdefault(p, []).append(i)
    keys = list(numbers)

    @F.pandas_udf("array<string>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = automaton(keys)

        def one(t):
            if t is None:
                return None
            hits = {i for _, k in machine.iter(t) for i in numbers[keys[k]]} if len(machine) else ()
            return [distinct[i] for i in sorted(hits)]

        for batch in batches:
            yield batch.map(one)

    column = F.col(text) if isinstance(text, str) else text
    return find(F.lower(column) if lower else column)


def word_positions(text: Column | str, words: Sequence[str]) -> Column:
    """``array<struct<word, position, n_chars>>``: every occurrence of every word, overlapping ones too, by position, then length."""
    distinct = list(dict.fromkeys(words))

    @F.pandas_udf("array<struct<word: string, position: int, n_chars: int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = automaton(distinct)

        def one(t):
            if t is None:
                return None
            hits = sorted((end - len(distinct[k]) + 1, len(distinct[k]), k) for end, k in machine.iter(t)) if len(machine) else ()
            return [{"word": distinct[k], "position": at, "n_chars": n} for at, n, k in hits]

        for batch in batches:
            yield batch.map(one)

    return find(F.col(text) if isinstance(text, str) else text)


def hits(found: Column | str, words: Sequence[str]) -> Column:
    """How many of some words are among those found; one that stands twice counts twice."""
    column = F.col(found) if isinstance(found, str) else found
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.array_contains(column, w)))


def best_of(found: Column | str, groups: dict[str, Sequence[str]]) -> Column:
    """``struct<hits, order, name, of, words>`` of the group most of whose words are found; of equals, and where none is, the first."""
    column = F.col(found) if isinstance(found, str) else found
    scores = []
    for i, (name, words) in enumerate(groups.items()):
        own = F.filter(F.array(*map(F.lit, words)), lambda w: F.array_contains(column, w))
        scores.append(F.struct(F.size(own).alias("hits"), F.lit(-i).alias("order"), F.lit(name).alias("name"), F.lit(len(words)).alias("of"), own.alias("words")))
    return F.array_max(F.array(*scores))


def first_of(found: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The name of the first rule one of whose words is found."""
    column = F.col(found) if isinstance(found, str) else found
    chosen = F.when(F.lit(False), "")
    for name, words in rules:
        chosen = chosen.when(F.arrays_overlap(column, F.array(*map(F.lit, words))), name)
    return chosen.otherwise(default)
