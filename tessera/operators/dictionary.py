"""Many terms sought in many texts at once, by an automaton that reads each text once whatever the number of terms."""

from __future__ import annotations

import math
import uuid
from collections import Counter, OrderedDict
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import by_text

#: Characters of terms that one automaton holds and that are sent to every task; a longer dictionary takes several passes.
BLOCK_CHARS = 16 << 20
#: Automata a Python worker keeps.
KEPT = 2
_AUTOMATA: OrderedDict[str, object] = OrderedDict()


@F.pandas_udf(T.StringType())
def casefold(v: pd.Series) -> pd.Series:
    """Letters without case, as Python folds them; null stays null."""
    return v.map(str.casefold, na_action="ignore")


def lowered(x: str) -> str:
    """Each letter in lower case by itself, as DuckDB's lower() has it: ß stays, İ is i, and a sigma is σ wherever it stands."""
    return x.replace("İ", "i").replace("Σ", "σ").lower()


def automaton(terms: list[str], name: str):
    """The Aho-Corasick automaton of terms, built once in each worker."""
    import ahocorasick

    if name not in _AUTOMATA:
        a = ahocorasick.Automaton()
        for t in terms:
            a.add_word(t, t)
        a.make_automaton()
        _AUTOMATA[name] = a
        while len(_AUTOMATA) > KEPT:
            _AUTOMATA.popitem(last=False)
    _AUTOMATA.move_to_end(name)
    return _AUTOMATA[name]


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def occurrences(text: str, found, whole_words: bool, overlaps: bool = True) -> Counter:
    """How often each term stands in text, with or without occurrences that overlap an earlier one of the same term; of whole words only where no letter, digit or _ is beside it."""
    n: Counter = Counter()
    last: dict[str, int] = {}
    for end, term in found.iter(text):
        if whole_words:
            start = end - len(term) + 1
            if (start and _word(text[start - 1]) and _word(term[0])) or (end + 1 < len(text) and _word(text[end + 1]) and _word(term[-1])):
                continue
        if not overlaps:
            if end - last.get(term, -len(term)) < len(term):
                continue
            last[term] = end
        n[term] += 1
    return n


def found_terms(texts: DataFrame, key: str, text: str, terms: DataFrame, *, term: str = "term", fold: bool | Callable[[str], str] = True, whole_words: bool = False, overlaps: bool = True, block: int = BLOCK_CHARS) -> DataFrame:
    """key, term, n: how often each of the terms occurs in each text, one row for each that does.

    With fold both are compared without case, as str.casefold or the given function folds them, and term is the folded form. Without overlaps
    an occurrence counts only behind the end of the one counted before. Null and empty terms and null texts find nothing; terms that are
    equal count as one, and rows that share a key are counted each. Terms of up to `block` characters are broadcast; more are taken
    in blocks by hash, each of which reads the texts once.
    """
    folded = str.casefold if fold is True else fold or None
    t = terms.select(F.col(term).cast("string").alias("term"))
    t = t.select(by_text(folded)("term").alias("term") if folded else "term").where(F.col("term") != "").distinct()
    chars = t.agg(F.sum(F.length("term"))).first()[0] or 0
    if not chars:
        return texts.select(key, F.lit("").alias("term"), F.lit(0).cast("long").alias("n")).where("false")
    blocks, out = math.ceil(chars / block), None
    kind = texts.schema[key].dataType.simpleString()
    for i in range(blocks):
        part = t.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == i) if blocks > 1 else t
        words, name = texts.sparkSession.sparkContext.broadcast([r.term for r in part.collect()]), uuid.uuid4().hex

        def run(batches, words=words, name=name):
            found = automaton(words.value, name) if words.value else None
            for b in batches:
                ids, names, counts = [], [], []
                for k, x in enumerate(b.column(1).to_pylist() if found else []):
                    if x:
                        for w, n in occurrences(folded(x) if folded else x, found, whole_words, overlaps).items():
                            ids.append(k)
                            names.append(w)
                            counts.append(n)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(names, pa.string()), pa.array(counts, pa.int64())], [key, "term", "n"])

        d = texts.select(key, F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, term string, n long")
        out = d if out is None else out.unionByName(d)
    return out
