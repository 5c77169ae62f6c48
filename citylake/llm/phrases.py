"""Substring dedup: recurring passages are confirmed, compiled to sharded Aho-Corasick automata, and located."""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from citylake.llm.common import prepare, written
from citylake.llm.repeats import Rule, recurring, resolved, runs, window_hashes

WORDS = 50
RULE = Rule(window=WORDS, gram=25, words=True, ordered=True)


def by_automaton(contexts: list[tuple[int, int, int, bytes]], rule: Rule) -> list[np.ndarray]:
    """Which windows of each passage also start in a document with a smaller id.

    Windows whose hash recurs are confirmed by their words and become the phrases of one automaton over word numbers,
    each with the smallest document that has it; all passages then stream through it.
    """
    numbers: dict[bytes, int] = {}
    passages = [tuple(numbers.setdefault(w, len(numbers)) for w in raw.split()) for *_, raw in contexts]
    docs = np.array([c[2] for c in contexts], np.int64)
    hashes = window_hashes(contexts, rule)
    flat, owner = np.concatenate(hashes), np.repeat(docs, [len(h) for h in hashes])
    _, group = np.unique(flat, return_inverse=True)
    least, most = np.full(len(flat), 2**63 - 1), np.full(len(flat), -(2**63))
    np.minimum.at(least, group, owner)
    np.maximum.at(most, group, owner)
    recurring = np.split((least < most)[group], np.cumsum([len(h) for h in hashes])[:-1])
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for passage, doc, places in zip(passages, docs.tolist(), recurring, strict=True):
        for at in np.flatnonzero(places).tolist():
            phrase = passage[at : at + rule.window]
            automaton.add_word(phrase, min(doc, automaton.get(phrase, doc)))
    flags = [np.zeros(len(h), bool) for h in hashes]
    if len(automaton):
        automaton.make_automaton()
        for passage, doc, found in zip(passages, docs.tolist(), flags, strict=True):
            for end, first in automaton.iter(passage):
                if first < doc:
                    found[end - rule.window + 1] = True
    return flags


def cut_words(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Words, words removed, and the words left, joined by one space."""
    words, kept, at = raw.split(), [], 0
    for start, end in spans:
        kept += words[at:start]
        at = end
    return len(words), sum(end - start for start, end in spans), b" ".join([*kept, *words[at:]]).decode()


CUT = [(StructField("n_words", LongType()), pa.int64()), (StructField("n_removed", LongType()), pa.int64()), (StructField("kept", StringType()), pa.string())]


def clean(docs: DataFrame, rule: Rule = RULE, text: str = "text", key: str = "doc_id", finish=cut_words, fields=CUT) -> DataFrame:
    """Per row: doc_id and, by default, n_words, n_removed and `kept`, the words that are left.

    Words are runs of characters that are no ASCII white space. A word goes if a window of 50 words that covers it also
    starts in a document with a smaller id; windows are judged on the input. A null text has no words; rows without an id
    together stand after all others; repeated rows of an id are one document; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    found = written(runs(docs, rule, text, key), "passages")
    return resolved(docs, found, recurring(found), rule, by_automaton, finish, fields, text, key)
