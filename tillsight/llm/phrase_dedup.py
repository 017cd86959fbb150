"""Substring dedup by repeated-phrase automata: removes words under ``LENGTH``-word windows that occur twice.

Candidate passages (``repeats``: windows whose anchor occurs at two places or more) are sharded by their anchor.
A shard confirms which windows really occur more than once, joins neighbouring ones to phrases, compiles the
phrases into one Aho-Corasick automaton over word numbers (pyahocorasick), and streams the passages of all
documents that lead to this shard through it to locate every occurrence. Shards hold different anchors, so
every document passes exactly the automata whose phrases can occur in it. A passage that many documents share
is one row a chunk with its count. A task takes its anchors in bounded turns; the windows of an anchor with more
passages than a task may hold meet in an aggregate of Spark instead (``repeats.window_answers``).

Windows are judged on the input and never cross documents. Edge cases: null texts have no words; texts below
``LENGTH`` words lose nothing; repeated rows are different places, whatever their id; extra columns are ignored.
Texts of any length are read whole: a long document is a chunk of its own.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats
from .common import map_batches, written
from .repeats import Chunk, Kind

LENGTH, GRAM = 35, 8
#: Passages that a task holds at a time, besides those of one anchor.
TURN = 50_000


def confirmed(passages: dict[tuple, int], length: int = LENGTH) -> set[tuple]:
    """Phrases of the passages of one anchor (word numbers, with their times): maximal runs of windows that
    occur at two places or more."""
    if len(passages) == 1:
        return {p for p, n in passages.items() if n > 1}
    times: dict[tuple, int] = defaultdict(int)
    for p, n in passages.items():
        for k in range(len(p) - length + 1):
            times[p[k:k + length]] += n
    out = set()
    for p in passages:
        first = None
        for k in range(len(p) - length + 2):
            again = k <= len(p) - length and times[p[k:k + length]] > 1
            if again and first is None:
                first = k
            elif not again and first is not None:
                out.add(p[first:k - 1 + length])
                first = None
    return out


def locate(rows: pd.DataFrame, length: int = LENGTH) -> pd.DataFrame:
    """``chunk, first, last, least`` of every interval of repeated windows (``least`` is not used here)."""
    numbers: dict[bytes, int] = {}
    texts = [tuple(numbers.setdefault(w, len(numbers)) for w in t.split(b" ")) for t in rows["slice"]]
    places = [np.frombuffer(p, "<i8") for p in rows["places"]]
    by_anchor: dict[int, dict[tuple, int]] = defaultdict(lambda: defaultdict(int))
    for key, t, p in zip(rows["key"], texts, places):
        by_anchor[key][t] += len(p)
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for passages in by_anchor.values():
        for phrase in confirmed(passages, length):
            machine.add_word(phrase, len(phrase))
    out, known = [], {}
    if len(machine):
        machine.make_automaton()
        for c, t, p in zip(rows["chunk"], texts, places):
            if t not in known:
                hit: list[list[int]] = []
                for end, size in sorted((e, n) for e, n in machine.iter(t)):
                    first, last = end - size + 1, end - length + 1
                    while hit and first <= hit[-1][1] + 1:
                        first = min(first, hit.pop()[0])
                    hit.append([first, last])
                known[t] = hit
            out += [(c, int(s) + a, int(s) + b, 0) for a, b in known[t] for s in p]
    return pd.DataFrame(out, columns=["chunk", "first", "last", "least"])


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_kept: bool = True, most: int = repeats.MANY) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and the ``kept`` words joined by blanks)."""
    kind = Kind(length, gram, True)
    table = repeats.chunks(docs)
    masks, buckets, many = repeats.repeated_anchors(table, kind, most)
    passages = repeats.slices(table, masks, buckets, kind).repartition("key").sortWithinPartitions("key")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in repeats.turns(batches, TURN):
            yield from repeats.answer_rows(locate(rows, length))

    answers = map_batches(passages, shard, "chunk long, answer binary")
    answers = written(answers.union(repeats.window_answers(table, masks, buckets, kind)) if many else answers, "answers")

    def apply(chunk: Chunk, answer: np.ndarray) -> list[tuple]:
        words = [t.split() for t in chunk.texts]
        edge = np.zeros(sum(map(len, words)) + 1, np.int64)
        np.add.at(edge, answer["first"], 1)
        np.add.at(edge, answer["last"] + length, -1)
        gone, at, rows = (np.cumsum(edge[:-1]) > 0).tolist(), 0, []
        for i, w in zip(chunk.ids, words):
            mine = gone[at:at + len(w)]
            at += len(w)
            kept = b" ".join(x for x, g in zip(w, mine) if not g)
            rows.append((i, len(w), sum(mine), hashlib.sha256(kept).hexdigest(), kept.decode() if with_kept else None))
        return rows

    out = repeats.answered(table, answers, apply, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string", OUT)
    return out if with_kept else out.drop("kept")
