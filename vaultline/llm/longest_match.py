"""Token counts by a linear longest-match automaton: a vocabulary trie with failure links and popped counts."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from vaultline.llm.spans import Words, chunks

ROOT, NONE = 0, -1
CACHE = 1_000_000  # words whose counts a task remembers


@dataclass
class Automaton:
    """``keys``: sorted node * 256 + byte of all trie edges; ``to``: the node below.

    failure, popped: where to go on when no edge fits, and how many whole pieces lie behind; NONE: the word
    can't be built. rest: pieces from a node to the end of the word, NONE likewise. start: after the mark.
    """

    keys: np.ndarray
    to: np.ndarray
    failure: np.ndarray
    popped: np.ndarray
    rest: np.ndarray
    start: int


def build(pieces: Iterable[bytes], mark: bytes = b" ") -> Automaton:
    """Pieces that begin with ``mark`` start a word, all others go on in one."""
    below: list[dict[int, int]] = [{}]
    whole = [False]
    order = [(ROOT, ROOT, 0)]
    for piece in pieces:
        node = ROOT
        for byte in piece:
            if byte not in below[node]:
                below[node][byte] = len(below)
                below.append({})
                whole.append(False)
            node = below[node][byte]
        whole[node] = node != ROOT
    for node, _, _ in order:  # grows meanwhile: breadth first
        order += [(child, node, byte) for byte, child in below[node].items()]
    failure, popped, rest = (np.full(len(below), NONE, dtype=np.int64) for _ in range(3))
    popped[:] = 0
    rest[ROOT] = 0
    for node, parent, byte in order[1:]:
        if whole[node]:
            failure[node], popped[node] = ROOT, 1
        else:
            at, count = failure[parent], popped[parent]
            while at != NONE and byte not in below[at]:
                count += popped[at]
                at = failure[at]
            if at != NONE:
                failure[node], popped[node] = below[at][byte], count
        if failure[node] != NONE and rest[failure[node]] != NONE:
            rest[node] = popped[node] + rest[failure[node]]
    edges = np.array([(n * 256 + b, child) for n, own in enumerate(below) for b, child in own.items()], dtype=np.int64)
    edges = edges.reshape(-1, 2)[np.argsort(edges.reshape(-1, 2)[:, 0])]
    start = ROOT
    for byte in mark:
        start = below[start].get(byte, NONE) if start != NONE else NONE
    return Automaton(edges[:, 0], edges[:, 1], failure, popped, rest, start)


def read_pieces(path: str) -> list[bytes]:
    """A file of lines with a piece in base64 and its rank."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def piece_counts(automaton: Automaton, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces of each span; NONE if it can't be built. All spans go through the automaton in step."""
    state = np.full(len(starts), automaton.start)
    counts = np.zeros(len(starts), dtype=np.int64)
    order = np.argsort(starts - ends, kind="stable")  # the longest first
    sizes = (ends - starts)[order]
    for step in range(int(sizes[0]) if len(sizes) else 0):
        active = order[: np.searchsorted(-sizes, -step, side="left")]
        active = active[state[active] != NONE]
        byte = buffer[starts[active] + step].astype(np.int64)
        while len(active):
            key = state[active] * 256 + byte
            at = np.minimum(np.searchsorted(automaton.keys, key), len(automaton.keys) - 1)
            hit = automaton.keys[at] == key if len(automaton.keys) else np.zeros(len(key), dtype=bool)
            state[active[hit]] = automaton.to[at[hit]]
            active, byte = active[~hit], byte[~hit]
            counts[active] += automaton.popped[state[active]]
            state[active] = automaton.failure[state[active]]
            going = state[active] != NONE
            active, byte = active[going], byte[going]
    last = np.where(state == NONE, NONE, automaton.rest[state])
    return np.where(last == NONE, NONE, counts + last)


def count_tokens(docs: DataFrame, pieces: Iterable[bytes], mark: bytes = b" ") -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` for each row of ``docs`` (doc_id, text; others are not read).

    n_tokens: greedy longest-match pieces of all words, ``[^\\x20\\x09-\\x0D]+``; a word that can't be built
    is one token and counts in n_unknown. The automaton (bounded by the vocabulary) is broadcast. A word is
    gone through once for each task, in linear time, and no piece is built. Null and empty texts have no
    words; repeated rows are counted each; an empty table gives no rows.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(vars(build(pieces, mark)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine, known = Automaton(**automaton.value), {}
        for frame in frames:
            texts = frame["text"].tolist()
            for part in chunks(texts):
                words = Words(texts[part])
                unique, where, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                unique = unique.tolist()
                new = np.array([i for i, h in enumerate(unique) if h not in known], dtype=np.int64)
                found = piece_counts(machine, words.buffer, words.starts[where[new]], words.ends[where[new]])
                if len(known) > CACHE:
                    mine = {h: known[h] for h in unique if h in known}
                    known = mine
                known.update(zip((unique[i] for i in new.tolist()), found.tolist()))
                counts = np.array([known[h] for h in unique], dtype=np.int64)[which] if unique else np.zeros(0, np.int64)
                sums = np.concatenate([[0], np.cumsum(np.where(counts == NONE, 1, counts))])
                bad = np.concatenate([[0], np.cumsum(counts == NONE)])
                first, last = words.first[:-1], words.first[1:]
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[part].to_numpy(),
                        "n_words": last - first,
                        "n_tokens": sums[last] - sums[first],
                        "n_unknown": bad[last] - bad[first],
                    }
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInPandas(
        run, "doc_id long, n_words long, n_tokens long, n_unknown long"
    )
