"""Byte-pair encoding and decoding: byte pairs that no token holds are sure cuts, fragments are encoded by themselves."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vaultline.llm.spans import chunks, span_hashes

CHUNK = 500_000  # characters of texts at once
SHORT = 24  # bytes of the fragments that are merged side by side; longer ones take a queue each
SIDE_BY_SIDE = 20_000  # fragments in one table
CACHE = 1_000_000  # tokens of fragments that a worker remembers
NEVER = np.int64(1) << 40

# What the pre-tokenizer's pattern tells apart; EDGE is the end of a text, or an added token.
LETTER, DIGIT, OTHER, SPACE, WHITE, EDGE = range(1, 7)


@dataclass
class BytePairs:
    """A byte-level vocabulary as arrays.

    text, offset: bytes of all ids; first: ids of the 256 bytes; pairs: sorted id * count + id of two tokens
    that merge, with their rank; merged: the id of each rank's token; inside: of each two bytes (the first
    * 256 + the second), whether some token holds them side by side; added: texts that are one token, and ids.
    """

    text: np.ndarray
    offset: np.ndarray
    first: np.ndarray
    pairs: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    inside: np.ndarray
    added: dict[str, int]

    @property
    def count(self) -> int:
        return len(self.offset) - 1

    def parts(self) -> dict:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def byte_alphabet() -> dict[str, int]:
    """The character by which byte-level files write each byte: itself if it is visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_byte_pairs(path: str) -> BytePairs:
    """Reads a byte-level vocabulary with merges (JSON); other kinds of it are refused."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
    plain = plain and not model.get("ignore_merges") and spec["normalizer"] is None
    usual = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if model["type"] != "BPE" or not plain or not usual or (spec["decoder"] or {}).get("type") != "ByteLevel":
        raise ValueError("only plain byte-level vocabularies with merges are supported")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError("only added tokens that stand for their text are supported")
    byte_of = byte_alphabet()
    texts = {i: bytes(byte_of[c] for c in token) for token, i in model["vocab"].items()}
    inside = np.zeros(1 << 16, dtype=bool)
    for text in texts.values():
        inside[[a * 256 + b for a, b in zip(text, text[1:])]] = True
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    texts |= {i: content.encode() for content, i in added.items()}
    count = max(texts) + 1
    vocabulary = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([vocabulary[a] * count + vocabulary[b] for a, b in merges], dtype=np.int64)
    order = np.argsort(keys)
    pieces = [texts.get(i, b"") for i in range(count)]
    first = np.zeros(256, dtype=np.int64)
    for character, byte in byte_of.items():
        first[byte] = vocabulary[character]
    return BytePairs(
        text=np.frombuffer(b"".join(pieces), dtype=np.uint8),
        offset=np.cumsum([0, *map(len, pieces)]),
        first=first,
        pairs=keys[order],
        rank=order.astype(np.int64),
        merged=np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64),
        inside=inside,
        added=added,
    )


def gathered(offset: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the items of all ``which`` rows of a ragged array, and the bounds of each row."""
    bounds = np.concatenate([[0], np.cumsum(offset[which + 1] - offset[which])])
    return np.arange(bounds[-1]) + np.repeat(offset[which] - bounds[:-1], np.diff(bounds)), bounds


class CharacterKinds:
    """The kind of each code point, asked of the library's own pre-tokenizer when it is first seen.

    Its tables of letters and digits are of another Unicode version than Python's.
    """

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        self.split = ByteLevel(add_prefix_space=False)
        self.table = np.zeros(0x110000, dtype=np.uint8)

    def _kind(self, code: int) -> int:
        if code == 0x20:
            return SPACE
        for kind, start in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")):
            if len(self.split.pre_tokenize_str(start + chr(code))) == 1:
                return kind
        return WHITE

    def of(self, codes: np.ndarray) -> np.ndarray:
        kinds = self.table[codes]
        if not kinds.all():
            for code in np.unique(codes[kinds == 0]).tolist():
                self.table[code] = self._kind(code)
            kinds = self.table[codes]
        return kinds


def pattern_cuts(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether the pre-tokenizer's pattern cuts before each character; the last has to be an EDGE.

    A run of one kind is a piece. One blank before letters, digits or others belongs to them, the white space
    before that is a piece of its own. After "'" the letters s, t, m, d, re, ve and ll make a piece with it.
    """
    before = np.concatenate([[EDGE], kind[:-1]]).astype(np.uint8)
    behind = np.concatenate([kind[1:], [EDGE]]).astype(np.uint8)
    white, white_before = (kind == SPACE) | (kind == WHITE), (before == SPACE) | (before == WHITE)
    cut = kind != before
    both = white & white_before
    cut[both] = ~np.isin(behind[both], (SPACE, WHITE, EDGE))
    cut[white_before & ~white & (before == SPACE)] = False
    cut |= (kind == EDGE) | (before == EDGE)
    at = np.flatnonzero((codes == ord("'")) & (kind == OTHER) & (before != OTHER) & (before != SPACE))
    if len(at):
        padded = np.concatenate([np.where(kind == LETTER, codes, 0), [0, 0]])
        one, two = padded[at + 1], padded[at + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        cut[at[single | double] + 1] = False
        cut[at[single] + 2] = True
        cut[at[double] + 3] = True
    return cut


class PairEncoder:
    """Encodes batches of texts; fragments seen before come from memory. Added tokens are plain text if not ``special``."""

    def __init__(self, model: BytePairs, special: bool = True):
        self.model, self.special = model, special and bool(model.added)
        self.kinds = CharacterKinds()
        self.size = np.diff(model.offset)
        longest_first = sorted(model.added, key=len, reverse=True)
        self.finder = re.compile("|".join(map(re.escape, longest_first)))
        self.slot_of = {content: 1 + i for i, content in enumerate(model.added)}
        self.byte_rank = self._ranks(*(model.first[x] for x in np.divmod(np.arange(1 << 16), 256)))
        self.rank_of = dict(zip(model.pairs.tolist(), model.rank.tolist()))
        self.forget()

    def forget(self) -> None:
        """Slot 0 holds nothing, for what parts the texts; the next ones hold the added tokens."""
        self.known: dict[int, int] = {}
        self.tokens = np.array(list(self.model.added.values()), dtype=np.int32)
        self.offset = np.concatenate([[0], np.arange(len(self.tokens) + 1)])

    def _ranks(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        model = self.model
        key = one * model.count + two
        at = np.minimum(np.searchsorted(model.pairs, key), len(model.pairs) - 1)
        hit = (model.pairs[at] == key) & (one >= 0) & (two >= 0) if len(model.pairs) else np.zeros(key.shape, bool)
        return np.where(hit, model.rank[at] if len(model.pairs) else 0, NEVER)

    def _side_by_side(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A row of ids for each fragment, with -1 behind the last; every step merges the best pair of every row."""
        width = int(sizes.max())
        column = np.arange(width)
        byte = buffer[np.minimum(starts[:, None] + column, len(buffer) - 1)].astype(np.int64)
        there = column < sizes[:, None]
        ids = np.where(there, self.model.first[byte], -1)
        rank = np.where(there[:, 1:], self.byte_rank[byte[:, :-1] * 256 + byte[:, 1:]], NEVER)
        done, rows = ids.copy(), np.arange(len(ids))
        while width > 1:
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rank)), at]
            go = best < NEVER
            if not go.all():
                done[rows[~go]] = ids[~go]
                ids, rank, rows, at, best = ids[go], rank[go], rows[go], at[go], best[go]
            if not len(rows):
                break
            line = np.arange(len(rows))
            ids = np.take_along_axis(ids, np.minimum(column + (column > at[:, None]), width - 1), axis=1)
            ids[:, -1] = -1
            ids[line, at] = token = self.model.merged[best]
            rank = np.take_along_axis(rank, np.minimum(column[:-1] + (column[:-1] > at[:, None]), width - 2), axis=1)
            rank[:, -1] = NEVER
            rank[line, at] = NEVER
            right = at < width - 1
            rank[line[right], np.minimum(at, width - 2)[right]] = self._ranks(token, ids[line, np.minimum(at + 1, width - 1)])[right]
            left = at > 0
            rank[line[left], at[left] - 1] = self._ranks(ids[line, at - 1], token)[left]
        return done

    def _queued(self, raw: bytes) -> list[int]:
        """One long fragment: the lowest rank first, the leftmost of equals, by a queue."""
        count, ranks, merged = self.model.count, self.rank_of, self.model.merged
        ids = self.model.first[np.frombuffer(raw, dtype=np.uint8)].tolist()
        end = len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        queue = [(ranks[k], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (k := a * count + b) in ranks]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= end or ranks.get(ids[i] * count + ids[j]) != rank:
                continue  # merged otherwise meanwhile
            ids[i], ids[j] = int(merged[rank]), -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < end and (found := ranks.get(ids[a] * count + ids[b])) is not None:
                    heappush(queue, (found, a))
        return [i for i in ids if i >= 0]

    def _learn(self, names: list[int], buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encodes fragments that are new, and keeps them."""
        sizes = ends - starts
        order = np.argsort(sizes, kind="stable")
        order, long = order[sizes[order] <= SHORT], order[sizes[order] > SHORT]
        tokens, counts, kept = [], [], []
        for k in range(0, len(order), SIDE_BY_SIDE):
            part = order[k : k + SIDE_BY_SIDE]
            rows = self._side_by_side(buffer, starts[part], sizes[part])
            tokens.append(rows[rows >= 0])
            counts.append((rows >= 0).sum(axis=1))
            kept.append(part)
        for i in long.tolist():
            tokens.append(np.array(self._queued(buffer[starts[i] : ends[i]].tobytes())))
            counts.append(np.array([len(tokens[-1])]))
            kept.append(np.array([i]))
        slot = len(self.offset) - 1
        which = np.concatenate(kept).tolist()
        self.known.update(zip((names[i] for i in which), range(slot, slot + len(which))))
        self.offset = np.concatenate([self.offset, self.offset[-1] + np.cumsum(np.concatenate(counts))])
        self.tokens = np.concatenate([self.tokens, *tokens]).astype(np.int32)

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the first of each text (with the end)."""
        if not len(texts):
            return np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        joined = "\0".join([*(t or "" for t in texts), ""])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = self.kinds.of(codes)
        ends = np.cumsum([len(t or "") + 1 for t in texts]) - 1  # what parts the texts
        kind[ends] = EDGE
        whole = [(m.start(), m.end(), self.slot_of[m.group()]) for m in self.finder.finditer(joined)] if self.special else []
        for start, end, _ in whole:
            kind[start:end] = EDGE
        cut = pattern_cuts(codes, kind)
        wide = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.cumsum(wide) - wide
        buffer = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        sure = np.ones(len(buffer), dtype=bool)
        sure[1:] = ~self.model.inside[buffer[:-1].astype(np.int64) * 256 + buffer[1:]]
        sure[place[cut]] = True
        for start, end, _ in whole:
            sure[place[start] : place[end]] = False
            sure[place[start]] = True
        starts = np.flatnonzero(sure)
        stops = np.append(starts[1:], len(buffer))
        unique, where, which = np.unique(span_hashes(buffer, starts, stops), return_index=True, return_inverse=True)
        unique = unique.tolist()
        if len(self.tokens) > CACHE:
            self.forget()
        new = np.array([i for i, h in enumerate(unique) if h not in self.known], dtype=np.int64)
        if len(new):
            self._learn([unique[i] for i in new.tolist()], buffer, starts[where[new]], stops[where[new]])
        slots = np.array([self.known[h] for h in unique], dtype=np.int64)[which]
        parting = np.searchsorted(starts, place[ends])
        slots[parting] = 0
        for start, _, slot in whole:
            slots[np.searchsorted(starts, place[start])] = slot
        places, bounds = gathered(self.offset, slots)
        return self.tokens[places], bounds[np.concatenate([[0], parting + 1])]

    def decode(self, tokens: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of the ids ``tokens[bounds[i]:bounds[i + 1]]``; bytes that are no text become U+FFFD."""
        places, ends = gathered(self.model.offset, tokens.astype(np.int64))
        data, cuts = self.model.text[places].tobytes(), ends[bounds].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


_encoders: dict[tuple[str, bool], PairEncoder] = {}


def shared_pair_encoder(digest: str, parts: dict, special: bool = True) -> PairEncoder:
    """The encoder of this worker, which keeps its fragments from task to task; it has one model at a time."""
    if (digest, special) not in _encoders:
        _encoders.clear()
        _encoders[digest, special] = PairEncoder(BytePairs(**parts), special)
    return _encoders[digest, special]


def model_digest(model: BytePairs) -> str:
    arrays = [v.tobytes() for v in model.parts().values() if isinstance(v, np.ndarray)]
    return hashlib.md5(b"".join([*arrays, repr(model.added).encode()])).hexdigest()


def encode_byte_pairs(docs: DataFrame, model: BytePairs) -> DataFrame:
    """``doc_id, token_ids, n_tokens, decoded`` for each row of ``docs`` (doc_id, text; others are not read).

    token_ids are those of the vocabulary's merges; the texts of added tokens are their one id. A text is cut
    where the pattern cuts it, and between two bytes that stand side by side in no token, as no merge can
    reach over such a cut. decoded is what the ids give back. The model (bounded by its file) is broadcast.
    Null and empty texts have no ids, and decode to an empty text; repeated rows are encoded each; an empty
    table gives no rows.
    """
    parts = docs.sparkSession.sparkContext.broadcast(model.parts())
    digest = model_digest(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_pair_encoder(digest, parts.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in chunks(texts, CHUNK):
                tokens, bounds = encoder.encode(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.start, part.stop - part.start),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens, pa.int32())),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(encoder.decode(tokens, bounds), pa.string()),
                    ],
                    names=["doc_id", "token_ids", "n_tokens", "decoded"],
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, token_ids array<int>, n_tokens long, decoded string"
    )
