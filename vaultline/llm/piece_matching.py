"""SentencePiece encoding and decoding: pieces are found in a suffix array of the batch, edges are relaxed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vaultline.llm.spans import chunks, span_hashes

SPACE, MARK = b" ", "▁".encode()  # the model's sign for a space
CHUNK = 500_000  # characters of texts at once
BATCH = 150_000  # bytes of new segments in one suffix array, about; a longer segment makes a larger one
CACHE = 5_000_000  # tokens of segments that a worker remembers
NEVER = np.int64(1) << 40


@dataclass
class Pieces:
    """A byte-pair model as arrays, with a space in place of the model's sign.

    text, size: of each id, for decoding; usable: ids that encoding may give; rank: order of the merges, -1
    for single characters; left, right: what a piece was merged from; pairs, merged: sorted id * count + id
    of two pieces whose join is a piece, and that piece's rank; bytes: ids of the 256 bytes.
    """

    text: np.ndarray
    offset: np.ndarray
    usable: np.ndarray
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray
    bytes: np.ndarray

    @property
    def count(self) -> int:
        return len(self.rank)


def _last_merge(piece: str, scores: dict[str, float]) -> tuple[str, str] | None:
    """The two parts that the last merge joins to ``piece``; None if the merges end elsewhere."""
    parts = list(piece)
    while len(parts) > 1:
        best = max(
            ((scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores), default=None
        )
        if best is None:
            return None
        i = -best[1]
        if len(parts) == 2:
            return parts[0], parts[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return None


def load_pieces(path: str) -> Pieces:
    """Reads a SentencePiece model: byte-pair merges, bytes for unknown characters, no normalising."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        raw = file.read()
    model = proto.ModelProto.FromString(raw)
    plain = model.normalizer_spec.name == "identity" and not model.normalizer_spec.remove_extra_whitespaces
    if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or not plain:
        raise ValueError("only byte-pair models with byte fallback and without normalising are supported")
    if not model.normalizer_spec.add_dummy_prefix:
        raise ValueError("only models that put a space before a text are supported")
    names = sentencepiece.SentencePieceProcessor(model_proto=raw)
    count = len(model.pieces)
    texts, normal = [b""] * count, {}
    byte_ids = np.zeros(256, dtype=np.int64)
    for i, piece in enumerate(model.pieces):
        if names.is_byte(i):
            byte_ids[int(piece.piece[3:5], 16)] = i
            texts[i] = bytes([int(piece.piece[3:5], 16)])
        elif names.is_unknown(i):
            texts[i] = model.trainer_spec.unk_surface.encode()
        elif not names.is_control(i):
            name = piece.piece.replace(MARK.decode(), " ")
            texts[i] = name.encode()
            normal[name] = i
    scores = {name: model.pieces[i].score for name, i in normal.items()}
    rank, left, right = np.full(count, -1), np.arange(count), np.arange(count)
    ranks = {name: r for r, name in enumerate(sorted(scores, key=lambda n: (-scores[n], normal[n])))}
    usable, pairs = [], []
    for name, i in normal.items():
        last = _last_merge(name, scores) if len(name) > 1 else None
        if len(name) > 1:
            if last is None:
                continue
            rank[i], left[i], right[i] = ranks[name], normal[last[0]], normal[last[1]]
        usable.append(i)
    ids = set(usable)
    for name, i in normal.items():
        for cut in range(1, len(name)):
            a, b = normal.get(name[:cut]), normal.get(name[cut:])
            if a in ids and b in ids:
                pairs.append((a * count + b, ranks[name]))
    if any(" " in name.lstrip(" ") for name in normal):
        raise ValueError("a piece goes on after a space; texts can't be cut into segments")
    table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
    offset = np.cumsum([0, *(len(t) for t in texts)])
    return Pieces(
        np.frombuffer(b"".join(texts), dtype=np.uint8), offset, np.array(sorted(usable)), rank, left, right,
        table[:, 0], table[:, 1], byte_ids,
    )


def _fit(pieces: Pieces, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether merging the text of two pieces gives these two again.

    Takes the later merge of both apart, again and again, and looks whether the parts at the seam would
    have been merged before it. An id of ``count`` is an unknown character, which merges with nothing.
    """
    fits = np.ones(len(one), dtype=bool)
    active = np.flatnonzero((one < pieces.count) & (two < pieces.count))
    a, b, limit = one[active], two[active], np.full(len(active), NEVER)
    while len(active):
        key = a * pieces.count + b
        at = np.minimum(np.searchsorted(pieces.pairs, key), len(pieces.pairs) - 1)
        clash = (pieces.pairs[at] == key) & (pieces.merged[at] < limit)
        fits[active[clash]] = False
        go = ~clash
        active, a, b = active[go], a[go], b[go]
        rank_a, rank_b = pieces.rank[a], pieces.rank[b]
        later = rank_a > rank_b  # a was merged after b; equal only for two characters or the same piece
        limit = np.where(later, rank_a, rank_b + 1)
        end = (rank_a < 0) & (rank_b < 0)
        a, b = np.where(later, pieces.right[a], a), np.where(later, b, pieces.left[b])
        go = ~end
        active, a, b, limit = active[go], a[go], b[go], limit[go]
    return fits


def _ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each key among all, from 1; equal keys have equal ranks."""
    keys = keys[order]
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = 1 + np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])])[: len(keys)]
    return out


def _occurrences(pieces: Pieces, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and id of every piece in ``text``: a range of the suffix array for each, by binary search."""
    sizes = np.diff(pieces.offset)[pieces.usable]
    words = -(-int(sizes.max()) // 8)
    padded = np.concatenate([text, np.zeros(8 * words + 8, dtype=np.uint8)]).astype(np.uint64)
    key = np.zeros(len(text) + 8 * words, dtype=np.uint64)
    for b in range(8):
        key |= padded[b : b + len(key)] << np.uint64(56 - 8 * b)
    columns = [key[8 * w : 8 * w + len(text)] for w in range(words)]
    suffixes, width = np.argsort(key[: len(text)]), 1
    rank = _ranks(columns[0], suffixes)
    while width < words:  # places in order of twice as many bytes, until no piece is longer
        behind = np.append(rank[8 * width :], np.zeros(min(8 * width, len(rank)), dtype=np.int64))
        both = rank * (len(rank) + 1) + behind
        suffixes, width = np.argsort(both), 2 * width
        rank = _ranks(both, suffixes)
    heads = np.stack([c[suffixes] for c in columns], axis=1).astype(">u8").view(f"S{8 * words}").ravel()
    names = [pieces.text[pieces.offset[i] : pieces.offset[i + 1]].tobytes() for i in pieces.usable]
    low = np.searchsorted(heads, np.array(names, dtype=f"S{8 * words}"), side="left")
    high = np.searchsorted(heads, np.array([n.ljust(8 * words, b"\xff") for n in names]), side="right")
    counts = high - low
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    return suffixes[place].astype(np.int32), np.repeat(pieces.usable, counts).astype(np.int32)


def encode_segments(pieces: Pieces, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all segments one after the other, and the first of each (with the end)."""
    sizes = ends - starts
    own = np.cumsum(sizes + 1) - sizes - 1  # of each segment in the joined text; a zero byte ends it
    joined = np.zeros(int((sizes + 1).sum()), dtype=np.uint8)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    joined[np.repeat(own, sizes) + within] = text[np.repeat(starts, sizes) + within]
    base = np.repeat(own, sizes + 1)
    limit = np.repeat(own + sizes, sizes + 1)

    start, piece = _occurrences(pieces, joined)
    length = np.diff(pieces.offset).astype(np.int32)[piece]
    # Characters that are no piece: an edge of their own, with the id after the last.
    lead = ((joined & 0xC0) != 0x80) & (np.arange(len(joined)) < limit)
    heads = np.flatnonzero(lead)
    widths = np.diff(np.append(heads, len(joined)))
    widths = np.minimum(widths, limit[heads] - heads)
    character = np.full(len(joined), 0)
    character[heads] = widths
    single = np.zeros(len(joined), dtype=bool)
    single[start[length == character[start]]] = True
    strange = heads[~single[heads]]
    start = np.concatenate([start, strange.astype(np.int32)])
    piece = np.concatenate([piece, np.full(len(strange), pieces.count, dtype=np.int32)])
    length = np.concatenate([length, character[strange].astype(np.int32)])

    end = start + length
    longest = int(length.max()) + 1
    order = np.argsort(((end - base[start]) * (len(joined) + 1) + end) * longest + longest - 1 - length)
    start, piece, end = start[order], piece[order], end[order]
    reach = end - base[start]
    best = np.full(len(joined) + 1, -1)
    origin = np.zeros(len(joined) + 1, dtype=np.int64)
    bounds = np.flatnonzero(np.diff(reach, prepend=-1))
    for low, high in zip(bounds, np.append(bounds[1:], len(reach))):
        targets = end[low:high]
        at = low + np.flatnonzero(np.diff(targets, prepend=-1))
        stop = np.append(at[1:], high)
        while len(at):
            before = best[start[at]]
            first = start[at] == base[start[at]]
            good = first | (before >= 0)
            ask = np.flatnonzero(good & ~first)
            good[ask] = _fit(pieces, before[ask], piece[at[ask]].astype(np.int64))
            done = at[good]
            best[end[done]], origin[end[done]] = piece[done], start[done]
            more = ~good & (at + 1 < stop)
            at, stop = at[more] + 1, stop[more]

    # Back from the end of every segment, all in step; an unknown character gives its bytes.
    where, found, steps = own + sizes, [], 0
    which = np.flatnonzero(where > own)
    while len(which):
        token, back = best[where[which]], origin[where[which]]
        if (token < 0).any():
            raise ValueError("a segment can't be encoded")
        odd = token == pieces.count
        found.append((which[~odd], np.full((~odd).sum(), steps), token[~odd]))
        for k in range(4):  # the bytes of a character, the last first
            byte_at = where[which[odd]] - 1 - k
            real = byte_at >= back[odd]
            found.append((which[odd][real], np.full(real.sum(), steps + k), pieces.bytes[joined[byte_at[real]]]))
        where[which] = back
        steps += 4
        which = which[back > own[which]]
    if not found:
        return np.zeros(0, dtype=np.int32), np.zeros(len(starts) + 1, dtype=np.int64)
    segment, step, token = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-step, segment))
    return token[order].astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(segment, minlength=len(starts)))])


def _gather(offset: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the items of all ``which`` rows of a ragged array, and the bounds of each row."""
    sizes = offset[which + 1] - offset[which]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(bounds[-1]) + np.repeat(offset[which] - bounds[:-1], sizes), bounds


class Encoder:
    """Encodes batches of texts; segments seen before come from memory.

    known, slot: sorted hashes of these segments, and where in ``tokens`` each lies: arrays, as a dict takes
    ten times the memory of a worker.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.known, self.slot = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
        self.tokens, self.offset = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int32)

    def _remember(self, hashes: np.ndarray, tokens: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Takes in new segments: sorted hashes, and in their order the ids and how many of them each has."""
        at = np.searchsorted(self.known, hashes)
        slots = np.arange(len(self.slot), len(self.slot) + len(hashes), dtype=np.int32)
        self.known, self.slot = np.insert(self.known, at, hashes), np.insert(self.slot, at, slots)
        ends = self.offset[-1] + np.cumsum(np.concatenate(sizes))
        self.offset = np.concatenate([self.offset, ends.astype(np.int32)])
        self.tokens = np.concatenate([self.tokens, *tokens])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        raw = [(SPACE + t.encode("utf-8", "replace").replace(MARK, SPACE)) if t else b"" for t in texts]
        text = np.frombuffer(b"".join(raw), dtype=np.uint8)
        offsets = np.cumsum([0, *(len(r) for r in raw)])
        space = text == SPACE[0]
        # No piece goes on after a space, so what follows a space is encoded by itself.
        cut = space & ~np.concatenate([[False], space[:-1]]) if len(text) else space
        if len(text):
            cut[offsets[:-1][offsets[:-1] < len(text)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(text)) if len(starts) else starts
        unique, where, which = np.unique(span_hashes(text, starts, ends), return_index=True, return_inverse=True)
        if len(self.tokens) > CACHE:
            self.forget()
        at = np.searchsorted(self.known, unique)
        found = self.known.take(at, mode="clip") == unique if len(self.known) else np.zeros(len(unique), dtype=bool)
        new = np.flatnonzero(~found)
        sizes = np.cumsum((ends - starts)[where[new]])
        parts = np.split(new, np.flatnonzero(np.diff(sizes // BATCH)) + 1) if len(new) else ()
        coded = [encode_segments(self.pieces, text, starts[where[part]], ends[where[part]]) for part in parts]
        if coded:
            self._remember(unique[new], [tokens for tokens, _ in coded], [np.diff(bounds) for _, bounds in coded])
        slots = self.slot[np.searchsorted(self.known, unique)][which]
        places, bounds = _gather(self.offset, slots)
        return self.tokens[places], bounds[np.searchsorted(starts, offsets)]

    def decode(self, tokens: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of the ids ``tokens[bounds[i]:bounds[i + 1]]``, without the space put before each."""
        places, ends = _gather(self.pieces.offset, tokens.astype(np.int64))
        data, cuts = self.pieces.text[places].tobytes(), ends[bounds].tolist()
        raw = (data[a:b] for a, b in zip(cuts, cuts[1:]))
        return [(r[1:] if r[:1] == SPACE else r).decode("utf-8", "replace") for r in raw]


_encoders: dict[str, Encoder] = {}


def shared_encoder(digest: str, pieces: dict) -> Encoder:
    """The encoder of this worker, which keeps its segments from task to task; it has one model at a time."""
    if digest not in _encoders:
        _encoders.clear()
        _encoders[digest] = Encoder(Pieces(**pieces))
    return _encoders[digest]


def encode_documents(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """``doc_id, token_ids, n_tokens, decoded`` for each row of ``docs`` (doc_id, text; others are not read).

    token_ids are those of the model's own merges. decoded is the text that they give back: the whole text
    with the model's space sign, U+2581, as a space. The model (bounded by its file) is broadcast. Null and
    empty texts have no ids, and decode to an empty text; repeated rows are encoded each; an empty table
    gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(vars(pieces))
    digest = hashlib.md5(b"".join(array.tobytes() for array in vars(pieces).values())).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(digest, model.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in chunks(texts, CHUNK):
                tokens, bounds = encoder.encode(texts[part])
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.start, part.stop - part.start),
                        ids,
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(encoder.decode(tokens, bounds), pa.string()),
                    ],
                    names=["doc_id", "token_ids", "n_tokens", "decoded"],
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, token_ids array<int>, n_tokens long, decoded string"
    )
