"""Cross-tokenizer alignment: fragments of byte ranges compose, so texts of any length are aligned in parts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vaultline.llm.byte_pairs import BytePairs, gathered, model_digest, shared_pair_encoder
from vaultline.llm.spans import chunks
from vaultline.llm.tables import batches_of, written

CHUNK = 250_000  # characters of texts at once
RANGE = 1 << 16  # bytes of a part of a long text; shorter texts are aligned as a whole
FAN = 16  # neighbouring fragments that one step composes
BLOCK, BLOCK_KINDS = 32_000_000, 1_000_000  # a block of documents ends beyond so many links (a document's kinds), or kinds
SPACE, MARK = b" ", "▁"
KIND = np.int64(1) << 32  # a link's kind is A id * KIND + B id

COMMA, BAR, SEMICOLON = b",|;"


# --- the two tokenizers: ids of spaced texts, and the bytes of each id -------------------------------------


@dataclass
class Side:
    """Encodes texts that begin with a space; ``text, offset``: the bytes of all ids."""

    encode: Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]]
    text: np.ndarray
    offset: np.ndarray

    def tokens(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their sizes in bytes, the first id of each text (with the end), all bytes."""
        ids, bounds = self.encode(texts)
        places, _ = gathered(self.offset, ids.astype(np.int64))
        return ids.astype(np.int64), (self.offset[1:] - self.offset[:-1])[ids], bounds, self.text[places]


def byte_side(model: dict, digest: str) -> Side:
    encoder = shared_pair_encoder(digest, model, special=False)
    return Side(encoder.encode, encoder.model.text, encoder.model.offset)


def read_piece_model(path: str) -> bytes:
    """A SentencePiece model that leaves texts as they are, puts a space before each, and has no piece that goes on
    after a space; others are refused, as their texts can't be dealt out in ranges."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        raw = file.read()
    model = proto.ModelProto.FromString(raw)
    rules = model.normalizer_spec
    if rules.name != "identity" or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
        raise ValueError("only models without normalising that put a space before a text are supported")
    if any(MARK in piece.piece.lstrip(MARK) for piece in model.pieces):
        raise ValueError("a piece goes on after a space; texts can't be cut there")
    return raw


_processors: dict[bytes, Side] = {}


def piece_side(model: bytes) -> Side:
    if model not in _processors:
        import sentencepiece

        names = sentencepiece.SentencePieceProcessor(model_proto=model)

        def raw(i: int) -> bytes:
            if names.is_byte(i):
                return bytes([int(names.id_to_piece(i)[3:5], 16)])
            return b"" if names.is_control(i) or names.is_unknown(i) else names.id_to_piece(i).replace(MARK, " ").encode()

        pieces = [raw(i) for i in range(names.get_piece_size())]
        space = names.piece_to_id(MARK)

        def encode(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
            """The model puts a space before a text by itself, but not before none."""
            lists = [names.encode(text[1:]) if len(text) > 1 else [space] * len(text) for text in texts]
            bounds = np.cumsum([0, *map(len, lists)])
            return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=bounds[-1]), bounds

        _processors.clear()
        _processors[model] = Side(encode, np.frombuffer(b"".join(pieces), dtype=np.uint8), np.cumsum([0, *map(len, pieces)]))
    return _processors[model]


# --- aligning tokens that begin at the same byte ------------------------------------------------------------


@lru_cache(maxsize=1)
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of the numbers below ``size``, a row each, and how many they are."""
    written = [b"%d" % i for i in range(size)]
    digits = np.array([len(w) for w in written], dtype=np.int64)
    return np.array(written, dtype=f"S{digits[-1] + 1}").view(np.uint8).reshape(size, -1), digits


def written_ids(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id in decimal with a mark behind, as bytes one after the other, and where each begins (with the end)."""
    table, digits = _decimals(1 << max(16, int(ids.max(initial=0)).bit_length()))
    rows, digits = table[ids], digits[ids]
    rows[np.arange(len(ids)), digits] = marks
    return rows[np.arange(rows.shape[1]) <= digits[:, None]], np.concatenate([[0], np.cumsum(digits + 1)])


@dataclass
class Aligned:
    """Groups of many texts: ``text`` holds them written out, each group ending with a semicolon; the kinds
    of all links; how many groups and links each text has, and where its part of ``text`` ends."""

    text: bytes
    text_bounds: np.ndarray
    kinds: np.ndarray
    link_bounds: np.ndarray
    n_groups: np.ndarray


def align(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray, text_ends: np.ndarray) -> Aligned:
    """Aligns tokens that cover the same bytes; a text ends where both have an end, at ``text_ends``.

    Every end of a token begins a new overlap, so the links are the stretches between neighbouring ends of
    either side, and groups end where ends of both sides meet.
    """
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    both = np.concatenate([a_ends, b_ends])
    both.sort(kind="stable")  # two sorted runs
    twice = np.zeros(len(both), dtype=bool)
    twice[1:] = both[1:] == both[:-1]
    ends = both[~twice]
    common = both[twice]
    in_a, in_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    kinds = a[in_a] * KIND + b[in_b] if len(ends) else np.zeros(0, dtype=np.int64)

    # Written out: of each group the A ids, then the B ids; a mark behind each tells what follows.
    a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    a_last = np.append(a_group[1:] != a_group[:-1], True)[: len(a)]
    b_last = np.append(b_group[1:] != b_group[:-1], True)[: len(b)]
    place = np.empty(len(a) + len(b), dtype=np.int64)
    a_counts, b_counts = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))
    place[: len(a)] = np.arange(len(a)) + (np.cumsum(b_counts) - b_counts)[a_group]
    place[len(a) :] = np.arange(len(b)) + np.cumsum(a_counts)[b_group]
    ids, marks = np.empty(len(place), dtype=np.int64), np.empty(len(place), dtype=np.uint8)
    ids[place] = np.concatenate([a, b])
    marks[place] = np.concatenate([np.where(a_last, BAR, COMMA), np.where(b_last, SEMICOLON, COMMA)])
    text, at = written_ids(ids, marks)
    first_group = np.concatenate([[0], np.searchsorted(common, text_ends, side="right")])
    first_token = np.concatenate([[0], np.cumsum(a_counts + b_counts)])[first_group]
    links = np.concatenate([[0], np.searchsorted(ends, text_ends, side="right")])
    return Aligned(text.tobytes(), at[first_token], kinds, links, np.diff(first_group))


def counted(kinds: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each kind once, and how often it is there."""
    unique, which = np.unique(kinds, return_inverse=True)
    return unique, np.bincount(which, counts, minlength=len(unique)).astype(np.int64)


# --- the monoid -------------------------------------------------------------------------------------------


@dataclass
class Run:
    """Tokens of both sides that are not cut into groups yet."""

    a: np.ndarray
    a_sizes: np.ndarray
    b: np.ndarray
    b_sizes: np.ndarray

    def then(self, other: Run) -> Run:
        return Run(*(np.concatenate([getattr(self, k), getattr(other, k)]) for k in RUN))


RUN = ("a", "a_sizes", "b", "b_sizes")
NOTHING = np.zeros(0, dtype=np.int64)


@dataclass
class Fragment:
    """What a range of bytes knows of a text's alignment.

    It has the tokens of both sides that begin in the range. ``prefix``: those up to the first place where
    both sides have an end (all, if ``cut`` is False, as there is none). groups, n_groups, kinds, counts: what
    lies between that place and the last one of this sort, closed. ``suffix``: the tokens behind it.
    ``whole``: whether the tokens' bytes are those of the text.
    """

    prefix: Run
    suffix: Run
    cut: bool
    groups: str = ""
    n_groups: int = 0
    kinds: np.ndarray = field(default_factory=lambda: NOTHING)
    counts: np.ndarray = field(default_factory=lambda: NOTHING)
    n_a: int = 0
    n_b: int = 0
    whole: bool = True

    def closed(self, run: Run, before: bool) -> Fragment:
        """With the groups of a run that lies just before or just behind the closed ones."""
        if not len(run.a):
            return self
        found = align(run.a, run.a_sizes, run.b, run.b_sizes, np.array([run.a_sizes.sum()]))
        text = found.text.decode()
        kinds, counts = counted(
            np.concatenate([self.kinds, found.kinds]), np.concatenate([self.counts, np.ones(len(found.kinds))])
        )
        groups = text + self.groups if before else self.groups + text
        return Fragment(
            self.prefix, self.suffix, self.cut, groups, self.n_groups + int(found.n_groups[0]), kinds, counts,
            self.n_a, self.n_b, self.whole,
        )

    def then(self, other: Fragment) -> Fragment:
        """This range and the next as one. Associative: what is open stays so until both its ends are known."""
        if not (self.whole and other.whole):
            return BROKEN
        if not self.cut and not other.cut:
            made = Fragment(self.prefix.then(other.prefix), EMPTY, False)
        elif not self.cut:
            made = Fragment(
                self.prefix.then(other.prefix), other.suffix, True, other.groups, other.n_groups, other.kinds, other.counts
            )
        elif not other.cut:
            made = Fragment(
                self.prefix, self.suffix.then(other.prefix), True, self.groups, self.n_groups, self.kinds, self.counts
            )
        else:
            middle = self.closed(self.suffix.then(other.prefix), before=False)
            kinds, counts = counted(
                np.concatenate([middle.kinds, other.kinds]), np.concatenate([middle.counts, other.counts])
            )
            made = Fragment(
                self.prefix, other.suffix, True, middle.groups + other.groups, middle.n_groups + other.n_groups, kinds, counts
            )
        made.n_a, made.n_b = self.n_a + other.n_a, self.n_b + other.n_b
        return made

    def finished(self) -> Fragment:
        """The fragment of a whole text: both of its ends are places where both sides have an end."""
        return self.closed(self.prefix, before=True).closed(self.suffix, before=False)

    def row(self) -> dict:
        runs = {f"{name}_{k}": getattr(getattr(self, name), k) for name in ("prefix", "suffix") for k in RUN}
        return runs | {
            "cut": self.cut, "groups": self.groups, "n_groups": self.n_groups, "kinds": self.kinds,
            "counts": self.counts, "n_a": self.n_a, "n_b": self.n_b, "whole": self.whole,
        }

    @staticmethod
    def of(row) -> Fragment:
        prefix, suffix = (
            Run(*(np.asarray(getattr(row, f"{name}_{k}"), dtype=np.int64) for k in RUN)) for name in ("prefix", "suffix")
        )
        kinds, counts = np.asarray(row.kinds, dtype=np.int64), np.asarray(row.counts, dtype=np.int64)
        return Fragment(
            prefix, suffix, row.cut, row.groups, row.n_groups, kinds, counts, row.n_a, row.n_b, row.whole
        )


EMPTY = Run(NOTHING, NOTHING, NOTHING, NOTHING)
BROKEN = Fragment(EMPTY, EMPTY, False, whole=False)  # of a text whose tokens do not give it back

FRAGMENT = (
    ", ".join(f"{name}_{k} array<long>" for name in ("prefix", "suffix") for k in RUN)
    + ", cut boolean, groups string, n_groups long, kinds array<long>, counts array<long>, n_a long, n_b long, whole boolean"
)


def sure_cuts(text: str) -> np.ndarray:
    """Characters before which both tokenizers surely cut, whatever lies beyond: blanks behind anything but white space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    blanks = np.flatnonzero(codes == 0x20).tolist()
    sure = [i for i in blanks if i and not text[i - 1].isspace() and text[i - 1] != MARK]
    return np.array(sure, dtype=np.int64)


@dataclass
class Range:
    """Bytes ``low`` to ``high`` of ``text``, which begins and ends at sure cuts of the whole text."""

    text: str
    low: int
    high: int


def ranges(text: str, size: int = RANGE) -> list[Range]:
    """Ranges of about ``size`` bytes that cover a text, each with the text around it up to the next sure cuts.

    Where no sure cut comes for long, a range reaches to the next one.
    """
    cuts = sure_cuts(text)
    encoded = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    lead = np.flatnonzero((encoded & 0xC0) != 0x80)  # byte at which each character begins
    ends = np.concatenate([[0], lead[cuts], [len(encoded)]])
    characters = np.concatenate([[0], cuts, [len(text)]])
    found, low = [], 0
    while low < len(encoded):
        high = low + size
        if np.searchsorted(ends, high, side="right") == np.searchsorted(ends, low, side="right"):
            high = int(ends[np.searchsorted(ends, high)])
        high = min(high, len(encoded))
        first, last = np.searchsorted(ends, low, side="right") - 1, np.searchsorted(ends, high)
        part = text[characters[first] : characters[last]]
        found.append(Range(part, low - int(ends[first]), high - int(ends[first])))
        low = high
    return found


def fragment(part: Range, a_side: Side, b_side: Side) -> Fragment:
    """Of the tokens that begin in a range, in the order of their places."""
    data = np.frombuffer(part.text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    runs, ends, whole = [], [], True
    for side in (a_side, b_side):
        ids, sizes, _, raw = side.tokens([part.text])
        whole = whole and len(raw) == len(data) and bool((raw == data).all())
        stops = np.cumsum(sizes)
        mine = (stops - sizes >= part.low) & (stops - sizes < part.high)
        runs += [ids[mine], sizes[mine]]
        ends.append(stops[mine])
    if not whole:
        return BROKEN
    common = np.intersect1d(ends[0], ends[1], assume_unique=True)
    cut = len(common) > 0
    low, high = (common[0], common[-1]) if cut else (0, 0)
    pieces = []
    for inside in (lambda e: e <= low, lambda e: (e > low) & (e <= high), lambda e: e > high):
        pieces.append([column[inside(ends[k // 2])] for k, column in enumerate(runs)])
    counts = {"n_a": len(runs[0]), "n_b": len(runs[2])}
    if not cut:
        return Fragment(Run(*runs), EMPTY, False, **counts)
    return Fragment(Run(*pieces[0]), Run(*pieces[2]), True, **counts).closed(Run(*pieces[1]), before=False)


# --- over tables --------------------------------------------------------------------------------------------

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, kinds array<long>, counts array<long>"


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _whole_texts(texts: list[str | None], a_side: Side, b_side: Side) -> dict[str, pa.Array]:
    """Columns of ALIGNED but doc_id, for texts that are aligned side by side."""
    spaced = [" " + t if t else "" for t in texts]
    while True:
        a, a_sizes, a_bounds, a_raw = a_side.tokens(spaced)
        b, b_sizes, b_bounds, b_raw = b_side.tokens(spaced)
        raw = [t.encode("utf-8", "surrogatepass") for t in spaced]
        ends = np.cumsum([0, *map(len, raw)])
        a_at = np.concatenate([[0], np.cumsum(a_sizes)])[a_bounds]
        b_at = np.concatenate([[0], np.cumsum(b_sizes)])[b_bounds]
        joined = b"".join(raw)
        a_raw, b_raw = a_raw.tobytes(), b_raw.tobytes()
        if a_raw == joined and b_raw == joined:
            break
        for i, text in enumerate(raw):  # those that do not come back whole have no tokens
            if a_raw[a_at[i] : a_at[i + 1]] != text or b_raw[b_at[i] : b_at[i + 1]] != text:
                spaced[i] = ""
    found = align(a, a_sizes, b, b_sizes, ends[1:])
    bounds = found.text_bounds.tolist()
    groups = [found.text[x : max(x, y - 1)].decode() for x, y in zip(bounds, bounds[1:])]
    n_links = np.diff(found.link_bounds)
    # Kinds of each text once: sorted by text and kind.
    owner = np.repeat(np.arange(len(texts)), n_links)
    order = np.lexsort((found.kinds, owner))
    kinds, owner = found.kinds[order], owner[order]
    new = np.ones(len(kinds), dtype=bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    own = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(texts)))])
    return {
        "n_a": pa.array(np.diff(a_bounds), pa.int64()),
        "n_b": pa.array(np.diff(b_bounds), pa.int64()),
        "n_groups": pa.array(found.n_groups, pa.int64()),
        "n_links": pa.array(n_links, pa.int64()),
        "groups": pa.array(groups, pa.string()),
        "kinds": _lists(kinds[first], own, pa.int64()),
        "counts": _lists(np.diff(np.append(first, len(kinds))), own, pa.int64()),
    }


def align_documents(docs: DataFrame, a_model: BytePairs, b_model: bytes, size: int = RANGE) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, kinds, counts`` for each row of ``docs`` (doc_id, text).

    Space and text are encoded by a byte-level vocabulary (A, without added tokens) and a SentencePiece model
    (B). Where tokens of both end at the same byte a group ends; ``groups`` writes them out as
    ``a1,a2|b1;a3|b2,b3``. A link is an A and a B token with a byte in common; kinds, counts: the pairs of ids
    (A id * 2^32 + B id, sorted) that are linked, and how often.

    Texts of up to ``size`` characters are aligned as a whole. A longer one is dealt out in ranges of so many
    bytes to tasks of their own; each makes a fragment with an open prefix, closed groups and an open suffix,
    and neighbours compose in a tree. Both models (bounded by their files) are broadcast. Texts that are null
    or empty, or do not come back whole from either's tokens, have no tokens; repeated rows are aligned each;
    an empty table gives no rows.
    """
    context = docs.sparkSession.sparkContext
    parts, piece_model, digest = context.broadcast(a_model.parts()), context.broadcast(b_model), model_digest(a_model)

    def sides() -> tuple[Side, Side]:
        return byte_side(parts.value, digest), piece_side(piece_model.value)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in chunks(texts, CHUNK):
                columns = _whole_texts(texts[part], *both)
                ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_pydict({"doc_id": ids} | columns)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, doc, text in zip(*(batch.column(c).to_pylist() for c in ("number", "doc_id", "text"))):
                for k, part in enumerate(ranges(" " + text, size)):
                    row = {"number": number, "doc_id": doc, "part": k, "text": part.text, "low": part.low, "high": part.high}
                    yield pa.RecordBatch.from_pylist([row], schema=DEALT_ARROW)

    def fragments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = sides()
        for frame in frames:
            for row in frame.itertuples():
                found = fragment(Range(row.text, row.low, row.high), *both)
                yield pd.DataFrame([{"number": row.number, "doc_id": row.doc_id, "part": row.part} | found.row()])

    def composed(frame: pd.DataFrame) -> pd.DataFrame:
        rows = list(frame.sort_values("part").itertuples())
        total = Fragment.of(rows[0])
        for row in rows[1:]:
            total = total.then(Fragment.of(row))
        head = {"number": rows[0].number, "doc_id": rows[0].doc_id, "part": rows[0].part // FAN}
        return pd.DataFrame([head | total.row()])

    def closed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                total = Fragment.of(row)
                done = total.finished() if total.whole else None
                yield pd.DataFrame(
                    [
                        {
                            "doc_id": row.doc_id,
                            "n_a": done.n_a if done else 0,
                            "n_b": done.n_b if done else 0,
                            "n_groups": done.n_groups if done else 0,
                            "n_links": int(done.counts.sum()) if done else 0,
                            "groups": done.groups.rstrip(";") if done else "",
                            "kinds": done.kinds if done else [],
                            "counts": done.counts if done else [],
                        }
                    ]
                )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    short = F.coalesce(F.length("text"), F.lit(0)) <= size
    aligned = rows.where(short).mapInArrow(whole, ALIGNED)
    dealt_schema = "number long, doc_id long, part int, text string, low long, high long"
    long = rows.where(~short).withColumn("number", F.monotonically_increasing_id())  # tells repeated rows apart
    pieces = written(long.mapInArrow(dealt, dealt_schema), "alignment-ranges")
    last = pieces.agg(F.max("part")).first()[0]
    if last is None:
        return aligned
    schema = f"number long, doc_id long, part int, {FRAGMENT}"
    made = pieces.repartition("number", "part").mapInPandas(fragments, schema)
    while last:
        made = made.groupBy("number", F.expr(f"part div {FAN}")).applyInPandas(composed, schema)
        last //= FAN
    return aligned.unionByName(made.mapInPandas(closed, ALIGNED))


DEALT_ARROW = pa.schema(
    [("number", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("low", pa.int64()), ("high", pa.int64())]
)


# --- counts over the whole corpus ---------------------------------------------------------------------------


def packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers in seven bits a byte, the lowest first, and the place of each (with the end)."""
    sizes = np.ones(len(numbers), dtype=np.int64)
    for k in range(1, 10):
        sizes += numbers >= (1 << (7 * k) if k < 9 else np.iinfo(np.int64).max)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(bounds[-1], dtype=np.uint8)
    for k in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > k)
        out[bounds[has] + k] = (numbers[has] >> (7 * k)) & 0x7F | np.where(sizes[has] > k + 1, 0x80, 0)
    return out, bounds


def unpacked(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 0x80)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    parts = (data & 0x7F).astype(np.int64) << (7 * place)
    return np.add.reduceat(parts, first) if len(last) else np.zeros(0, dtype=np.int64)


class _Numbered:
    """Numbers the kinds of links of a block of documents as they come; frequent ones come early, so their numbers
    are short to write. A document's links are ``packed``: how many kinds, the gaps between their rising numbers
    (doubled; odd where the kind is there more than once), then the counts above one."""

    def __init__(self) -> None:
        self.kinds, self.numbers = NOTHING, NOTHING  # by kind
        self.totals = NOTHING  # by number
        self.size = 0

    def add(self, kinds: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The packed links of the documents ``kinds[bounds[i]:bounds[i + 1]]``."""
        unique, which = np.unique(kinds, return_inverse=True)
        at = np.searchsorted(self.kinds, unique)
        known = np.zeros(len(unique), dtype=bool)
        inner = at < len(self.kinds)
        known[inner] = self.kinds[at[inner]] == unique[inner]
        numbers = np.empty(len(unique), dtype=np.int64)
        numbers[known] = self.numbers[at[known]]
        sums = np.bincount(which, counts, minlength=len(unique)).astype(np.int64)
        new = np.flatnonzero(~known)
        new = new[np.argsort(-sums[new], kind="stable")]
        numbers[new] = np.arange(len(self.totals), len(self.totals) + len(new))
        self.kinds = np.insert(self.kinds, at[~known], unique[~known])
        self.numbers = np.insert(self.numbers, at[~known], numbers[~known])
        self.totals = np.concatenate([self.totals, np.zeros(len(new), dtype=np.int64)])
        self.totals[numbers] += sums
        self.size += len(kinds)
        return self._packed(numbers[which], counts, bounds)

    @staticmethod
    def _packed(numbers: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> pa.Array:
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((numbers, owner))
        numbers, counts = numbers[order], counts[order]
        gaps = np.diff(numbers, prepend=0)
        first = bounds[:-1][sizes > 0]
        gaps[first] = numbers[first]
        more = counts > 1
        extra = np.concatenate([[0], np.cumsum(more)])
        start = bounds[:-1] + extra[bounds[:-1]] + np.arange(len(sizes))  # a document's first value
        values = np.empty(len(sizes) + len(gaps) + int(more.sum()), dtype=np.int64)
        values[start] = sizes
        values[start[owner] + 1 + np.arange(len(gaps)) - bounds[owner]] = gaps * 2 + more
        whose = owner[more]
        values[start[whose] + 1 + sizes[whose] + np.arange(len(whose)) - extra[bounds[whose]]] = counts[more]
        data, places = packed(values)
        cuts = places[np.append(start, len(values))].astype(np.int32)
        return pa.Array.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data.tobytes())]
        )


def links_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a document's kinds of links, and their counts."""
    values = unpacked(np.frombuffer(data, dtype=np.uint8))
    size = int(values[0])
    gaps, counts = values[1 : 1 + size], np.ones(size, dtype=np.int64)
    counts[(gaps & 1).astype(bool)] = values[1 + size :]
    return np.cumsum(gaps >> 1), counts


def score_links(aligned: DataFrame) -> DataFrame:
    """The rows of ``aligned`` with ``n_best, count_sum`` instead of ``kinds, counts``.

    The count of a link's kind is how many links of all documents are of this kind. count_sum adds these up
    over a document's links; n_best counts those whose kind is the highest of its B id (ties included).

    Documents are taken in blocks. Only a block's kinds, with their sums, are shuffled to be counted; what
    they come to returns to the block, where its documents meet it.
    """
    keys = [f for f in aligned.schema.fields if f.name not in ("kinds", "counts")]
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, _Numbered()

        def ended() -> pa.RecordBatch:
            none = {f.name: pa.nulls(1, to_arrow_type(f.dataType)) for f in keys}
            by_number = np.empty(len(held.kinds), dtype=np.int64)
            by_number[held.numbers] = held.kinds
            return pa.RecordBatch.from_pydict(
                {"block": [block]} | none
                | {"links": pa.nulls(1, pa.binary()), "kinds": [by_number], "totals": [held.totals]}
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if held.size > BLOCK or len(held.kinds) > BLOCK_KINDS:
                yield ended()
                block, held = block + 1, _Numbered()
            kinds, counts = batch.column("kinds"), batch.column("counts")
            bounds = np.concatenate([[0], np.cumsum(kinds.value_lengths().to_numpy())])
            links = held.add(kinds.flatten().to_numpy(), counts.flatten().to_numpy(), bounds)
            none = pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(
                {"block": np.full(batch.num_rows, block)} | {f.name: batch.column(f.name) for f in keys}
                | {"links": links, "kinds": none, "totals": none}
            )
        if held.size:
            yield ended()

    schema = f"block long, {head}, links binary, kinds array<long>, totals array<long>"
    with batches_of(aligned.sparkSession):  # texts are long
        staged = written(aligned.mapInArrow(blocks, schema), "alignment-blocks")
    found = staged.where("kinds is not null").selectExpr("block", "posexplode(arrays_zip(kinds, totals)) as (number, entry)")
    found = found.selectExpr("block", "number", "entry.kinds as kind", "entry.totals as total")
    corpus = found.groupBy("kind").agg(F.sum("total").alias("count"))
    # At most one row for each A id has the same B id.
    corpus = corpus.withColumn("best", F.expr(f"count = max(count) over (partition by kind % {KIND})"))
    scores = found.select(F.col("block").alias("of_block"), "number", "kind").join(corpus, "kind")
    scores = scores.select("of_block", "number", "count", "best")

    def scored(documents: pa.Table, counts: pa.Table) -> pa.Table:
        documents, counts = documents.combine_chunks(), counts.combine_chunks()
        order = np.argsort(counts["number"].to_numpy())
        count = counts["count"].to_numpy()[order]
        best = counts["best"].to_numpy(zero_copy_only=False)[order] if len(order) else np.zeros(0, bool)
        n_best, sums = [], []
        for links in documents["links"].to_pylist():
            numbers, n = links_of(links)
            sums.append(int((count[numbers] * n).sum()))
            n_best.append(int(n[best[numbers]].sum()))
        columns = {f.name: documents[f.name] for f in keys}
        return pa.table(columns | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())})

    documents = staged.where("kinds is null").drop("kinds", "totals")
    return documents.groupBy("block").cogroup(scores.groupBy("of_block")).applyInArrow(
        scored, f"{head}, n_best long, count_sum long"
    )
