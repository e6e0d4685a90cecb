"""SentencePiece BPE: encoding by vectorised merge rounds over flat symbol arrays, and its inverse.

The words of a batch are one array of symbols (one per character at first). In a round every word finds the smallest
rank among its neighbouring pairs, all pairs of that rank merge at once, leftmost first where they overlap, and the
array is compacted; words without a pair that merges are done. That gives what merging one pair at a time gives (best
score first, then leftmost): new pairs of a smaller or equal rank would have to come before the other pairs of the
round, so where a merge can make such a pair only the leftmost of the round is taken.

Words longer than LONG symbols do not wait for their one smallest pair: a pair merges when it is the smallest
within as many symbols to either side as the longest piece has characters. Nothing beyond can reach it first, because what
reaches it would have swallowed all symbols between and be longer than any piece.

Texts are cut into words before each space marker that follows another character, as long as no piece has one there.
Repeated words are encoded once per batch and remembered up to REMEMBERED_BYTES.

Models: BPE without a normalisation map, user-defined or unused pieces; others are refused with a ValueError.

Defined results: a null text counts as empty; an empty text has the end id only; repeated rows get the same ids; an
empty table gives an empty table; columns other than the text and those named in `keep` are ignored, so no name can
clash. Characters without a piece become one byte piece per UTF-8 byte, or the unknown id in models without them.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripflow.llm.common import lean, sliced

SPACE = "▁"
LONG = 64
# A worker remembers the ids of words up to about so many bytes, then starts afresh.
REMEMBERED_BYTES = 24 << 20
NO_RANK = np.int32(2**31 - 1)
NO_KEY = np.uint64(2**64 - 1)

# Field numbers and piece types of the model file's format.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
MODEL_TYPE, BYTE_FALLBACK, END_ID, SUFFIX_SPACE = 3, 35, 42, 24
BPE_TYPE = 2
CHARS_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5


def _message(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one encoded message; values are numbers or bytes."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        elif kind in (1, 2, 5):
            size = number() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError("not a SentencePiece model")


class Model:
    """Pieces, the ranks of pairs of symbols, and the cuts between words, as arrays.

    Symbols are numbered: first all characters that occur in pieces, then the longer pieces, then one symbol
    that stands for every other character.
    """

    def __init__(self, data: bytes):
        pieces, scores, kinds, trainer, normal = [], [], [], {}, {}
        for field, value in _message(data):
            if field == PIECE:
                part = dict(_message(value))
                pieces.append(part.get(1, b"").decode())
                scores.append(struct.unpack("<f", part[2])[0] if 2 in part else 0.0)
                kinds.append(part.get(3, NORMAL))
            elif field == TRAINER:
                trainer = dict(_message(value))
            elif field == NORMALIZER:
                normal = dict(_message(value))
        if trainer.get(MODEL_TYPE, 1) != BPE_TYPE or {USER_DEFINED, UNUSED} & set(kinds) or trainer.get(SUFFIX_SPACE, 0):
            raise ValueError("only plain BPE models are supported")
        if normal.get(CHARS_MAP) or normal.get(REMOVE_SPACES, 1) or not normal.get(ESCAPE_SPACES, 1):
            raise ValueError("only models that leave the text as it is are supported")
        self.dummy_prefix = bool(normal.get(DUMMY_PREFIX, 1))
        self.end_id = trainer.get(END_ID, 2)
        self.unknown = kinds.index(UNKNOWN)
        fallback = bool(trainer.get(BYTE_FALLBACK, 0))
        byte_ids = {int(p[3:5], 16): k for k, p in enumerate(pieces) if kinds[k] == BYTE}
        self.byte_ids = np.array([byte_ids[b] for b in range(256)], np.int32) if fallback else None
        self.kinds = np.array(kinds, np.int8)
        self.surface = [self._surface(p, k) for p, k in zip(pieces, kinds, strict=True)]
        self.spaced = np.array([p.startswith(SPACE) for p in pieces])
        ids = {p: k for k, p in enumerate(pieces) if kinds[k] == NORMAL}
        self._index(ids, scores)

    @staticmethod
    def _surface(piece: str, kind: int) -> bytes:
        if kind == CONTROL:
            return b""
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def _index(self, ids: dict[str, int], scores: list[float]) -> None:
        chars = sorted(set("".join(ids)))
        longer = [p for p in ids if len(p) > 1]
        names = [*chars, *longer]
        symbol = {p: k for k, p in enumerate(names)}
        self.symbol_of = np.full(0x110000, len(names), np.int32)
        self.symbol_of[[ord(c) for c in chars]] = np.arange(len(chars))
        # The id of each symbol; -1 where a character has no piece of its own.
        self.ids = np.array([*(ids.get(p, -1) for p in names), -1], np.int32)
        self.longest = max(map(len, names), default=1)
        # Equal scores share a rank; the best score has rank 0.
        ordered = sorted({-scores[ids[p]] for p in longer})
        place = {s: k for k, s in enumerate(ordered)}
        rank = {p: place[-scores[ids[p]]] for p in longer}
        pairs = {}
        careful = np.zeros(len(ordered) + 1, bool)
        for p in longer:
            for k in range(1, len(p)):
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank[p], symbol[p])
                    for part in (p[:k], p[k:]):
                        if part in rank and rank[part] >= rank[p]:
                            careful[rank[part]] = True
        self.careful = careful
        self.rank = np.array([*(r for r, _ in pairs.values()), NO_RANK], np.int32)
        self.product = np.array([*(s for _, s in pairs.values()), -1], np.int32)
        self.no_pair = len(pairs)
        self._hash(np.array(list(pairs), np.uint64))
        # Without a piece that has a space marker behind another character, texts can be cut before markers.
        self.cut = not any(p[k] == SPACE and p[k - 1] != SPACE for p in longer for k in range(1, len(p)))

    def _hash(self, keys: np.ndarray) -> None:
        """A table of pairs by their hash; a taken slot passes a pair on to the next one."""
        self.shift = np.uint64(64 - max(8, int(len(keys) * 6).bit_length()))
        slots = int(1 << (64 - int(self.shift))) + len(keys)
        self.slot_key, self.slot_pair, self.probes = np.full(slots, NO_KEY), np.full(slots, len(keys), np.int32), 0
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            self.probes += 1
            _, first = np.unique(at[left], return_index=True)
            taker = left[first]
            taker = taker[self.slot_key[at[taker]] == NO_KEY]
            self.slot_key[at[taker]], self.slot_pair[at[taker]] = keys[taker], taker
            left = left[self.slot_key[at[left]] != keys[left]]
            at[left] += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def pair_at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of each pair of symbols; `no_pair` if it never merges."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = self._slot(keys)
        found = np.where(self.slot_key[at] == keys, self.slot_pair[at], self.no_pair)
        unsure = np.flatnonzero((self.slot_key[at] != keys) & (self.slot_key[at] != NO_KEY))
        for _ in range(1, self.probes):
            if not len(unsure):
                break
            at[unsure] += 1
            key, wanted = self.slot_key[at[unsure]], keys[unsure]
            hit = key == wanted
            found[unsure[hit]] = self.slot_pair[at[unsure[hit]]]
            unsure = unsure[~hit & (key != NO_KEY)]
        return found


def _sliding_min(values: np.ndarray, before: int, after: int) -> np.ndarray:
    """The smallest value among values[i - before : i + after + 1]."""
    width, power = before + after + 1, 1
    padded = np.concatenate([np.full(before, NO_RANK), values, np.full(after, NO_RANK)])
    while power * 2 <= width:
        padded = np.minimum(padded[:-power], padded[power:])
        power *= 2
    n = len(values)
    return np.minimum(padded[:n], padded[width - power : width - power + n])


def _runs_kept(chosen: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Every second pair of each run of linked pairs, as far as all before it in the run are chosen too.

    linked[i]: pair i overlaps pair i - 1 and has its rank.
    """
    n = len(chosen)
    place = np.arange(n)
    first = np.maximum.accumulate(np.where(linked, 0, place))
    missed = np.concatenate([[0], np.cumsum(~chosen)])
    return chosen & (missed[place] == missed[first]) & ((place - first) % 2 == 0)


def merge_rounds(model: Model, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge until no pair remains. `words` holds the ascending word number of each symbol.

    Returns the merged symbols and their places: the place of the first character of each.
    """
    places = np.arange(len(symbols), dtype=np.int32)
    counts = np.bincount(words) if len(words) else np.zeros(0, np.int64)
    long_word = (counts > LONG)[words] if len(words) else np.zeros(0, bool)
    done_symbols, done_places = [], []
    for part, windowed in ((~long_word, False), (long_word, True)):
        now, word, place = symbols[part], words[part], places[part]
        pair = np.full(len(now), model.no_pair, np.int32)
        if len(now) > 1:
            same = word[:-1] == word[1:]
            pair[:-1][same] = model.pair_at(now[:-1][same], now[1:][same])
        while len(now):
            rank = model.rank[pair]
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            over = least == NO_RANK
            if over.any():
                # Finished words leave the arrays.
                gone = np.repeat(over, sizes)
                done_symbols.append(now[gone])
                done_places.append(place[gone])
                now, word, place, pair, rank = (x[~gone] for x in (now, word, place, pair, rank))
                if not len(now):
                    break
                starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                sizes, least = sizes[~over], least[~over]
            merges = rank != NO_RANK
            if windowed:
                reach = model.longest
                chosen = merges & (rank <= _sliding_min(rank, reach, reach))
                earlier = np.concatenate([[NO_RANK], _sliding_min(rank, reach - 1, 0)[:-1]]) if len(rank) else rank
                alone = model.careful[np.where(merges, rank, 0)] & merges
                chosen &= ~alone | (rank < earlier)
            else:
                chosen = merges & (rank == np.repeat(least, sizes))
                alone = np.repeat(model.careful[least], sizes)
                if alone.any():
                    count = np.cumsum(chosen)
                    before = np.repeat(count[starts] - chosen[starts], sizes)
                    chosen &= ~alone | (count - before == 1)
            if windowed:
                linked = np.zeros(len(now), bool)
                linked[1:] = merges[1:] & (rank[1:] == rank[:-1]) & (word[1:] == word[:-1])
                at = np.flatnonzero(_runs_kept(chosen, linked))
            else:
                # All pairs of a word's smallest rank are chosen: of overlapping ones every second stays.
                at = np.flatnonzero(chosen)
                linked = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (word[at[1:]] == word[at[:-1]])])
                at = at[_runs_kept(np.ones(len(at), bool), linked)]
            now[at] = model.product[pair[at]]
            stay = np.ones(len(now), bool)
            stay[at + 1] = False
            # Only pairs beside a merge are looked up anew.
            stale = np.zeros(len(now), bool)
            stale[at] = True
            stale[np.maximum(at - 1, 0)] = True
            stay = np.flatnonzero(stay)
            now, word, place, pair = (x.take(stay) for x in (now, word, place, pair))
            look = np.flatnonzero(stale.take(stay))
            pair[look] = model.no_pair
            look = look[look < len(now) - 1]
            look = look[word[look] == word[look + 1]]
            pair[look] = model.pair_at(now[look], now[look + 1])
    if not done_places:
        return symbols[:0], places[:0]
    places = np.concatenate(done_places)
    order = np.argsort(places, kind="stable")
    return np.concatenate(done_symbols)[order], places[order]


class Encoder:
    """Whole texts to ids; new words of a batch go through the merge rounds together."""

    WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def __init__(self, model: Model):
        self.model, self.known, self.bytes = model, {}, 0

    def words(self, text: str) -> list[str]:
        marked = (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)
        return self.WORD.findall(marked) if self.model.cut else [marked]

    def _learn(self, words: list[str]) -> None:
        model = self.model
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(w) for w in words])
        sizes = np.diff(np.concatenate([[0], ends]))
        merged, places = merge_rounds(model, model.symbol_of[codes], np.repeat(np.arange(len(words), dtype=np.int32), sizes))
        ids = model.ids[merged]
        missing = np.flatnonzero(ids < 0)
        if len(missing) and model.byte_ids is not None:
            spelled = [model.byte_ids[np.frombuffer(chr(codes[places[k]]).encode(), np.uint8)] for k in missing]
            sizes = np.ones(len(ids), np.int64)
            sizes[missing] = [len(s) for s in spelled]
            where = np.repeat(ids < 0, sizes)
            ids, places = np.repeat(ids, sizes), np.repeat(places, sizes)
            ids[where] = np.concatenate(spelled)
        elif len(missing):
            # Neighbouring unknown characters are one unknown id.
            ids[missing] = model.unknown
            again = np.zeros(len(ids), bool)
            again[1:] = (ids[1:] == model.unknown) & (ids[:-1] == model.unknown) & ~np.isin(places[1:], ends)
            ids, places = ids[~again], places[~again]
        bounds = (4 * np.concatenate([[0], np.searchsorted(places, ends)])).tolist()
        flat = ids.astype("<i4").tobytes()
        self.known.update(zip(words, [flat[a:b] for a, b in zip(bounds, bounds[1:])], strict=True))
        self.bytes += 4 * (len(flat) + len(codes)) // 3 + 160 * len(words)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, with the end id."""
        if self.bytes > REMEMBERED_BYTES:
            self.known, self.bytes = {}, 0
        cut = [self.words(t) if t else [] for t in texts]
        new = list(set(chain.from_iterable(cut)) - self.known.keys())
        if new:
            self._learn(new)
        end, known = struct.pack("<i", self.model.end_id), self.known.__getitem__
        return [b"".join([*map(known, words), end]) for words in cut]


def decoded(model: Model, ids: np.ndarray) -> str:
    """The text of ids: bytes that spell no character become U+FFFD, control ids nothing."""
    ids = np.asarray(ids, np.int64)
    control = model.kinds[ids] == CONTROL
    if control.any():
        shown = np.flatnonzero(~control)
        if not len(shown):
            return ""
        ids, control = ids[shown[0] : shown[-1] + 1], control[shown[0] : shown[-1] + 1]
    if not len(ids):
        return ""
    parts = list(map(model.surface.__getitem__, ids.tolist()))
    if model.dummy_prefix and model.spaced[ids[0]] and model.kinds[ids[0]] == NORMAL:
        parts[0] = parts[0][1:]
    if not control.any():
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            pass
    # Bytes that spell no character are replaced one by one; a run of byte pieces ends at any other id.
    out, run = [], bytearray()
    for is_byte, part in zip([*(model.kinds[ids] == BYTE), False], [*parts, b""], strict=True):
        if is_byte:
            run += part
            continue
        while run:
            size = next((n for n in range(1, 5) if _spells(run[:n])), 0)
            out.append(run[:size].decode() if size else "\ufffd")
            del run[: size or 1]
        out.append(part.decode())
    return "".join(out)


def _spells(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def read_model(path: str) -> bytes:
    """The model file's bytes, read by the driver: executors need no copy of the file."""
    with open(path, "rb") as file:
        return file.read()


def _mapped(frame: DataFrame, column: str, keep: tuple[str, ...], made: T.StructField, kind: pa.DataType, data: bytes, convert):
    shared = frame.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = convert(Model(shared.value))
        for whole in batches:
            parts = sliced(whole, column) if pa.types.is_string(whole.column(column).type) else (whole,)
            for batch in parts:
                values = turn(batch.column(column))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), values.cast(kind)], [*keep, made.name])

    schema = T.StructType([*(frame.schema[c] for c in keep), made])
    return frame.select(*dict.fromkeys((*keep, column))).mapInArrow(lean(run), schema)


def encode(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `ids` (array of integers, the end id last), one row per input row."""

    def convert(model: Model):
        encoder = Encoder(model)

        def turn(column: pa.Array) -> pa.Array:
            rows = encoder.encode(column.to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
            values = np.frombuffer(b"".join(rows), "<i4")
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))

        return turn

    made = T.StructField("ids", T.ArrayType(T.IntegerType(), False))
    return _mapped(docs, text, keep, made, pa.list_(pa.int32()), read_model(model_path), convert)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `decoded` (the text the ids stand for; null ids give an empty text)."""

    def convert(model: Model):
        def turn(column: pa.ListArray) -> pa.Array:
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            return pa.array([decoded(model, values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())

        return turn

    return _mapped(encoded, ids, keep, T.StructField("decoded", T.StringType()), pa.string(), read_model(model_path), convert)
