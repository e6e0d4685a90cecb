"""Byte-level BPE by a dynamic program over prefixes, and its inverse.

For every prefix of a piece there is exactly one token that can end its encoding. The program stores that last
token per prefix: among the tokens that end here it takes the longest whose predecessor (the last token of the
prefix before it) stays in front of it when the two are encoded together. Reading the table backwards gives
the encoding of any prefix, so bytes can be appended without looking back, and after an edit only what follows
it is computed anew until the old table holds again.

A text is first cut into pieces by the vocabulary's pattern; pieces are encoded separately. The pieces of a batch that are
not known yet go through the program together, one place after the other, as arrays (`PieceTables`).

Defined results: a null text counts as empty and has no ids; repeated rows get the same ids; an empty table
gives an empty table; columns other than the text and those named in `keep` are ignored, so no name can clash.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripflow.llm.common import U64, RangeHash, lean, sliced

# A task remembers the encodings of so many pieces (twice as many: the older half goes when the younger is full), a worker so
# many pairs of neighbours; then they start afresh. `share` scales the first; with a share below one a task gives its
# pairs back as well.
REMEMBERED_PIECES = 150_000
REMEMBERED_PAIRS = 250_000
# Longer pieces are encoded one by one.
SHORT_PIECE_BYTES = 48
# So many new pieces at least, and so many bytes of them at once, are encoded as arrays.
LEAST_TOGETHER = 64
TOGETHER_BYTES = 1 << 17
# Bytes of text that are cut into pieces at once.
CUT_BYTES = 1 << 19


def load_ranks(path: str) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


# Pairs of ranks are kept as one integer: a tuple and two integers of its own would take three times as much.
PAIR_BITS = 32


class Vocabulary:
    """Ranks, their inverse and the tokens that merging can give; `apart` remembers which neighbours stay apart.

    A copy sent to a worker is put together so that its tables share their integers.
    """

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks = ranks
        # A token whose own bytes merge into something else can never end a merged prefix.
        reached = [len(token) == 1 or self.merged(token) == [rank] for token, rank in ranks.items()]
        # The two tokens whose merge makes each token last.
        halves = (
            (rank, rank) if len(token) == 1 or not merges else self.merged(token, 2)
            for (token, rank), merges in zip(ranks.items(), reached, strict=True)
        )
        left, right = (array("q", half) for half in zip(*halves, strict=True))
        self.__setstate__((list(ranks), array("q", ranks.values()), reached, left, right))

    def __getstate__(self) -> tuple:
        ranks = array("q", self.ranks.values())
        halves = (array("q", map(half.__getitem__, ranks)) for half in (self.left_half, self.right_half))
        return (list(self.ranks), ranks, [token in self.reachable for token in self.ranks], *halves)

    def __setstate__(self, state: tuple) -> None:
        tokens, ranks, reached, left, right = state
        ranks = ranks.tolist()
        same = dict(zip(ranks, ranks, strict=True)).__getitem__
        self.ranks = dict(zip(tokens, ranks, strict=True))
        self.tokens = dict(zip(ranks, tokens, strict=True))
        self.size = {rank: len(token) for token, rank in self.ranks.items()}
        self.longest = max(map(len, tokens))
        merged = [(token, rank) for token, rank, merges in zip(tokens, ranks, reached, strict=True) if merges]
        self.reachable = self.ranks if len(merged) == len(ranks) else dict(merged)
        self.left_half = dict(zip(ranks, map(same, left), strict=True))
        self.right_half = dict(zip(ranks, map(same, right), strict=True))
        self.apart: dict[int, bool] = {}
        self.__dict__.pop("tables", None)
        # The longest merged token that ends with three given bytes: a prefix need not look back further.
        self.reach: dict[bytes, int] = {}
        # The token that each pair of halves makes.
        self.joined: dict[int, int] = {}
        for token, rank in merged:
            self.reach[token[-3:]] = max(self.reach.get(token[-3:], 2), len(token))
            if len(token) > 1:
                self.joined[self.left_half[rank] << PAIR_BITS | self.right_half[rank]] = rank

    @cached_property
    def tables(self) -> PieceTables:
        return PieceTables(self)

    def forget_pairs(self) -> None:
        self.apart.clear()
        self.__dict__.pop("tables", None)

    def merged(self, data: bytes, until: int = 1) -> list[int]:
        """Plain merging, lowest rank first, down to `until` tokens at least."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def stay_apart(self, left: int, right: int) -> bool:
        if len(self.apart) > REMEMBERED_PAIRS:
            self.apart.clear()
        self.apart[left << PAIR_BITS | right] = apart = self._never_meet(left, right)
        return apart

    def _never_meet(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two tokens while each is put together from its bytes.

        Both are taken apart again along the border, the one made later first: a pair that meets there merges if its
        rank comes before the merge that was undone last.
        """
        latest = 1 << 62
        while True:
            if self.joined.get(left << PAIR_BITS | right, latest) < latest:
                return False
            steps = (self._undo_left, self._undo_right) if left > right else (self._undo_right, self._undo_left)
            for undo in steps:
                parts = undo(left, right)
                if parts:
                    left, right, latest = parts
                    break
            else:
                return True

    def _undo_left(self, left: int, right: int) -> tuple[int, int, int] | None:
        part = self.right_half[left]
        return None if part == left else (part, right, left)

    def _undo_right(self, left: int, right: int) -> tuple[int, int, int] | None:
        # Of equal ranks the pair further left merges first, so one that crosses the border still comes first.
        part = self.left_half[right]
        return None if part == right else (left, part, right + 1)

    def extend(self, data: bytes, last: array, until: int) -> None:
        """Add the last tokens of the prefixes that end at len(last) + 1 to `until`."""
        token_of, known, reach, stay_apart = self.reachable.get, self.apart.get, self.reach.get, self.stay_apart
        for end in range(len(last) + 1, until + 1):
            for start in range(max(0, end - reach(data[max(0, end - 3) : end], 2)), end):
                token = token_of(data[start:end])
                if token is None:
                    continue
                if start == 0:
                    break
                left = last[start - 1]
                apart = known(left << PAIR_BITS | token)
                if apart or (apart is None and stay_apart(left, token)):
                    break
            else:
                raise ValueError("no token can end this prefix")
            last.append(token)


_ODD = U64(0x9E3779B97F4A7C15)


class Lookup:
    """Values (from 0 on) of 64-bit keys, by open addressing: arrays of keys are looked up together, -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = len(keys).bit_length() + 2
        self.shift, self.last = U64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        slot, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = left[self.values[slot[left]] < 0]
            at, first = np.unique(slot[free], return_index=True)
            self.keys[at], self.values[at] = keys[free[first]], values[free[first]]
            left = np.setdiff1d(left, free[first])
            slot[left] = (slot[left] + 1) & self.last

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._home(keys)
        out = self.values[slot]
        other = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(other):
            slot[other] = at = (slot[other] + 1) & self.last
            out[other] = self.values[at]
            other = other[(out[other] >= 0) & (self.keys[at] != keys[other])]
        return out


class PieceTables:
    """The vocabulary as arrays: many short pieces go through the program together.

    Tokens are numbered by rank here, so numbers compare as ranks do. A token is found by the hash of its bytes.
    """

    def __init__(self, v: Vocabulary):
        self.ranks = np.array(sorted(v.tokens), np.int64)
        tokens = [v.tokens[rank] for rank in self.ranks.tolist()]
        self.size = np.fromiter(map(len, tokens), np.int32, len(tokens))
        half = lambda of: np.searchsorted(self.ranks, [of[rank] for rank in self.ranks.tolist()]).astype(np.int32)
        self.left_half, self.right_half = half(v.left_half), half(v.right_half)
        number = np.arange(len(tokens), dtype=np.int32)
        merged = np.fromiter((token in v.reachable for token in tokens), bool, len(tokens))
        usable = number[merged & (self.size <= SHORT_PIECE_BYTES)]
        body, ends = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(self.size, dtype=np.int64)
        first, end = (ends - self.size)[usable], ends[usable]
        self.found = Lookup(RangeHash(body)(first, end), usable)
        made = number[merged & (self.size > 1)]
        self.joined = Lookup(self._pair(self.left_half[made], self.right_half[made]).view(np.uint64), made)
        # By the four bytes that a longer token begins or ends with: a bit for each size that such tokens have.
        self.begins, self.ends = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.uint64)
        long, four = self.size[usable] > 3, self._fours(body)
        bit = U64(1) << self.size[usable][long].astype(np.uint64)
        np.bitwise_or.at(self.begins, four[first[long]], bit)
        np.bitwise_or.at(self.ends, four[end[long] - 4], bit)
        # Remembered pairs, each with its verdict as the last bit: a new one takes the place of what it meets.
        self.pairs = np.full(1 << (REMEMBERED_PAIRS.bit_length() - 1), -1, np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) * len(self.ranks) + right

    @staticmethod
    def _fours(body: np.ndarray) -> np.ndarray:
        """A hash of the four bytes that begin at each place."""
        if len(body) < 4:
            return np.empty(0, np.int64)
        wide = body.astype(np.uint32)
        four = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
        return ((four * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = self._pair(left, right)
        slot = ((pair.view(np.uint64) * _ODD) >> U64(65 - len(self.pairs).bit_length())).astype(np.int64)
        kept = self.pairs[slot]
        out = (kept & 1).astype(bool)
        new = np.flatnonzero(kept >> 1 != pair)
        if len(new):
            out[new] = self._never_meet(left[new], right[new])
            self.pairs[slot[new]] = pair[new] << 1 | out[new]
        return out

    def _never_meet(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As `Vocabulary._never_meet`, pair by pair."""
        out, own = np.zeros(len(left), bool), np.arange(len(left))
        latest = np.full(len(left), len(self.ranks), np.int32)
        while len(own):
            made = self.joined(self._pair(left, right).view(np.uint64))
            part_left, part_right = self.right_half[left], self.left_half[right]
            can_left, can_right = part_left != left, part_right != right
            going = (made < 0) | (made >= latest)
            out[own[going & ~can_left & ~can_right]] = True
            going &= can_left | can_right
            undo_left = can_left & ((left > right) | ~can_right)
            latest = np.where(undo_left, left, right + 1)[going]
            left, right = np.where(undo_left, part_left, left)[going], np.where(undo_left, right, part_right)[going]
            own = own[going]
        return out

    def _tokens_within(self, body: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the last byte, size, token) of all tokens in the pieces, longest first."""
        hashes, four = RangeHash(body), self._fours(body)
        begins, ends = np.zeros(len(body), np.uint64), np.zeros(len(body), np.uint64)
        begins[: len(four)], ends[len(body) - len(four) :] = self.begins[four], self.ends[four]
        last, found = np.arange(len(body)), []
        for size in range(1, SHORT_PIECE_BYTES + 1):
            last = last[column[last] >= size - 1]
            if size > 3:
                last = last[ends[last] >> U64(size) != 0]
                at = last[(ends[last] & begins[last - size + 1]) >> U64(size) & U64(1) != 0]
            else:
                at = last
            if not len(last):
                break
            token = self.found(hashes(at - size + 1, at + 1))
            # The size is compared too: two strings of one hash would have to be of one size as well.
            hit = np.flatnonzero((token >= 0) & (self.size[token] == size))
            found.append((at[hit], np.full(len(hit), size), token[hit]))
        return tuple(np.concatenate(x) for x in zip(*found[::-1], strict=True))

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces of 1 to `SHORT_PIECE_BYTES` bytes, as little-endian unsigned 32-bit integers."""
        body = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        column = np.arange(len(body)) - np.repeat(ends - sizes, sizes)
        place, size, token = self._tokens_within(body, column)
        order = np.argsort(column[place].astype(np.uint8), kind="stable")
        place, size, token = place[order], size[order], token[order]
        cuts = np.cumsum(np.bincount(column[place], minlength=int(sizes.max()))).tolist()
        # The last token of the prefix that ends with each byte.
        last, low = np.full(len(body), -1, np.int32), 0
        for at, high in enumerate(cuts):
            p, n, t = place[low:high], size[low:high], token[low:high]
            fits = n == at + 1
            inner = np.flatnonzero(~fits)
            fits[inner] = self.stay_apart(last[p[inner] - n[inner]], t[inner])
            # The longest of a place is written last and stays.
            last[p[fits][::-1]] = t[fits][::-1]
            if (last[p] < 0).any():
                raise ValueError("no token can end this prefix")
            low = high
        path, at, first = np.zeros(len(body), bool), ends - 1, ends - sizes
        while len(at):
            path[at] = True
            at = at - self.size[last[at]]
            inside = at >= first
            at, first = at[inside], first[inside]
        path = np.flatnonzero(path)
        ids = self.ranks[last[path]].astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(path, ends)).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


class PrefixTable:
    """Last tokens of all prefixes of a growing, editable byte string (one piece)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", array("i")
        self.append(data)

    def append(self, data: bytes) -> PrefixTable:
        self.data += data
        self.vocabulary.extend(self.data, self.last, len(self.data))
        return self

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes; returns how many prefixes were computed anew.

        Once as many last tokens in a row as the longest token has bytes agree with the old table behind the
        edit, all later ones do.
        """
        tail_last = self.last[end:]
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start:]
        self.vocabulary.extend(self.data, self.last, start + len(new))
        anew, agree = len(new), 0
        for k in range(len(tail_last)):
            self.vocabulary.extend(self.data, self.last, len(self.last) + 1)
            anew += 1
            agree = agree + 1 if self.last[-1] == tail_last[k] else 0
            if agree >= self.vocabulary.longest:
                self.last += tail_last[k + 1 :]
                break
        return anew

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of a prefix, of all bytes by default."""
        end = len(self.data) if end is None else end
        out = []
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Encoder:
    """Whole texts to ids: pieces by `pattern`, new ones of a batch together, known ones from memory."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, share: float = 1.0):
        """`share` scales the remembered pieces: less takes more time and gives the same ids."""
        self.most_pieces, self.keeps_pairs = int(share * REMEMBERED_PIECES), share >= 1
        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give the memories of the task back; the vocabulary outlives it, and so do its pairs unless memory is short."""
        self.known, self.older = {}, {}
        if not self.keeps_pairs:
            self.vocabulary.forget_pairs()

    def piece_ids(self, piece: str) -> list[int]:
        return self._one(piece.encode("utf-8", "surrogatepass"))

    def _one(self, data: bytes) -> list[int]:
        token = self.vocabulary.ranks.get(data)
        return PrefixTable(self.vocabulary, data).ids() if token is None else [token]

    def _learn(self, pieces: Iterable[str]) -> None:
        """Take the encodings of pieces from the older half, or make them."""
        known, older, token_of, new, size = self.known, self.older.get, self.vocabulary.ranks.get, {}, 0
        for piece in pieces:
            ids = older(piece)
            if ids is None:
                data = piece.encode("utf-8", "surrogatepass")
                if 0 < len(data) <= SHORT_PIECE_BYTES and token_of(data) is None:
                    new[piece] = data
                    size += len(data)
                    if size > TOGETHER_BYTES:
                        self._together(new)
                        new, size = {}, 0
                    continue
                ids = np.array(self._one(data), "<u4").tobytes()
            known[piece] = ids
        self._together(new)

    def _together(self, new: dict[str, bytes]) -> None:
        if len(new) < LEAST_TOGETHER:
            self.known.update((piece, np.array(self._one(data), "<u4").tobytes()) for piece, data in new.items())
        else:
            self.known.update(zip(new, self.vocabulary.tables.encode(list(new.values())), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.most_pieces:
            self.older, self.known = self.known, {}
        cut = [self.split(text) if text else () for text in texts]
        self._learn(set(chain.from_iterable(cut)).difference(self.known))
        ids = self.known.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in cut]

    def ids(self, text: str) -> bytes:
        return self.encode([text])[0]


class EditableEncoding:
    """A text with the prefix tables of its pieces; appends and edits redo only the pieces they touch."""

    # A pattern looks at most this many pieces back from a change (a contraction is one mark and two letters).
    BACK = 4

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.pieces, self.redone = encoder, [], 0
        self.edit(0, 0, text)

    def _entry(self, piece: str) -> tuple[str, list[int]]:
        self.redone += 1
        return piece, self.encoder.piece_ids(piece)

    @property
    def text(self) -> str:
        return "".join(p for p, _ in self.pieces)

    def append(self, more: str) -> EditableEncoding:
        n = sum(len(p) for p, _ in self.pieces)
        return self.edit(n, n, more)

    def edit(self, start: int, end: int, new: str) -> EditableEncoding:
        text, old, self.redone = self.text, self.pieces, 0
        starts, at = [], 0
        for piece, _ in old:
            starts.append(at)
            at += len(piece)
        first = max(0, int(np.searchsorted(starts, start, side="right")) - self.BACK) if starts else 0
        begin = starts[first] if first < len(starts) else 0
        changed, shift = text[:start] + new + text[end:], len(new) - (end - start)
        old_at = {s + shift: k for k, s in enumerate(starts) if s >= end}
        pieces, at = old[:first], begin
        for found in regex.finditer(self.encoder.split.__self__.pattern, changed, pos=begin):
            # A cut where the old text was cut too: the rest depends only on what follows.
            if found.start() >= start + len(new) and found.start() in old_at:
                pieces += old[old_at[found.start()] :]
                break
            pieces.append(self._entry(found[0]))
        self.pieces = pieces
        return self

    def ids(self) -> list[int]:
        return [token for _, ids in self.pieces for token in ids]


def _rows(docs: DataFrame, column: str, keep: tuple[str, ...], made: tuple[str, ...], convert) -> DataFrame:
    """Columns `keep` and the binary columns `made`, of which `convert` makes one or more from the values of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, forget = convert()
        try:
            for batch in (part for whole in batches for part in sliced(whole, column, CUT_BYTES)):
                values = [pa.array(x, pa.binary()) for x in columns(batch.column(column).to_pylist())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *values], [*keep, *made])
        finally:
            forget()

    schema = T.StructType([*(docs.schema[c] for c in keep), *[T.StructField(m, T.BinaryType()) for m in made]])
    return docs.select(*dict.fromkeys((*keep, column))).mapInArrow(lean(run), schema)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    decoded: str | None = None,
    share: float = 1.0,
) -> DataFrame:
    """Columns `keep` and `ids` (little-endian unsigned 32-bit integers), one row per input row.

    `decoded` names a further column with the bytes that these ids stand for: both come from one pass, with one worker a
    task. `share` scales what is remembered (about 60 MB at most). `ranks_path` is read by the driver, so executors need
    no copy of the file; a vocabulary is a few MB.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(load_ranks(ranks_path)))

    def convert():
        encoder = Encoder(vocabulary.value, pattern, share)
        back = _decoder(vocabulary.value.tokens)

        def columns(texts: list[str | None]) -> list[list[bytes]]:
            ids = encoder.encode(texts)
            return [ids, list(map(back, ids))] if decoded else [ids]

        return columns, encoder.forget

    return _rows(docs, text, keep, ("ids", decoded) if decoded else ("ids",), convert)


def _decoder(tokens: dict[int, bytes]):
    token = tokens.__getitem__
    return lambda ids: b"".join(map(token, np.frombuffer(ids, "<u4").tolist())) if ids else b""


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `decoded` (the bytes that the ids stand for)."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def convert():
        back = _decoder({rank: data for data, rank in ranks.value.items()})
        return lambda values: [list(map(back, values))], lambda: None

    return _rows(encoded, ids, keep, ("decoded",), convert)
