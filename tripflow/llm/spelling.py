"""Spelling variants: words of a corpus that differ by one edit, found with bidirectional FM-indexes.

Two words one edit apart agree in one half: the edit leaves either the first or the second half of a word as it is. A
search matches that half exactly, from its end of the word, and extends it across the other half allowing one inserted,
deleted or replaced character. The index is over the delimited vocabulary, |word|word|...|, and a match is an
interval of suffix ranks, kept in step for the text and for the reversed text; the rank of a delimited word among
all suffixes that begin with a delimiter is its place in the sorted vocabulary.

Halves of words of KEY * 2 characters and more begin (or end) with KEY characters. The vocabulary is dealt by these into
shards, each with an index of its own, and a word is searched only in the shards of its two keys. A key with more
than SHARD_WORDS words is dealt by length too (a word goes to its own length and both neighbours), and a length with
more than that by a hash (a word goes to all parts): the index of a task stays small however the words are spread.

Defined results: null and empty texts have no words; a null id counts as an empty one in the hash that deletes
characters; repeated rows count repeatedly; a word without near words is its own root; an empty table gives an empty
table; other columns are ignored, so no name can clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import FOLD, lean, stored

# The runs that are words (as UTF-8, after folding A-Z), the divisor of hashes that delete a character, the
# least length and count of a word, and how many times more frequent its form must be.
RUN = rb"(?:[a-z]|\xc3[\x80-\xbf])+"
DELETES = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_FACTOR = 5

KEY = LEAST_LENGTH // 2
SHARD_WORDS = 4096
# A task hands over its counts whenever it holds so many words.
HELD_WORDS = 200_000
# Queries are searched so many at a time, and intervals up to so many ranks are read instead of tried symbol by symbol.
QUERIES_AT_ONCE = 2048
READ_RANKS = 48

END, DELIMITER, FIRST_LETTER = 0, 1, 2
_FOLD = FOLD.tobytes()


def altered(run: bytes, doc_id: str) -> bytes:
    """The run, or the run less one character where the hash of document and run says so."""
    h = zlib.crc32(run, zlib.crc32(f"{doc_id}:".encode()))
    if h % DELETES:
        return run
    text = run.decode()
    k = h % len(text)
    return (text[:k] + text[k + 1 :]).encode()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of the documents, counted after their alteration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = re.compile(RUN).findall, Counter()

        def handed() -> pa.RecordBatch:
            words = [w for w in held if len(w) - w.count(b"\xc3") >= LEAST_LENGTH]
            made = pa.array(words, pa.binary()).cast(pa.string()), pa.array([held[w] for w in words], pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays(list(made), ["word", "n"])

        for batch in batches:
            ids = batch.column("id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                if text is None:
                    continue
                crc = zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(find(text.encode().translate(_FOLD))).items():
                    held[word if zlib.crc32(word, crc) % DELETES else altered(word, doc_id)] += n
                if len(held) > HELD_WORDS:
                    yield handed()
        yield handed()

    given = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    parts = given.mapInArrow(lean(run), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Ranks:
    """Counts of symbols in the Burrows-Wheeler transform of one text, and where its suffixes by first symbol begin."""

    STEP = 32

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text, symbols)
        self.bwt = text[order - 1]
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        blocks = len(text) // self.STEP + 1
        at = np.arange(len(text)) // self.STEP * symbols + self.bwt
        counts = np.bincount(at, minlength=blocks * symbols).reshape(blocks, symbols)
        # smaller[b, c]: symbols smaller than c before block b.
        smaller = np.zeros((blocks, symbols + 1), np.int32)
        smaller[1:, 1:] = np.cumsum(np.cumsum(counts[:-1], axis=0), axis=1)
        self.smaller = smaller
        self.padded = np.concatenate([self.bwt, np.full(blocks * self.STEP - len(text), 255, np.uint8)]).reshape(blocks, self.STEP)

    def count(self, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the first `at` symbols are `symbol`, and how many are smaller."""
        block = at // self.STEP
        part = self.padded[block]
        inside = np.arange(self.STEP) < (at % self.STEP)[:, None]
        symbol_ = symbol[:, None].astype(np.uint8)
        less = self.smaller[block, symbol]
        equal = self.smaller[block, symbol + 1] - less
        return equal + ((part == symbol_) & inside).sum(1), less + ((part < symbol_) & inside).sum(1)

    def extend(self, low: np.ndarray, other: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """The intervals after one more symbol: the rank in this text, in the reversed one, and the size."""
        equal, less = self.count(low, symbol)
        equal_to, less_to = self.count(low + size, symbol)
        return self.begin[symbol] + equal, other + (less_to - less), equal_to - equal


def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """The suffixes in order: sorted by as many symbols as fit a number, then by twice as many at a time."""
    n, bits = len(text), max(1, int(symbols).bit_length())
    step = 62 // bits
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(step):
        key = key << bits | padded[k : k + n]
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], key[order][1:] != key[order][:-1]]))
        if rank[order[-1]] == n:
            return order
        later = np.zeros(n, np.int64)
        later[: max(n - step, 0)] = rank[step:]
        key = rank * (n + 1) + later
        step *= 2


class BidirectionalIndex:
    """Ranks of the delimited vocabulary (distinct words in code-point order) and of its reverse."""

    def __init__(self, words: list[str], alphabet: np.ndarray):
        self.words, self.alphabet, self.symbols = words, alphabet, len(alphabet) + FIRST_LETTER
        codes = np.frombuffer(("|" + "|".join(words) + "|").encode("utf-32-le"), np.uint32)
        text = np.where(codes == ord("|"), DELIMITER, np.searchsorted(alphabet, codes) + FIRST_LETTER).astype(np.uint8)
        end = np.array([END], np.uint8)
        self.forward = Ranks(np.concatenate([text, end]), self.symbols)
        self.backward = Ranks(np.concatenate([text[::-1], end]), self.symbols)

    def near(self, queries: list[str], from_start: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) places of the words that share a query's first half (second half, if not `from_start`) and
        differ from it by one edit across the other half."""
        # Extending to the right moves through the reversed text, and to the left through the text.
        ranks = self.backward if from_start else self.forward
        letters = [q if from_start else q[::-1] for q in queries]
        length = np.array([len(q) for q in queries], np.int64)
        exact = length // 2 if from_start else length - length // 2
        codes = np.frombuffer("".join(letters).encode("utf-32-le"), np.uint32)
        x = np.append(np.searchsorted(self.alphabet, codes) + FIRST_LETTER, DELIMITER)
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])

        def next_symbol(q, at):
            return np.where(at < length[q], x[np.minimum(begin[q] + at, len(x) - 1)], DELIMITER)

        first = int(ranks.begin[DELIMITER])
        q = np.arange(len(queries))
        low, other = np.full(len(q), first), np.full(len(q), first)
        size = np.full(len(q), len(self.words) + 1)
        # Searches that had their error: query, next place, interval.
        erred = [np.empty(0, np.int64)] * 5
        found = []
        at = 0
        while len(q) or len(erred[0]):
            parts = [erred]
            branch = at >= exact[q]
            if branch.any():
                bq, blow, bother, bsize = (v[branch] for v in (q, low, other, size))
                here = np.full(len(bq), at)
                wanted = next_symbol(bq, here)
                more = at < length[bq]
                parts.append([v[more] for v in (bq, here + 1, blow, bother, bsize)])
                row, symbol = self._children(ranks, blow, bsize)
                row, symbol = (v[symbol != wanted[row]] for v in (row, symbol))
                made = ranks.extend(blow[row], bother[row], bsize[row], symbol)
                row, made = row[made[2] > 0], [v[made[2] > 0] for v in made]
                parts.append([bq[row], here[row], *made])
                replaced = more[row]
                parts.append([bq[row][replaced], here[row][replaced] + 1, *(v[replaced] for v in made)])
            erred = [np.concatenate(v) for v in zip(*parts, strict=True)]
            # Searches past their last letter end with the delimiter: what is left is a word.
            eq, eat, elow, eother, esize = erred
            elow, eother, esize = ranks.extend(elow, eother, esize, next_symbol(eq, eat))
            over = (eat == length[eq]) & (esize > 0)
            forward = eother if from_start else elow
            found.append((eq[over], forward[over] - int(self.forward.begin[DELIMITER]) - 1))
            on = (eat < length[eq]) & (esize > 0)
            erred = [v[on] for v in (eq, eat + 1, elow, eother, esize)]
            low, other, size = ranks.extend(low, other, size, next_symbol(q, np.full(len(q), at)))
            on = (size > 0) & (at < length[q])
            q, low, other, size = (v[on] for v in (q, low, other, size))
            at += 1
        pairs = np.unique(np.concatenate([a * (len(self.words) + 1) + b for a, b in found] or [np.empty(0, np.int64)]))
        return pairs // (len(self.words) + 1), pairs % (len(self.words) + 1)

    def _children(self, ranks: Ranks, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, letter): the letters that may follow each interval; small intervals are read, others try every letter."""
        small = np.flatnonzero(size <= READ_RANKS)
        row = np.repeat(small, size[small])
        place = np.arange(len(row)) - np.repeat(np.cumsum(size[small]) - size[small], size[small])
        pairs = np.unique(row * 256 + ranks.bwt[low[row] + place])
        large = np.flatnonzero(size > READ_RANKS)
        letters = np.arange(FIRST_LETTER, self.symbols)
        row = np.concatenate([pairs // 256, np.repeat(large, len(letters))])
        symbol = np.concatenate([pairs % 256, np.tile(letters, len(large))])
        return row[symbol >= FIRST_LETTER], symbol[symbol >= FIRST_LETTER]


def near_words(index: list[str], queries: list[str], from_start: bool) -> tuple[list[str], list[str]]:
    """Pairs of a query and a word of the index as `BidirectionalIndex.near` finds them; no pair is found from both ends."""
    words = sorted(set(index))
    letters = np.frombuffer("".join([*words, *queries]).encode("utf-32-le"), np.uint32)
    built = BidirectionalIndex(words, np.unique(letters))
    left, right = [], []
    for k in range(0, len(queries), QUERIES_AT_ONCE):
        part = queries[k : k + QUERIES_AT_ONCE]
        a, b = built.near(part, from_start)
        for q, w in zip((part[i] for i in a.tolist()), (words[i] for i in b.tolist()), strict=True):
            if from_start or not w.startswith(q[: len(q) // 2]):
                left.append(q)
                right.append(w)
    return left, right


def _dealt(words: DataFrame) -> DataFrame:
    """(shard, side, word, n, indexed): the index rows and the query rows of every shard."""
    # 'h' shares the head, 't' the tail.
    sides = F.array(
        F.struct(F.lit("h").alias("side"), F.substring("word", 1, KEY).alias("key")),
        F.struct(F.lit("t").alias("side"), F.substring("word", -KEY, KEY).alias("key")),
    )
    keyed = words.withColumn("size", F.length("word")).withColumn("s", F.explode(sides)).select("word", "n", "size", "s.*")
    loads = stored(keyed.groupBy("side", "key", "size").agg(F.count("*").alias("load")), "loads")
    shards = max(1, -(-words.count() // SHARD_WORDS))
    crowded = F.when(F.col("load") > SHARD_WORDS, F.struct("size", F.ceil(F.col("load") / SHARD_WORDS).cast("int").alias("cuts")))
    # Of crowded keys, the lengths that are crowded themselves. There are no more keys than three letters can spell, and
    # at most one crowded key in SHARD_WORDS words.
    hot = loads.groupBy("side", "key").agg(F.sum("load").alias("total"), F.map_from_entries(F.collect_list(crowded)).alias("cuts"))
    hot = hot.where(F.col("total") > SHARD_WORDS).select("side", "key", "cuts")
    known = keyed.join(F.broadcast(hot), ["side", "key"], "left")
    named = lambda *parts: F.concat_ws(":", "side", *parts)
    bucket = lambda *parts: F.pmod(F.xxhash64("side", "key", *parts), F.lit(shards)).cast("string")
    plain = F.col("cuts").isNull()
    cut = lambda size: F.coalesce(F.try_element_at("cuts", size), F.lit(1))

    def place(size, part):
        return F.when(cut(size) > 1, named("key", size.cast("string"), part.cast("string"))).otherwise(named(bucket(size)))

    own = place(F.col("size"), F.pmod(F.xxhash64("word"), cut(F.col("size"))))
    sizes = F.sequence(F.col("size") - 1, F.col("size") + 1)
    others = F.flatten(F.transform(sizes, lambda m: F.transform(F.sequence(F.lit(0), cut(m) - 1), lambda p: place(m, p))))
    index = known.select(F.when(plain, named(bucket())).otherwise(own).alias("shard"), "side", "word", "n", F.lit(True).alias("indexed"))
    asked = known.select(
        F.explode(F.when(plain, F.array(named(bucket()))).otherwise(F.array_distinct(others))).alias("shard"),
        "side",
        "word",
        "n",
        F.lit(False).alias("indexed"),
    )
    return index.unionByName(asked)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of all words (word, n; distinct) that are one edit apart, each pair from both words."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        index, queries = rows[rows["indexed"]], rows[~rows["indexed"]]
        left, right = [], []
        if len(index) and len(queries):
            left, right = near_words(index["word"].tolist(), queries["word"].tolist(), rows["side"].iloc[0] == "h")
        n, near_n = dict(zip(queries["word"], queries["n"], strict=True)), dict(zip(index["word"], index["n"], strict=True))
        counts = [np.array([table[w] for w in words], np.int64) for table, words in ((n, left), (near_n, right))]
        # Columns of a stated kind, also where nothing was found.
        texts = [np.array(words, object) for words in (left, right)]
        return pd.DataFrame({"word": texts[0], "n": counts[0], "near": texts[1], "near_n": counts[1]})

    return _dealt(words).groupBy("shard").applyInPandas(search, "word string, n long, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) of a word end; each round follows links twice as far.

    A form is several times as frequent as its word, so links never turn back.
    """
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("later"))
        step = now.join(onward, "root", "left")
        step = stored(step.select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("moved")), "roots")
        now = step.drop("moved")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the corpus."""
    words = stored(vocabulary(docs), "vocabulary")
    # The most frequent near word, the smallest one among equals.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = stored(near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best), "near")
    is_form = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    formed = words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "formed")
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
