"""Language-model scores from a probabilistic suffix tree.

The model has two alphabets. Over words, the root gives each word its smoothed
frequency, as the base score does. A context is the last 1 to ``max_words`` words.
It becomes a state if it was seen twice or more, the context shorter by its first
word is a state, and it passes a divergence test from that one (from the root, for
one word) that leaves each occurrence out in turn, so that chance pairs do not
count. No context is too frequent or too rare for the test. A state lists the words
that followed it twice or more and passes the rest of its probability to the next
shorter one. A new word gets its share from the root in part
as one of as many equally likely ones as are known (the base score's convention)
and in part by its spelling, from a tree over bytes that learns from the
distinct words, since new words resemble those and not the most frequent ones.

That tree's symbols are the bytes of a word, the blank after it, and the end of
the text in place of a word. A context is the last 0 to ``depth`` symbols, back
to the blank before the word. A context becomes a state of the
tree if it makes up at least ``min_share`` of all symbols and passes the
divergence test: n times its Kullback-Leibler divergence from the next shorter
context must exceed half its number of different next symbols times ln n, what
the state costs to describe. Shorter contexts of a state stay states. A state's
distribution gives each next symbol n(s, x) / (n(s) + t(s)) and passes the rest
(t(s): different next symbols) to the next shorter state, down to one pseudo
count for each of 257 symbols. Scores use the longest state that is a suffix.

Texts become rows of word numbers, local to a chunk of bounded vocabulary, once.
What is shuffled after that are a chunk's distinct words as digests with counts,
chunks as a whole, compressed, and for each length of contexts a chunk's distinct
pairs of a context and the next word, as digests, dealt by context; those of very
frequent contexts are dealt by both, and the parts of their test are summed. Each
chunk gets the totals of its own pairs back, in their order, never a whole list.
At most depth / min_share byte states can
exist, whatever the input, and the listed next symbols are bounded likewise;
that bounded tree is what the tasks receive.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ordermill.llm.common import id_and_text, id_remainder, signed, slices, trim, utf8
from ordermill.sources.shared import Scratch, settle_and_free, shuffles_freed

DEPTH = 7
MIN_SHARE = 1e-5
#: Next symbols rarer than this part of ``min_share`` are left to shorter states.
LISTED = 1 / 16
SYMBOLS = 257
BLANK, END = b" ", b"\n"
#: Words of the longest context.
MAX_WORDS = 2
#: Contexts seen so often have their next words dealt to several groups.
HOT = 1 << 21
#: The test's expected probabilities travel in so many steps for a factor e.
STEPS = 64
#: Training tokens for each group that counts contexts.
BUCKET_TOKENS = 2_000_000
#: Part of a new word's share that follows its spelling.
SPELLED = 0.2
CHUNK_WORDS = 400_000
CHUNK_TOKENS = 2_000_000


def _pressed(values: np.ndarray) -> bytes:
    """Non-negative integers, byte plane by byte plane, compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = max(1, 8 - next((i for i, p in enumerate(planes[::-1]) if p.any()), 7))
    return bytes([used]) + zstandard.compress(planes[:used].tobytes(), 1)


def _values(pressed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(pressed[1:]), dtype=np.uint8).reshape(pressed[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<i8").ravel()


def _numbered(docs: DataFrame, held_divisor: int, held_remainder: int) -> DataFrame:
    """Texts as word numbers, and per chunk the words with their training counts.

    A row with ``words`` holds a chunk's vocabulary (blank between words) and
    its counts in ``numbers``; the others are texts with their words' numbers. A
    chunk ends with its input partition or when its vocabulary is full.
    """
    rows = id_and_text(docs).withColumn("held_out", id_remainder(held_divisor) == held_remainder)
    schema = pa.schema([
        ("chunk", pa.int64()), ("words", pa.binary()), ("doc_id", pa.int64()),
        ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("numbers", pa.binary())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        trained = np.zeros(0, dtype=np.int64)
        tokens = 0

        def vocabulary() -> pa.RecordBatch:
            words = zstandard.compress(BLANK.join(numbers), 1)
            counts = _pressed(np.pad(trained, (0, len(numbers) - len(trained))))
            return _batch(schema, 1, chunk=[chunk], words=[words], numbers=[counts])

        for batch in slices(parts, "text", 4 << 20):
            held = batch.column("held_out").to_pylist()
            lists = [
                np.array([*map(numbers.__getitem__, t.lower().split()), numbers[END]])
                for t in utf8(batch.column("text"))
            ]
            seen = [ids for ids, h in zip(lists, held) if not h]
            if seen:
                more = np.bincount(np.concatenate(seen), minlength=len(trained))
                more[: len(trained)] += trained
                trained = more
            yield _batch(schema, len(lists), chunk=[chunk] * len(lists),
                         doc_id=batch.column("doc_id"), held_out=batch.column("held_out"),
                         n_tokens=[len(x) for x in lists], numbers=[_pressed(x) for x in lists])
            tokens += sum(map(len, lists))
            if len(numbers) >= CHUNK_WORDS or tokens >= CHUNK_TOKENS:
                yield vocabulary()
                chunk, tokens = chunk + 1, 0
                numbers = defaultdict(count().__next__)
                trained = np.zeros(0, dtype=np.int64)
        if numbers:
            yield vocabulary()

    return rows.mapInArrow(
        batches,
        "chunk long, words binary, doc_id long, held_out boolean, n_tokens long, numbers binary")


def _batch(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(size, field.type))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _words(pressed: bytes) -> list[bytes]:
    return zstandard.decompress(pressed).split(BLANK)


def _keys(words: list[bytes]) -> np.ndarray:
    """64-bit digests of words; what the corpus-wide counts are grouped by."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _word_counts(numbered: DataFrame) -> DataFrame:
    """(chunk, numbers, counts, first, tokens, kinds): every chunk's words with their
    counts in all training texts, in blocks. ``first`` marks one chunk per word.
    """

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                keys, n = _keys(_words(row["words"])), _values(row["numbers"])
                for at in range(0, len(keys), 100_000):
                    some = slice(at, at + 100_000)
                    size = len(keys[some])
                    yield pa.record_batch(
                        [np.full(size, row["chunk"]), np.arange(at, at + size, dtype=np.int32),
                         keys[some], n[some]],
                        names=["chunk", "number", "key", "n"])

    def blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not batch.num_rows:
                continue
            chunk, number, c = (batch.column(x).to_numpy() for x in ("chunk", "number", "c"))
            first = batch.column("first").to_numpy(zero_copy_only=False)
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.diff(chunk[order])) + 1
            out = [
                (int(chunk[p[0]]), _pressed(number[p]), _pressed(c[p]), _pressed(first[p]),
                 int(c[p][first[p]].sum()), int((c[p][first[p]] > 0).sum()))
                for p in np.split(order, cuts)
            ]
            kinds = (pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(v, t) for v, t in zip(zip(*out), kinds)],
                names=["chunk", "numbers", "counts", "first", "tokens", "kinds"])

    words = numbered.filter("words IS NOT NULL").select("chunk", "words", "numbers").mapInArrow(
        each, "chunk long, number int, key long, n long")
    same = Window.partitionBy("key")
    return words.select(
        "chunk", "number", F.sum("n").over(same).alias("c"),
        (F.row_number().over(same.orderBy("chunk")) == 1).alias("first"),
    ).mapInArrow(
        blocks,
        "chunk long, numbers binary, counts binary, first binary, tokens long, kinds long")


class _Chunk:
    """One chunk: its words, their counts and its texts."""

    def __init__(self, numbered: pa.Table, counts: pa.Table) -> None:
        vocabulary = numbered.filter(numbered.column("words").is_valid())
        self.texts = numbered.filter(numbered.column("words").is_null())
        self.words = [w for v in vocabulary.column("words").to_pylist() for w in _words(v)]
        self.keys = _keys(self.words)
        self.c = np.zeros(len(self.words), dtype=np.int64)
        self.first = np.zeros(len(self.words), dtype=bool)
        for block in counts.to_pylist():
            number = _values(block["numbers"])
            self.c[number] = _values(block["counts"])
            self.first[number] = _values(block["first"]).astype(bool)

    def lists(self) -> list[np.ndarray]:
        return [_values(b) for b in self.texts.column("numbers").to_pylist()]


def _grams(words: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, context length, word) of every symbol of the words, blank included.

    The gram holds the symbol in its lowest byte and the context above it, the
    nearest symbol lowest. A context starts at the blank before the word.
    """
    spelled = [BLANK + w + (b"" if w == END else BLANK) for w in words]
    data = np.frombuffer(b"".join(spelled), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(w) for w in spelled], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    gram = data.copy()
    for k in range(1, depth + 1):
        inside = place >= k
        gram[inside] |= data[np.flatnonzero(inside) - k] << np.uint64(8 * k)
    symbol = place > 0
    return gram[symbol], np.minimum(place[symbol], depth), word[symbol]


def gram_counts(grams: DataFrame) -> DataFrame:
    """(length, context, symbol, n) for all context lengths of ``grams`` (gram, size, n)."""
    whole = grams.groupBy("gram", "size").agg(F.sum("n").alias("n"))
    lengths = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size")))
    mask = F.expr("shiftleft(1L, cast(8 * length as int)) - 1")
    each = whole.select("gram", "n", lengths.alias("length"))
    return (
        each.select(
            F.col("length").cast("int").alias("length"),
            F.shiftrightunsigned("gram", 8).bitwiseAND(mask).alias("context"),
            F.col("gram").bitwiseAND(F.lit(255)).cast("int").alias("symbol"),
            "n",
        )
        .groupBy("length", "context", "symbol")
        .agg(F.sum("n").alias("n"))
    )


@dataclass
class Tree:
    """States by (length, context) and their listed symbols, sorted for lookup.

    ``states[d]`` are the contexts of length d, ``rest[d]`` the log10 of what
    each passes on; ``grams[d]`` are contexts with a symbol, ``logs[d]`` the
    log10 of the symbol's whole probability there.
    """

    states: list[np.ndarray]
    rest: list[np.ndarray]
    grams: list[np.ndarray]
    logs: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.states) - 1

    def symbols(self, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol after its context."""
        out = np.zeros(len(grams))
        open_ = np.ones(len(grams), dtype=bool)
        for d in range(self.depth, -1, -1):
            todo = np.flatnonzero(open_ & (sizes >= d))
            if not len(todo):
                continue
            gram = grams[todo] & np.uint64((1 << (8 * d + 8)) - 1)
            at, found = _find(self.grams[d], gram)
            out[todo[found]] += self.logs[d][at[found]]
            open_[todo[found]] = False
            missed = todo[~found]
            at, state = _find(self.states[d], gram[~found] >> np.uint64(8))
            out[missed[state]] += self.rest[d][at[state]]
        out[open_] -= np.log10(SYMBOLS)
        return out

    def words(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word, blank or end of text included."""
        out = np.zeros(len(words))
        for low in range(0, len(words), 20_000):  # Parts only bound the memory.
            some = words[low : low + 20_000]
            gram, size, word = _grams(some, self.depth)
            distinct, first, back = np.unique(gram, return_index=True, return_inverse=True)
            logs = self.symbols(distinct, size[first])
            out[low : low + len(some)] = np.bincount(word, weights=logs[back], minlength=len(some))
        return out


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _tested(
    counts: DataFrame, min_share: float, scratch: Scratch
) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Contexts that pass the test, and frequent contexts' symbols with their counts."""
    counts = scratch.settle(counts, "tree-counts")
    total = counts.filter("length = 0").agg(F.sum("n")).first()[0] or 0
    frequent = (
        counts.groupBy("length", "context")
        .agg(F.sum("n").alias("of"), F.count(F.lit(1)).alias("kinds"))
        .filter(F.col("of") >= min_share * total)
    )
    entries = scratch.settle(counts.join(frequent, ["length", "context"]), "tree-entries")
    mask = F.expr("shiftleft(1L, 8 * length - 8) - 1")
    longer = entries.filter("length > 0").select(
        "*", (F.col("length") - 1).alias("length_"), F.col("context").bitwiseAND(mask).alias("context_"))
    shorter = entries.select(
        F.col("length").alias("length_"), F.col("context").alias("context_"), "symbol",
        (F.col("n") / F.col("of")).alias("expected"))
    tested = (
        longer.join(shorter, ["length_", "context_", "symbol"])
        .groupBy("length", "context", "of", "kinds")
        .agg(F.sum(F.col("n") * F.log(F.col("n") / F.col("of") / F.col("expected"))).alias("gain"))
        .filter(F.col("gain") > 0.5 * F.col("kinds") * F.log(F.col("of").cast("double")))
    )
    listed = entries.filter(F.col("n") >= LISTED * min_share * total)
    return tested.select("length", "context").toPandas(), listed.toPandas()


def build_tree(
    counts: DataFrame, depth: int = DEPTH, min_share: float = MIN_SHARE
) -> Tree:
    """The tree for the counts of ``gram_counts``.

    Contexts are tested in Spark. At most depth / min_share of them and their
    listed symbols come to the driver. All else is dropped again.
    """
    spark = counts.sparkSession
    with Scratch(spark) as scratch, shuffles_freed(spark):
        kept, listed = _tested(counts, min_share, scratch)
    states = [np.zeros(0, dtype=np.uint64) for _ in range(depth + 1)]
    for d in range(depth, 0, -1):
        own = kept.loc[kept.length == d, "context"].to_numpy().astype(np.int64).view(np.uint64)
        if d < depth:  # shorter contexts of states are states
            own = np.concatenate([own, states[d + 1] & np.uint64((1 << (8 * d)) - 1)])
        states[d] = np.unique(own)
    states[0] = np.zeros(1, dtype=np.uint64)

    tree = Tree(states, [], [], [])
    for d in range(depth + 1):
        rows = listed[listed.length == d]
        context = rows.context.to_numpy().astype(np.int64).view(np.uint64)
        at, known = _find(states[d], context)
        at, context, rows = at[known], context[known], rows[known]
        share = rows.n.to_numpy() / (rows.of.to_numpy() + rows.kinds.to_numpy())
        rest = 1 - np.bincount(at, weights=share, minlength=len(states[d]))
        gram = context << np.uint64(8) | rows.symbol.to_numpy().astype(np.uint64)
        rest = np.maximum(rest, 1e-12)
        # The next shorter state's share of the symbol, from the levels built so far.
        shorter_share = np.full(len(gram), 1 / SYMBOLS)
        if d:
            cut = gram & np.uint64((1 << (8 * d)) - 1)
            shorter_share = 10 ** tree_symbols(tree, cut, d - 1)
        order = np.argsort(gram)
        tree.grams.append(gram[order])
        tree.logs.append(np.log10(share + rest[at] * shorter_share)[order])
        tree.rest.append(np.log10(rest))
    return tree


def tree_symbols(tree: Tree, grams: np.ndarray, depth: int) -> np.ndarray:
    """As ``Tree.symbols`` with the levels up to ``depth``."""
    part = Tree(tree.states[: depth + 1], tree.rest, tree.grams, tree.logs)
    return part.symbols(grams, np.full(len(grams), depth))


def _spelled(depth: int):
    """Per chunk the spelling of the words that it is the first to hold: (gram, size, n)."""

    def of(numbered: pa.Table, counts: pa.Table) -> pa.Table:
        chunk = _Chunk(numbered, counts)
        known = [w for w, f, k in zip(chunk.words, chunk.first, chunk.c) if f and k]
        gram, size, _ = _grams(known, depth)
        gram, at, n = np.unique(gram, return_index=True, return_counts=True)
        return pa.table({"gram": signed(gram), "size": size[at], "n": n.astype(np.int64)})

    return of


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit digests of pairs of digests."""
    x = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Dealt:
    """How pairs of a context and the next word are dealt: by context, but those of a
    context seen ``hot`` times or more by both, to buckets from ``buckets`` on.
    """

    buckets: int
    hot: int

    def of(self, context: np.ndarray, seen: np.ndarray, word: np.ndarray) -> np.ndarray:
        many = np.flatnonzero(seen >= self.hot)
        salt = np.zeros(len(context), dtype=np.uint64)
        salt[many] = word[many] % (seen[many] // self.hot + 1).astype(np.uint64)
        bucket = (_mixed(context, salt) % np.uint64(self.buckets)).astype(np.int64)
        bucket[many] += self.buckets
        # Short numbers are sorted faster.
        return bucket.astype(np.min_scalar_type(2 * self.buckets))


def _sorted_pairs(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """high << 32 | low of non-negative numbers, rising, and where each stood."""
    bits, places = (int(x).bit_length() for x in (low.max(initial=0), len(low)))
    pair = high.astype(np.int64)
    if int(pair.max(initial=0)).bit_length() + bits + places > 63:
        pair = pair << 32 | low
        order = np.argsort(pair, kind="stable")
        return pair[order], order
    # With the place in its lowest bits a number is sorted alone, which is faster.
    pair <<= bits
    pair |= low
    pair <<= places
    pair |= np.arange(len(low), dtype=np.int32)
    pair.sort()
    order = (pair & (1 << places) - 1).astype(np.int32)
    pair >>= places
    low = pair & (1 << bits) - 1
    pair >>= bits
    pair <<= 32
    pair |= low
    return pair, order


class Walk:
    """All places of a chunk's texts, with the probability of the word at each.

    It starts with the words' probabilities at the root. ``learn`` goes on to contexts
    of one more word: ``context`` numbers the one before each place (-1: none to be
    looked at), ``seen`` is how often it occurs in training texts.
    """

    def __init__(self, chunk: _Chunk, root: np.ndarray) -> None:
        lists = chunk.lists()
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.word = np.concatenate([np.zeros(0, dtype=np.int32), *lists], dtype=np.int32)
        del lists
        held = np.array(chunk.texts.column("held_out").to_pylist(), dtype=bool)
        self.train = np.repeat(~held, sizes)
        self.p = root[self.word]
        self.keys = chunk.keys.view(np.uint64)
        self.seen, self.digest = chunk.c, self.keys
        self.context = np.full(len(self.word), -1, dtype=np.int32)
        self.context[1:] = self.word[:-1]
        self.context[self.starts] = -1

    def _pair(self) -> None:
        """Number the different pairs of a context and the next word, by context."""
        at = np.flatnonzero(self.context >= 0)
        self.at = at = at[self.seen[self.context[at]] > 1].astype(np.int32)
        pair, order = _sorted_pairs(self.context[at], self.word[at])
        new = np.diff(pair, prepend=-1) != 0
        self.which = np.empty(len(pair), dtype=np.int32)
        self.which[order] = np.cumsum(new, dtype=np.int32) - 1
        pair = pair[new]
        self.before, self.after = pair >> 32, pair & 0xFFFFFFFF

    def dealt(self, dealt: Dealt) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(bucket, pairs, contexts, pairs of each context) for all pairs, by bucket."""
        bucket = dealt.of(self.digest[self.before], self.seen[self.before], self.keys[self.after])
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(bucket[order][1:] != bucket[order][:-1]) + 1
        for part in np.split(order, cuts) if len(order) else []:
            before = self.before[part]
            new = np.flatnonzero(np.diff(before, prepend=-1))
            yield int(bucket[part[0]]), part, before[new], np.diff(new, append=len(part))

    def sent(self, chunk: int, dealt: Dealt) -> pa.Table:
        """What the chunk counts: a row per bucket."""
        self._pair()
        n = np.bincount(self.which[self.train[self.at]], minlength=len(self.before))
        p = np.ones(len(self.before))
        p[self.which] = self.p[self.at]
        p = np.where(n > 0, np.round(np.log(p) * -STEPS), 0).astype(np.int64)
        out = [
            (chunk, bucket, self.digest[contexts].tobytes(), _pressed(sizes),
             _short(self.keys[self.after[part]]).astype("<u4").tobytes(), _pressed(n[part]), _pressed(p[part]))
            for bucket, part, contexts, sizes in self.dealt(dealt)]
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 5)
        return pa.table([pa.array(v, t) for v, t in zip(zip(*out) if out else [()] * 7, kinds)],
                        names=["chunk", "bucket", "contexts", "sizes", "words", "n", "p"])

    def learn(self, answers: list[dict], hot: tuple[np.ndarray, ...], dealt: Dealt) -> None:
        """Take the states of this length in, with the ``answers`` to what was sent."""
        self._pair()
        told = {a["bucket"]: a for a in answers}
        total = np.zeros(len(self.before), dtype=np.int64)
        whole = np.zeros(len(self.seen), dtype=np.int64)
        left = np.zeros(len(self.seen), dtype=np.int64)
        for bucket, part, contexts, _ in self.dealt(dealt):
            total[part] = _values(told[bucket]["totals"])
            if bucket < dealt.buckets:
                whole[contexts], left[contexts] = (_values(told[bucket][c]) for c in ("whole", "rest"))
            else:
                at, known = _find(hot[0], self.digest[contexts])
                whole[contexts[known]], left[contexts[known]] = hot[1][at[known]], hot[2][at[known]]
        context = self.context[self.at]
        state = whole[context] > 0
        at, which, context = self.at[state], self.which[state], context[state]
        listed = np.where(total[which] > 1, total[which], 0)
        self.p[at] = (listed + left[context] * self.p[at]) / whole[context]
        # A longer context is a state's with the word before it: the pair at the place before.
        pairs = np.full(len(self.word) + 1, -1, dtype=np.int32)
        pairs[self.at + 1] = self.which
        pairs[self.starts] = -1
        self.context[:] = -1
        self.context[at] = pairs[at]
        self.seen, self.digest = total, _mixed(self.digest[self.before], self.keys[self.after])
        del self.at, self.which, self.before, self.after


def _short(keys: np.ndarray) -> np.ndarray:
    """32 bits, which tell a word apart among those that follow one context."""
    return keys & np.uint64(0xFFFFFFFF)


def _gain(n: np.ndarray, p: np.ndarray, t: np.ndarray) -> np.ndarray:
    """What pairs gain over the next shorter context, but for their context's total.

    Each occurrence is predicted from the others: n - 1 of of - 1 times, with t
    (different next words) pseudo counts shared as in the next shorter context.
    """
    return n * np.log((n - 1) / p + t)


def _merged(dealt: Dealt):
    """Per bucket: all chunks' pairs counted, contexts tested, an answer per chunk.

    Of hot contexts, which other buckets share, the parts of their test.
    """

    def of(key: tuple, rows: pa.Table) -> pa.Table:
        is_hot = key[0].as_py() >= dealt.buckets
        rows = rows.select(["chunk", "contexts", "sizes", "words", "n", "p"]).to_pylist()
        lists = [np.frombuffer(r["contexts"], dtype=np.uint64) for r in rows]
        context, place = np.unique(np.concatenate(lists), return_inverse=True)
        places = np.split(place, np.cumsum([len(x) for x in lists])[:-1])
        owner = np.concatenate([np.repeat(x, _values(r["sizes"])) for x, r in zip(places, rows)])
        words = np.concatenate([np.frombuffer(r["words"], dtype="<u4") for r in rows])
        ends = np.cumsum([len(r["words"]) // 4 for r in rows])[:-1]
        pair, which = np.unique(owner << 32 | words, return_inverse=True)
        own, steps = (np.concatenate([_values(r[c]) for r in rows]) for c in ("n", "p"))
        p = np.ones(len(pair))
        p[which[own > 0]] = np.exp(steps[own > 0] / -STEPS)
        n = np.bincount(which, own).astype(np.int64)
        owner = pair >> 32
        size = len(context)
        t, single = (np.bincount(owner[x], minlength=size) for x in (n > 0, n == 1))
        seen = np.bincount(owner, n, size).astype(np.int64)
        totals = [_pressed(x) for x in np.split(n[which], ends)]
        columns: dict[str, list] = {"chunk": [r["chunk"] for r in rows], "bucket": [key[0].as_py()] * len(rows),
                                    "totals": totals}
        if is_hot:
            parts = [np.flatnonzero((owner == i) & (n > 0)) for i in range(size)]
            columns |= {
                "context": signed(context).tolist(), "t": t.tolist(), "single": single.tolist(),
                "seen": seen.tolist(), "n": [n[x].tobytes() for x in parts], "p": [p[x].tobytes() for x in parts]}
            # Answers first, then the contexts.
            for c, v in columns.items():
                none = [None] * size if c in ("chunk", "bucket", "totals") else [None] * len(rows)
                columns[c] = v + none if c in ("chunk", "bucket", "totals") else none + v
        else:
            some = n > 0
            gain = np.bincount(owner[some], _gain(n[some], p[some], t[owner[some]]), size)
            state = gain > seen * np.log(np.maximum(seen - 1 + t, 1))
            whole = np.where(state, seen + t, 0)
            columns |= {"whole": [_pressed(whole[x]) for x in places],
                        "rest": [_pressed((t + single)[x]) for x in places]}
        return pa.table([
            pa.array(columns.get(f.name, [None] * len(columns["chunk"])), f.type) for f in ANSWER], schema=ANSWER)

    return of


#: Answers (totals, whole, rest: see ``Walk``) and parts of hot contexts' tests.
ANSWER = pa.schema([
    ("chunk", pa.int64()), ("bucket", pa.int64()), ("totals", pa.binary()), ("whole", pa.binary()),
    ("rest", pa.binary()), ("context", pa.int64()), ("t", pa.int64()), ("single", pa.int64()),
    ("seen", pa.int64()), ("n", pa.binary()), ("p", pa.binary())])
_ANSWER = ("chunk long, bucket long, totals binary, whole binary, rest binary, context long, t long, "
           "single long, seen long, n binary, p binary")


def _hot_states(answers: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, whole, rest) of the hot contexts that are states; few, as each takes ``hot`` tokens."""
    parts = answers.filter("context IS NOT NULL").drop("chunk", "bucket", "totals", "whole", "rest")
    sums = parts.groupBy("context").agg(*[F.sum(c).alias(f"all_{c}") for c in ("t", "single", "seen")])

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.record_batch(
                [batch.column("context"), pa.array([
                    float(_gain(np.frombuffer(r["n"], np.int64), np.frombuffer(r["p"]), r["all_t"]).sum())
                    for r in rows], pa.float64())], names=["context", "gain"])

    gain = parts.join(sums, "context").select("context", "n", "p", "all_t").mapInArrow(
        gains, "context long, gain double").groupBy("context").agg(F.sum("gain").alias("gain"))
    told = gain.join(sums, "context").filter(
        F.col("gain") > F.col("all_seen") * F.log(F.col("all_seen") - 1 + F.col("all_t"))).toPandas()
    context = told.context.to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(context)
    t, single, seen = (told[f"all_{c}"].to_numpy().astype(np.int64)[order] for c in ("t", "single", "seen"))
    return context[order], seen + t, t + single


def score(
    docs: DataFrame,
    held_divisor: int = 7,
    held_remainder: int = 2,
    depth: int = DEPTH,
    min_share: float = MIN_SHARE,
    max_words: int = MAX_WORDS,
    hot: int = HOT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Held-out rows, by the crc32 of the id, are scored but not learnt from.
    ``base_score`` is the sum of the tokens' smoothed log10 frequencies and
    ``score`` the model's log10 probability of the text. Null and empty texts
    hold one token, the end. Repeated rows and null ids are rows like any
    other. Without any training row all words are new. Contexts have up to
    ``max_words`` words. Runs jobs: numbered texts, word counts and states go to the
    shared folder.
    """
    spark = docs.sparkSession
    numbered = settle_and_free(_numbered(docs, held_divisor, held_remainder), "lm-numbered")
    counts = settle_and_free(_word_counts(numbered), "lm-counts")
    with shuffles_freed(spark):
        sums = counts.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    tokens, kinds = sums.tokens or 0, sums.kinds or 0
    blocks = counts.select("chunk", "numbers", "counts", "first")

    # Numbers of chunks' words in all texts, and what is learnt, chunk by chunk.
    vocabulary = numbered.filter("words IS NOT NULL")
    tree = build_tree(
        gram_counts(vocabulary.groupBy("chunk").cogroup(blocks.groupBy("chunk")).applyInArrow(
            _spelled(depth), "gram long, size long, n long")), depth, min_share)
    shared = spark.sparkContext.broadcast(tree)
    dealt = Dealt(tokens // BUCKET_TOKENS + 1, hot)
    none = F.lit(None)
    answered = [none.cast(t).alias(c) for c, t in (
        ("level", "int"), ("bucket", "long"), ("totals", "binary"), ("whole", "binary"), ("rest", "binary"))]
    about = blocks.select("*", *answered)
    hots: list[tuple[np.ndarray, ...]] = []

    def walked(numbered: pa.Table, about: pa.Table, spelled: bool) -> tuple[_Chunk, Walk]:
        """The chunk, and its places after all levels that are answered."""
        is_answer = about.column("level").is_valid()
        chunk = _Chunk(
            numbered, about.filter(pa.compute.invert(is_answer)).select(["numbers", "counts", "first"]))
        root = chunk.c + 1.0
        new = np.flatnonzero(chunk.c == 0)
        if len(new) and spelled:
            root[new] = 1 - SPELLED + SPELLED * (kinds + 1) * 10 ** shared.value.words(
                [chunk.words[i] for i in new])
        walk = Walk(chunk, root / (tokens + kinds + 1))
        # What the places are made from is not needed beside them.
        del root, new
        chunk.words = []
        trim()
        answers = about.filter(is_answer).select(["level", "bucket", "totals", "whole", "rest"]).to_pylist()
        for level, states in enumerate(hots):
            walk.learn([a for a in answers if a["level"] == level], states, dealt)
            trim()
        return chunk, walk

    def sent(key: tuple, numbered: pa.Table, about: pa.Table) -> pa.Table:
        out = walked(numbered, about, False)[1].sent(key[0].as_py(), dealt)
        trim()
        return out

    for level in range(max_words):
        pairs = numbered.groupBy("chunk").cogroup(about.groupBy("chunk")).applyInArrow(
            sent, "chunk long, bucket long, contexts binary, sizes binary, words binary, n binary, p binary")
        answers = settle_and_free(
            pairs.groupBy("bucket").applyInArrow(_merged(dealt), _ANSWER), f"lm-states-{level + 1}")
        about = about.unionByName(answers.filter("chunk IS NOT NULL").select(
            "chunk", *[none.cast("binary").alias(c) for c in ("numbers", "counts", "first")],
            F.lit(level).alias("level"), "bucket", "totals", "whole", "rest"))
        with shuffles_freed(spark):
            hots.append(_hot_states(answers))

    def sums_of(numbered: pa.Table, about: pa.Table) -> pa.Table:
        chunk, walk = walked(numbered, about, True)
        del walk.context, walk.seen, walk.digest, walk.keys, walk.train
        trim()
        base = np.log10((chunk.c + 1) / (tokens + kinds + 1))
        known, base_score, score = (
            np.add.reduceat(x, walk.starts) if len(walk.starts) else x
            for x in ((chunk.c > 0).astype(np.int64)[walk.word], base[walk.word], np.log10(walk.p)))
        out = pa.table({
            "doc_id": chunk.texts.column("doc_id"),
            "held_out": chunk.texts.column("held_out"),
            "n_tokens": chunk.texts.column("n_tokens"),
            "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array([tokens] * len(known), pa.int64()),
            "base_score": pa.array(base_score, pa.float64()),
            "score": pa.array(score, pa.float64()),
        })
        del chunk, walk
        trim()
        return out

    return numbered.groupBy("chunk").cogroup(about.groupBy("chunk")).applyInArrow(
        sums_of,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
