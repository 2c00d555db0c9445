"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages of ``width`` words, and of half as many and so on
down to the length of the shortest item; for items so long that no passage in them
could reach the cosine, also of twice as many and so on. TF-IDF weights come from the documents'
own word frequencies, for all words. All passages of all documents are weighed;
none is left out. Words in few documents are too many to send everywhere: they
weigh as little as they can at first, so that cosines are bounds from above, and
the matches' cosines are made exact by a join with these words' frequencies.

Over all passages and the items, a randomised singular value decomposition gives
a latent space: a random start, multiplied by the passages' Gram matrix in Spark
and made orthonormal, a few times. All passages are compared with all items
there: items whose cosine, with the passage's whole norm, reaches ``min_cosine``
but for the decomposition's error are candidates. Each is checked in the text
around the passage: the longest common subsequence of words must cover the item,
or most of it and its answer, the item's last sentence; and the cosine of the
plain vectors must reach ``min_cosine``.

Passages overlap, so nothing is done passage by passage: a text is stored once, in
stretches, with its passages' norms, and sums over passages are sums over blocks of
words that they share.

Different item texts are handled in blocks of at most ``block_items`` and
``BLOCK_WORDS`` words, each with a latent space of as many dimensions as items and
a few more, in which items weigh as much as all passages, so no item is lost to
rank. A block's words and vectors are bounded and are broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import MIN_LONG, id_and_text, keyed, slices, trim
from ordermill.sources.shared import settle

WIDTH = 24
STRIDE = 12
MIN_COSINE = 0.25
COVERED, PARTLY, ANSWERED = 0.8, 0.6, 0.8
BLOCK_ITEMS = 256
BLOCK_WORDS = 1 << 16
#: Share of the words needed that an item's most frequent words may give.
FREQUENT = 0.7
#: Different words that a task counts before it passes them on, or keeps numbers of.
HELD_WORDS = 400_000
#: Words in which a stretch's passages start.
STRETCH = 2048
#: Words that are packed together, at least.
PACKED = 1 << 16
#: Side of the square of words in which a task sums up products of passages.
SIDE = 4096
#: Passages whose products are summed in single precision before they are added up.
SUMMED = 1 << 20
#: Passages for each task of these sums, which passes on as much however few it takes.
TAKEN = 1 << 22
#: What the latent space may take from a cosine; items that lose more there are kept whole.
SLACK = 0.01
#: Words in more than this share of the documents are sent to all tasks.
OFTEN = 1 / 1024
#: Pairs of a window and an item that are counted together.
PAIRS = 1024
SPARE = 32
ROUNDS = 1
TERM_ROWS = 256

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?]+(?:\s+|$)")


#: ASCII letters lower-cased, digits as they are, the rest of ASCII as blanks.
_FOLD = "".join(chr(c).lower() if chr(c).isalnum() else " " for c in range(128))
_FOLD_BYTES = _FOLD.encode() + bytes(range(128, 256))
_ASCII = bytes(range(128))


def words_of(text: str) -> list[str]:
    """The runs of letters and digits, lower-cased: ``_WORD``, mostly without the pattern's cost."""
    if text.isascii():
        return text.translate(_FOLD).split()
    text = text.lower()
    whole = text.encode("utf-8", "surrogatepass")
    # For other characters, letters and digits are what the pattern takes.
    if not whole.translate(None, _ASCII).decode("utf-8", "surrogatepass").isalnum():
        return _WORD.findall(text)
    return whole.translate(_FOLD_BYTES).decode().split()


@dataclass
class Item:
    """A benchmark item as numbers of its block's words."""

    item_id: int
    words: list[int]
    answer: list[int]


def _items(rows: list, number: dict[str, int]) -> list[Item]:
    items = []
    for row in rows:
        sentences = [s for s in _SENTENCE.split(row.text) if words_of(s)]
        words = words_of(row.text)
        # One sentence alone: its last third is the answer.
        last = words_of(sentences[-1]) if len(sentences) > 1 else words[len(words) * 2 // 3 :]
        items.append(Item(
            row.item_id, [number[w] for w in words], [number[w] for w in last]))
    return items


def _common(words: list[int], region: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one long integer."""
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(words)) - 1
    row = full
    for mask in filter(None, map(masks.get, region.tolist())):
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
    return len(words) - row.bit_count()


def _digest(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)


def _all_frequencies(texts: DataFrame) -> DataFrame:
    """(word, n): in how many documents each word occurs, words as 64-bit digests."""

    def counted(seen: Counter[str]) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([_digest(w) for w in seen], pa.int64()), pa.array(seen.values(), pa.int64())],
            names=["word", "n"])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in slices(parts, "text", 8 << 20):
            for text in batch.column("text").to_pylist():
                seen.update(set(words_of(text)))
            if len(seen) > HELD_WORDS:
                yield counted(seen)
                seen.clear()
        yield counted(seen)

    return texts.select("text").mapInArrow(batches, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


def _seen(frequencies: DataFrame, number: dict[str, int]) -> np.ndarray:
    """In how many documents each of a block's words occurs."""
    known = frequencies.sparkSession.createDataFrame(
        [(_digest(w), i) for w, i in number.items()], "word long, number int")
    seen = np.zeros(len(number))
    for r in frequencies.join(known, "word").select("number", "n").collect():
        seen[r.number] = r.n
    return seen


def _widths(width: int, shortest: int, least: float = 0) -> list[int]:
    """``width``, halved until a window fits into the shortest item, and doubled up to ``least``."""
    widths = [width]
    while widths[0] < least:
        widths.insert(0, widths[0] * 2)
    while widths[-1] > max(shortest, 1):
        widths.append(widths[-1] // 2)
    return widths


def _steps(starts: np.ndarray, sizes: np.ndarray, step: int | np.ndarray = 1) -> np.ndarray:
    """From each start on as many numbers as its size, ``step`` apart, one after another."""
    ends = np.cumsum(sizes)
    nth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    if np.ndim(step):
        step = np.repeat(step, sizes)
    return np.repeat(starts, sizes) + step * nth


class Places:
    """Where a text may cover an item, by the items' words: lossless, without cosines.

    The search asks it only whether candidates can be covered (``coverable``).

    To cover ``needed`` words of an item, the region around a window (the window
    and as many words as the item has on both sides) must hold so many of them,
    none more often than the item. The item's most frequent words give a share of
    that at most; the rest must come from its other, rare words. So windows are
    taken only where enough rare words lie in one region, and kept if the region's
    words, all counted, can cover the item.
    """

    def __init__(self, items: list[Item], idf: np.ndarray) -> None:
        self.terms = len(idf)
        self.reach = np.array([len(i.words) for i in items])
        self.needed = np.ceil(PARTLY * self.reach - 1e-3).astype(np.int64)
        # Each word's place among the item's different words; all others share the last.
        self.local = np.empty((len(items), self.terms + 1), dtype=np.int32)
        words = [np.unique(item.words, return_counts=True) for item in items]
        self.counts = np.zeros((len(items), max(len(own) for own, _ in words) + 1), dtype=np.int64)
        for i, (own, counts) in enumerate(words):
            self.local[i] = len(own)
            self.local[i, own] = np.arange(len(own))
            self.counts[i, : len(own)] = counts
        frequent = np.floor(FREQUENT * self.needed).astype(np.int64)
        self.rare_needed = self.needed - frequent
        self.fewest = self.rare_needed.min()
        pairs = [
            (word, i) for i, item in enumerate(items)
            for word in set(sorted(item.words, key=lambda w: (idf[w], w))[frequent[i] :])]
        word, owner = np.array(pairs, dtype=np.int64).T
        order = np.argsort(word, kind="stable")
        self.owners = owner[order]
        # Words of no item, -1, are the last entry.
        self.many = np.bincount(word, minlength=self.terms + 1)
        self.first = np.cumsum(self.many) - self.many

    def windows(self, numbers: np.ndarray, widths: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """(start, width) of all windows of a text around which an item may be covered.

        ``numbers`` are the text's words, -1 for words of no item; ``widths`` are
        (width, stride).
        """
        many = self.many[numbers]
        total = int(many.sum())
        if total < self.fewest:
            return []
        place = np.repeat(np.arange(len(numbers)), many)
        start = self.first[numbers] - (np.cumsum(many) - many)
        owner = self.owners[start[place] + np.arange(total)]
        order = np.argsort(owner, kind="stable")
        owner, place = owner[order], place[order]
        # Runs of as many rare words of one item as are needed, by first and last place.
        here = np.arange(len(owner))
        end = here + self.rare_needed[owner] - 1
        here, end = here[end < len(owner)], end[end < len(owner)]
        same = owner[end] == owner[here]
        owner, first, last = owner[here[same]], place[here[same]], place[end[same]]
        # For each width, the starts near a run; then each (width, item, start) once.
        sizes, strides = np.array(widths).T
        reach = self.reach[owner]
        least = np.maximum(last - reach + 1 - sizes[:, None], 0)
        low = least + -least % strides[:, None]
        after = np.maximum(len(numbers) - sizes + strides, 1)
        most = np.minimum(first + reach, after[:, None] - 1)
        near, run = np.nonzero((low <= most) & (last - first < sizes[:, None] + 2 * reach))
        if not len(run):
            return []
        low, step = low[near, run], strides[near]
        many = (most[near, run] - low) // step + 1
        span, items = after.max(), len(self.reach)
        keys = np.repeat((near * items + owner[run]) * span, many) + _steps(low, many, step)
        keys.sort()
        keys = keys[np.flatnonzero(np.concatenate([[1], keys[1:] - keys[:-1]]))]
        kept = set()
        for a in range(0, len(keys), PAIRS):
            key, start = np.divmod(keys[a : a + PAIRS], span)
            near, own = np.divmod(key, items)
            ok = self.coverable(numbers, start, sizes[near], own)
            kept.update(zip(near[ok].tolist(), start[ok].tolist()))
        return [(start, widths[i][0]) for i, start in sorted(kept)]

    def coverable(
        self, numbers: np.ndarray, starts: np.ndarray, width: np.ndarray, owners: np.ndarray,
        first: int | np.ndarray = 0, end: int | np.ndarray | None = None,
    ) -> np.ndarray:
        """Whether the regions around windows at ``starts`` can cover the items ``owners``.

        A window's text goes from ``first`` to ``end`` in ``numbers``.
        """
        reach, most = self.reach[owners], self.counts.shape[1]
        low = np.maximum(starts - reach, first)
        sizes = np.minimum(starts + width + reach, len(numbers) if end is None else end) - low
        row = np.repeat(np.arange(len(starts)), sizes)
        word = numbers.take(_steps(low, sizes))
        word[word < 0] = self.terms
        slot = self.local.take((owners * (self.terms + 1))[row] + word)
        held = np.bincount(row * most + slot, minlength=len(starts) * most).reshape(-1, most)
        return np.minimum(held, self.counts[owners]).sum(axis=1) >= self.needed[owners]


class _Numbers:
    """Numbers of words: a block's own, then others as they are met, with their digests."""

    def __init__(self, number: dict[str, int], idf: np.ndarray) -> None:
        self.numbers = defaultdict(count(len(number)).__next__, number)
        #: By number, the last entry for no word: squared weights, whether a word is in few
        #: documents, and digests of other words.
        self.squares = np.append(idf**2, 0.0)
        self.rare = np.zeros(len(idf) + 1, dtype=bool)
        self.digests = np.zeros(len(idf) + 1, dtype=np.int64)

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))

    def weigh(self, often: dict[int, float], least: float) -> None:
        """Give weights to the words met since the last call."""
        met = len(self.numbers) - (len(self.squares) - 1)
        digests = [*map(_digest, islice(reversed(self.numbers), met))][::-1]
        weights = np.array([often.get(d, 0.0) for d in digests] + [0.0])
        rare = weights == 0
        squares = np.where(rare, least, weights) ** 2
        rare[-1], squares[-1] = False, 0
        self.squares = np.concatenate([self.squares[:-1], squares])
        self.rare = np.concatenate([self.rare[:-1], rare])
        self.digests = np.concatenate([self.digests[:-1], np.array(digests + [0], dtype=np.int64)])


def _counts(left: np.ndarray, starts: np.ndarray, first: np.ndarray, widths: list[tuple[int, int]]) -> np.ndarray:
    """How many windows of each width begin in the first ``starts`` of ``left`` words.

    The last window of a text is the first that reaches its end; where a stretch is its
    text's ``first`` one, there is one window of each width at least.
    """
    sizes, strides = np.array(widths).T
    after = np.maximum(left[:, None] - sizes + strides, first[:, None])
    return np.maximum(-(-np.minimum(after, starts[:, None]) // strides), 0)


def _squares(numbers: np.ndarray, starts: np.ndarray, width: int, squares: np.ndarray) -> np.ndarray:
    """Squared norms of the TF-IDF vectors of windows, by the words' squared weights."""
    own = numbers[starts[:, None] + np.arange(width)]
    own.sort(axis=1)
    own = np.ascontiguousarray(own.T)
    # A word's nth occurrence adds n * n - (n - 1) * (n - 1) = 2 * n - 1 times its square.
    times = np.ones(len(starts))
    total = squares[own[0]]
    for before, word in zip(own, own[1:]):
        times = np.where(word == before, times + 2, 1.0)
        total += squares[word] * times
    return total


def _passages(
    texts: DataFrame, number: dict[str, int], idf: np.ndarray, often, least: float,
    widths: list[tuple[int, int]], reach: int,
) -> DataFrame:
    """(doc_id, text_hash, at, counts, words, squares, others): all passages, by stretches.

    A row has the passages that start in ``STRETCH`` words of a text: ``counts`` of
    each width, from place ``at`` in ``words`` on, a stride apart. ``words`` are the
    word numbers, -1 for others, -2 and less for the entries of ``others``, the
    digests of words in few documents; they go on ``reach`` words before and after
    the passages. ``squares`` are the passages' squared norms, by widths, ``others``
    weighing ``least``.
    """
    shared = texts.sparkSession.sparkContext.broadcast((number, idf))
    sizes, strides = np.array(widths).T
    step = math.lcm(*strides.tolist())
    stretch = -(-STRETCH // step) * step
    margin = int(max(sizes.max(), strides.max()))

    def rows(held: list[tuple], known: _Numbers, terms: int) -> pa.RecordBatch:
        """The stretches of (doc_id, text_hash, numbers)."""
        known.weigh(often.value, least)
        lengths = np.array([len(h[2]) for h in held])
        many = -(-lengths // stretch)
        text = np.repeat(np.arange(len(held)), many)
        start = _steps(np.zeros(len(held), dtype=np.int64), many, stretch)
        counts = _counts(lengths[text] - start, np.full(len(text), stretch), (start == 0).astype(int), widths)
        # Texts one after another, with room for the windows that go beyond their ends.
        base = np.cumsum(lengths + margin) - (lengths + margin)
        numbers = np.full(int((lengths + margin).sum()), -1, dtype=np.int32)
        for at, (_, _, own) in zip(base.tolist(), held):
            numbers[at : at + len(own)] = own
        first = base[text] + start
        squares = [
            _squares(numbers, _steps(first, n, int(stride)), int(size), known.squares)
            for n, size, stride in zip(counts.T, sizes, strides)]
        ends = np.cumsum(counts, axis=0)
        rare = known.rare[numbers]
        nth = np.cumsum(rare)
        digests = known.digests[numbers[rare]]
        coded = np.where(numbers < terms, numbers, -1)
        coded[rare] = -1 - nth[rare]
        out = []
        for r, (t, s) in enumerate(zip(text.tolist(), start.tolist())):
            b = int(base[t])
            low, high = b + max(s - reach, 0), b + min(s + stretch + margin + reach, len(held[t][2]))
            words = coded[low:high].astype("<i4")
            skip = int(nth[low] - rare[low])
            words[words < -1] += skip
            own = [q[e - c : e] for q, e, c in zip(squares, ends[r].tolist(), counts[r].tolist())]
            out.append((
                held[t][0], held[t][1], b + s - low, counts[r].tolist(), words.tobytes(),
                np.concatenate(own).astype("<f8").tobytes(), digests[skip : nth[high - 1]].astype("<i8").tobytes()))
        return pa.record_batch(
            [pa.array(v, t) for v, t in zip(zip(*out), (
                pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()))],
            names=["doc_id", "text_hash", "at", "counts", "words", "squares", "others"])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, idf = shared.value
        known = _Numbers(number, idf)
        for batch in slices(parts, "text", 8 << 20):
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            held, words = [], 0
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = words_of(text)
                if own:
                    held.append((ids[row], hashes[row], known.of(own)))
                    words += len(own)
                if words > PACKED:
                    yield rows(held, known, len(number))
                    held, words = [], 0
                    if len(known.numbers) > HELD_WORDS + len(number):
                        known = _Numbers(number, idf)
            if held:
                yield rows(held, known, len(number))
        trim()

    return texts.mapInArrow(
        batches, "doc_id long, text_hash long, at int, counts array<int>, words binary, squares binary, "
        "others binary")


@dataclass
class _Packed:
    """Stretches whose words are laid out in blocks of ``grain`` words, each at a block's start."""

    rows: list[int]
    grain: int
    #: The blocks' words, one block a row; -1 for words of no item.
    numbers: np.ndarray
    #: For each width: the windows' first blocks, their squared norms, and their stretches.
    first: list[np.ndarray]
    squares: list[np.ndarray]
    owner: list[np.ndarray]
    #: Each stretch's first block.
    base: np.ndarray


def _packed(batch: pa.RecordBatch, widths: list[tuple[int, int]], most: int) -> Iterator[_Packed]:
    """A batch's stretches, as many together as have about ``most`` words."""
    sizes, strides = np.array(widths).T
    grain = math.gcd(*sizes.tolist(), *strides.tolist())
    counts = np.array(batch.column("counts").to_pylist()).reshape(-1, len(widths))
    at, words, squares = (batch.column(c).to_pylist() for c in ("at", "words", "squares"))
    blocks = np.where(counts > 0, (counts - 1) * strides + sizes, 0).max(axis=1) // grain
    part = np.cumsum(blocks * grain) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(cuts, cuts[1:]):
        total = int(blocks[a:b].sum())
        base = np.cumsum(blocks[a:b]) - blocks[a:b]
        numbers = np.full(total * grain, -1, dtype=np.int32)
        for r, low in zip(range(a, b), (base * grain).tolist()):
            own = np.frombuffer(words[r], "<i4")[at[r] : at[r] + int(blocks[r]) * grain]
            numbers[low : low + len(own)] = np.maximum(own, -1)
        norms = np.frombuffer(b"".join(squares[a:b]), "<f8")
        own = counts[a:b]
        # Where each width's windows begin among a stretch's.
        begin = np.cumsum(own, axis=1) - own + (np.cumsum(own.sum(axis=1)) - own.sum(axis=1))[:, None]
        yield _Packed(
            list(range(a, b)), grain, numbers.reshape(total, grain),
            [_steps(base, own[:, i], int(strides[i]) // grain) for i in range(len(widths))],
            [norms[_steps(begin[:, i], own[:, i])] for i in range(len(widths))],
            [np.repeat(np.arange(a, b), own[:, i]) for i in range(len(widths))], base)


class _Products:
    """Sums the products of all pairs of words of the same passages, times ``x``.

    The Gram matrix of passages is summed over pairs of places: a pair counts with the
    reciprocal squared norms of all passages that hold both places, which differ by block
    only. It is held for up to ``SIDE`` different words, then multiplied by their rows of ``x``.
    """

    def __init__(self, x: np.ndarray, idf: np.ndarray, widths: list[tuple[int, int]]) -> None:
        self.x, self.idf, self.widths = x, idf, widths
        self.total = np.zeros_like(x)
        self.local = np.full(len(x), -1)
        self.words, self.seen = np.zeros(0, dtype=np.int64), 0
        self.square = np.zeros((min(SIDE, len(x)),) * 2, dtype=np.float32)

    def add(self, packed: _Packed) -> None:
        held = self._held(packed)
        most = held.shape[1]
        numbers = packed.numbers.reshape(-1)
        blocks = np.flatnonzero(numbers >= 0)
        numbers, blocks = numbers[blocks], blocks // packed.grain
        own = np.unique(numbers)
        new = own[self.local[own] < 0]
        if len(self.words) + len(new) > len(self.square):
            self.flush()
            new = own
            if len(own) > len(self.square):
                self.square = np.zeros((len(own),) * 2, dtype=np.float32)
        self.local[new] = len(self.words) + np.arange(len(new))
        self.words = np.concatenate([self.words, new])
        n, flat, place = len(numbers), self.square.reshape(-1), self.local[numbers]
        row, start, held = place * len(self.square), blocks * most, held.astype(np.float32).reshape(-1)
        for apart in range(n):
            lag = blocks[apart:] - blocks[: n - apart]
            near = np.flatnonzero(lag < most)
            if not len(near):
                break
            value = held[(start[: n - apart] + lag)[near]]
            np.add.at(flat, (row[: n - apart] + place[apart:])[near], value if apart else value / 2)
        self.seen += sum(map(len, packed.first))
        if self.seen > SUMMED:
            self.flush()

    def _held(self, packed: _Packed) -> np.ndarray:
        """For each block and the next ones: sum of 1 / squared norm of the passages with both."""
        most = max(w for w, _ in self.widths) // packed.grain
        total = len(packed.numbers)
        held = np.zeros((total, most))
        for (width, _), first, squares in zip(self.widths, packed.first, packed.squares):
            long = width // packed.grain
            once = np.divide(1, squares, out=np.zeros(len(squares)), where=squares > 0)
            summed = np.concatenate([[0], np.cumsum(np.bincount(first, once, total))])
            here = np.arange(total)
            for lag in range(long):
                held[:, lag] += summed[here + 1] - summed[np.clip(here + lag - long + 1, 0, here + 1)]
        return held

    def flush(self) -> None:
        own, n = self.words, len(self.words)
        square, idf = self.square[:n, :n], self.idf[own, None]
        x = (self.x[own] * idf).astype(np.float32)
        self.total[own] += (square @ x + square.T @ x) * idf
        square[:] = 0
        self.local[own] = -1
        self.words, self.seen = own[:0], 0


def _vector(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, weights) of length one."""
    own, n = np.unique(words, return_counts=True)
    weights = n * idf[own]
    return own, weights / np.linalg.norm(weights)


def _latent(
    passages: DataFrame, items: list[np.ndarray], idf: np.ndarray, widths: list[tuple[int, int]],
    rank: int, rounds: int,
) -> np.ndarray:
    """Right singular vectors (words x rank) of the passages' and items' TF-IDF rows.

    Each item weighs as much as all passages, so the first vectors span the
    items and the others what the passages add.
    """
    spark = passages.sparkSession
    terms = len(idf)
    many = passages.select(F.sum(F.expr("aggregate(counts, 0L, (n, c) -> n + c)"))).first()[0]
    weight = max(many or 0, 1)
    parts = max(spark.sparkContext.defaultParallelism, weight // TAKEN)
    stretches = passages.select("at", "counts", "words", "squares").coalesce(parts)

    def gram(x: np.ndarray) -> np.ndarray:
        """Transposed rows times rows times ``x``, summed over all rows."""
        shared = spark.sparkContext.broadcast(x)

        def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            products = _Products(shared.value, idf, widths)
            for batch in parts:
                for packed in _packed(batch, widths, PACKED if terms <= SIDE else STRETCH):
                    products.add(packed)
            products.flush()
            total = products.total.astype("<f4")
            for low in range(0, terms, TERM_ROWS):
                rows = total[low : low + TERM_ROWS]
                if rows.any():
                    yield pa.record_batch(
                        [pa.array([low], pa.int32()), pa.array([rows.tobytes()], pa.binary())],
                        names=["low", "rows"])
            trim()

        def summed(key: tuple, rows: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(r, "<f4").astype(float) for r in rows.column("rows").to_pylist())
            return pa.table({"low": pa.array([key[0].as_py()], pa.int32()), "rows": [total.tobytes()]})

        out = np.zeros_like(x)
        for row in (
            stretches.mapInArrow(partial, "low int, rows binary")
            .groupBy("low").applyInArrow(summed, "low int, rows binary").collect()
        ):
            part = np.frombuffer(bytes(row.rows)).reshape(-1, x.shape[1])
            out[row.low : row.low + len(part)] += part
        for words in items:
            own, w = _vector(words, idf)
            out[own] += weight * np.outer(w, w @ x[own])
        shared.unpersist()
        return out

    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((terms, rank)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(gram(basis))[0]
    small = basis.T @ gram(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, values > 1e-12 * max(values.max(), 1e-9)]


def _matches(
    passages: DataFrame, items: list[Item], idf: np.ndarray, latent: np.ndarray,
    widths: list[tuple[int, int]], min_cosine: float,
) -> DataFrame:
    """Items found in passages, by cosines in the latent space, then by order of words."""
    plain = [_vector(np.array(item.words), idf) for item in items]
    vectors = np.stack([w @ latent[own] for own, w in plain])
    norms = np.linalg.norm(vectors, axis=1)
    # A passage's inner products with the items there are sums over its words.
    # The last row is for words of no item.
    scores = np.zeros((len(idf) + 1, len(items)), dtype=np.float32)
    scores[:-1] = (latent @ (vectors / np.maximum(norms, 1e-9)[:, None]).T) * idf[:, None]
    # Cosines differ by no more than the part of an item outside the space; where that is
    # too much, the item is compared as it is.
    for i in np.flatnonzero(1 - norms**2 > (0.9 * SLACK) ** 2):
        own, w = plain[i]
        scores[:, i] = 0
        scores[own, i] = w * idf[own]
    shared = passages.sparkSession.sparkContext.broadcast((scores, items, plain, idf, Places(items, idf)))

    def candidates(packed: _Packed, scores: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(stretch, first block in it, width, item) of cosines of ``min_cosine`` and little less."""
        sums = scores[packed.numbers[:, 0]]
        for words in packed.numbers.T[1:]:
            sums += scores[words]
        base = np.zeros(packed.rows[-1] + 1, dtype=np.int64)
        base[packed.rows] = packed.base
        # From each block on, sums of as many blocks as a passage has, the shortest first.
        run, span = sums, 1
        for (width, _), first, squares, owner in reversed(list(zip(
            widths, packed.first, packed.squares, packed.owner
        ))):
            long = width // packed.grain
            if long % span:
                run, span = sums, 1
            wide = run[: len(sums) - long + 1].copy()
            for i in range(span, long, span):
                wide += run[i : i + len(wide)]
            run, span = wide, long
            nth = np.full(len(wide), -1)
            nth[first] = np.arange(len(first))
            least = np.full(len(wide), np.inf, dtype=np.float32)
            least[first] = np.where(squares > 0, (min_cosine - SLACK) * np.sqrt(squares), np.inf)
            block, item = np.divmod(np.flatnonzero(wide >= least[:, None]), scores.shape[1])
            window = nth[block]
            yield owner[window], block - base[owner[window]], np.full(len(window), width), item, squares[window]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, items, plain, idf, places = shared.value
        for batch in parts:
            if not batch.num_rows:
                continue
            found = [
                (row, first * packed.grain, *more) for packed in _packed(batch, widths, PACKED // 4)
                for row, first, *more in candidates(packed, scores)]
            row, start, width, item, squares = (np.concatenate(f) for f in zip(*found))
            ids, hashes, at, words, others = (
                batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "at", "words", "others"))
            texts = {r: np.frombuffer(words[r], "<i4") for r in np.unique(row).tolist()}
            base = np.zeros(batch.num_rows + 1, dtype=np.int64)
            for r, text in texts.items():
                base[r + 1] = len(text)
            base = np.cumsum(base)
            whole = np.concatenate([np.zeros(0, dtype=np.int32), *texts.values()])
            start = start + np.array(at)[row]
            out = []
            for a in range(0, len(row), PAIRS):
                r, i = row[a : a + PAIRS], item[a : a + PAIRS]
                ok = places.coverable(
                    whole, base[r] + start[a : a + PAIRS], width[a : a + PAIRS], i, base[r], base[r + 1])
                for n in (a + np.flatnonzero(ok)).tolist():
                    text, wanted, s, e = texts[int(row[n])], items[item[n]], int(start[n]), int(start[n] + width[n])
                    reach = len(wanted.words)
                    region = text[max(s - reach, 0) : min(e, len(text)) + reach]
                    covered = _common(wanted.words, region) / reach
                    if covered < PARTLY:
                        continue
                    answer = _common(wanted.answer, region) / max(len(wanted.answer), 1)
                    if covered < COVERED and answer < ANSWERED:
                        continue
                    passage = text[s:e]
                    held, times = np.unique(passage[passage >= 0], return_counts=True)
                    own, weights = plain[item[n]]
                    _, x, y = np.intersect1d(held, own, assume_unique=True, return_indices=True)
                    cosine = float((times * idf[held])[x] @ weights[y] / np.sqrt(squares[n]))
                    if cosine < min_cosine - 1e-6:
                        continue
                    digests = np.frombuffer(others[row[n]], "<i8")
                    out.append((ids[row[n]], hashes[row[n]], wanted.item_id, cosine, covered, answer,
                                float(squares[n]), digests[-2 - passage[passage < -1]].tolist()))
            if out:
                kinds = (pa.int64(),) * 3 + (pa.float64(),) * 4 + (pa.list_(pa.int64()),)
                yield pa.record_batch(
                    [pa.array(v, t) for v, t in zip(zip(*out), kinds)],
                    names=["doc_id", "text_hash", "item_id", "cosine", "covered", "answered", "whole", "others"])
        trim()

    return passages.mapInArrow(
        batches,
        "doc_id long, text_hash long, item_id long, cosine double, covered double, answered double, "
        "whole double, others array<long>")


def _exact(found: DataFrame, frequencies: DataFrame, total: int, least: float) -> DataFrame:
    """Matches with their passage's whole norm, words of few documents weighed too."""
    rows = settle(found.withColumn("row", F.expr("uuid()")), "benchmark-matches")
    weight = F.log((1 + F.lit(total)) / (1 + F.col("n"))) + 1
    more = (
        rows.select("row", F.explode("others").alias("word"))
        .groupBy("row", "word").agg(F.count(F.lit(1)).alias("c"))
        .join(frequencies, "word")
        .groupBy("row").agg(
            F.sum(F.col("c") * F.col("c") * (weight * weight - F.lit(least * least))).alias("more"))
    )
    full = F.col("whole") + F.greatest(F.coalesce("more", F.lit(0.0)), F.lit(0.0))
    return rows.join(more, "row", "left").withColumn(
        "cosine", F.col("cosine") * F.sqrt(F.col("whole") / full))


def _blocks(items: DataFrame, block_items: int) -> Iterator[list]:
    """Items with words, in blocks of bounded numbers of items and words, one at a time."""
    block, words = [], 0
    for row in items.orderBy("item_id").toLocalIterator():
        n = len(words_of(row.text))
        if block and (len(block) == block_items or words + n > BLOCK_WORDS):
            yield block
            block, words = [], 0
        if n:
            block.append(row)
            words += n
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    stride: int = STRIDE,
    min_cosine: float = MIN_COSINE,
    block_items: int = BLOCK_ITEMS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, text_hash, item_id, cosine, covered, answered): items found in documents.

    One row per pair of a document and an item it holds; clean documents have
    none. ``covered`` and ``answered`` are the shares of the item's and its
    answer's words found in order. ``benchmark`` has item_id and text; items
    without words are left out, repeated ids count as items of their own. Null
    texts count as empty; rows equal in id and text give one row per item; ids
    may be null. ``text_hash`` is the text's xxhash64, to join on. Runs jobs;
    the items, each text once, come to the driver block by block.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    bench = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("text IS NOT NULL").withColumn("item_hash", F.xxhash64("text"))
    # Equal texts are one item here and get their ids back at the end.
    different = settle(bench.select(F.col("item_hash").alias("item_id"), "text").distinct(), "benchmark-items")
    frequencies = settle(_all_frequencies(texts), "benchmark-frequencies")
    total = texts.count()
    often = {
        r.word: float(np.log((1 + total) / (1 + r.n))) + 1
        for r in frequencies.filter(F.col("n") > OFTEN * total).toLocalIterator()}
    least = float(np.log((1 + total) / (1 + np.floor(OFTEN * total)))) + 1
    shared = spark.sparkContext.broadcast(often)
    found = []
    for rows in _blocks(different, block_items):
        number = {w: i for i, w in enumerate(sorted({w for r in rows for w in words_of(r.text)}))}
        items = _items(rows, number)
        idf = np.log((1 + total) / (1 + _seen(frequencies, number))) + 1
        lengths = [len(i.words) for i in items]
        # A window inside an item of n words has a cosine of about sqrt(window / n).
        widths = [
            (w, max(1, w * stride // width))
            for w in _widths(width, min(lengths), 2 * min_cosine**2 * max(lengths))]
        passages = settle(
            _passages(texts, number, idf, shared, least, widths, max(lengths)),
            "benchmark-passages")
        rank = min(len(items) + SPARE, len(number))
        latent = _latent(passages, [np.array(i.words) for i in items], idf, widths, rank, rounds)
        found.append(_exact(
            _matches(passages, items, idf, latent, widths, min_cosine), frequencies, total, least))
    if not found:
        return spark.createDataFrame(
            [], "doc_id long, text_hash long, item_id long, cosine double, covered double, answered double")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    ids = bench.select("item_id", "item_hash").distinct()
    pairs = pairs.filter(F.col("cosine") >= min_cosine - 1e-6).withColumnRenamed(
        "item_id", "item_hash").join(ids, "item_hash")
    return pairs.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("cosine").alias("cosine"), F.max("covered").alias("covered"),
        F.max("answered").alias("answered"))


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns as they are."""
    found = settle(
        contaminated(docs, benchmark, **settings).select(
            F.coalesce("doc_id", F.lit(MIN_LONG)).alias("__k"), F.col("text_hash").alias("__t"))
        .distinct(), "benchmark-found")
    return keyed(docs).join(found, ["__k", "__t"], "left_anti").select(*docs.columns)
