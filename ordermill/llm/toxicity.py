"""Toxicity by the nearest labelled examples.

Examples are the distinct texts of a bounded sample of the labelled rows. Texts
are whole TF-IDF vectors: every word counts, with document frequencies from all
documents, in the vector where an example has it and in the norm in any case. The
``neighbours`` examples of the largest exact cosine vote. A vote weighs
1 / (distance + 0.05), times the part of the inner product that tells labels apart:
the products of the shared words, each by its likelihood ratio statistic G of word
and label in the examples (each text once). G has no part in vector or cosine.
Votes become probabilities by monotone regression on the examples' own votes, an
example being left out of both its neighbours and its G.

The index is a block-max inverted one. Alike examples lie in blocks of 64. Words in a
tenth of the examples have a column instead of postings, whose part of the scores is
exact before; so is that of rare words, whose short lists are read at once. The words
between have their largest weight in every block: one product with these gives a text
an upper bound for every block, and blocks that can not reach the k-th best score known
are skipped. If few are left, only their parts of the lists are read, else whole lists,
which cost less than their parts. What can be among the nearest is scored
again in double precision, so the search is exact. Words travel as 64-bit digests,
never as texts. The index is bounded by ``max_examples`` and is broadcast; of a
document, the words no example has are weighed by a join with their frequencies.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import MIN_LONG, id_and_text, id_remainder, keyed, slices, trim, utf8
from ordermill.sources.shared import Scratch, settle_and_free, shuffles_freed

MAX_EXAMPLES = 30_000
NEIGHBOURS = 50
BLOCK = 64
#: Words in more than this share of the examples are dense columns.
DENSE = 0.1
#: Words in no more than this share are rare; of the others so many have largest weights by block.
RARE, PEAKS = 0.01, 4096
#: Lists of frequent words are read whole if one in so many of their postings is needed.
WHOLE = 8
#: Texts scored at a time, and the most words that they may have together but for one text.
BATCH, BATCH_WORDS = 128, 40_000
#: A vote's weight without any telling word, beside their share of the inner product.
PLAIN = 0.01
#: Single precision scores are this close to the exact ones.
SLACK = 1e-4
THRESHOLD = 0.7

#: ASCII letters lower-cased, other ASCII but digits as white space; the rest as it is.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _parts(ends: np.ndarray, most: int = 1 << 19) -> list[tuple[int, int]]:
    """(first, last + 1) of words whose postings, which end at ``ends[1:]``, are about ``most``."""
    cuts = np.unique(np.searchsorted(ends[1:], np.arange(0, ends[-1], most), side="left")).tolist()
    return list(zip(cuts, [*cuts[1:], len(ends) - 1]))


def _ranges(starts: np.ndarray, sizes: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after another."""
    ends = np.cumsum(sizes, dtype=np.int64)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=kind)
    out += np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    return out


def digests(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64).view(np.int64)


@dataclass
class Examples:
    """What is learnt, as it travels: distinct examples in rising order of id.

    ``words`` (digests) may be left out, as only texts that are counted need them.
    ``told`` has the words' G, and G without one toxic and without one other example
    that has the word. ``terms`` and ``counts`` hold ``sizes`` entries per example.
    ``number`` has the words' numbers here for those in the texts' counts: by falling
    frequency, so that what is read most lies together.
    """

    words: np.ndarray
    idf: np.ndarray
    told: np.ndarray
    sizes: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    share: np.ndarray
    ids: np.ndarray
    neighbours: int = NEIGHBOURS
    number: np.ndarray | None = None
    index: Index | None = None

    def open(self) -> Index:
        """The index, made once per process."""
        if self.index is None:
            self.index = Index(self)
            trim()
        return self.index


class Index:
    """The block-max index; ``visited`` counts the blocks not skipped, of ``offered``."""

    def __init__(self, of: Examples) -> None:
        self.of, self.visited, self.offered = of, 0, 0
        n, words = len(of.sizes), len(of.idf)
        self.starts = np.cumsum(of.sizes) - of.sizes
        self.logs = 1 + np.log(np.arange(1, int(of.counts.max(initial=0)) + 1))
        self.logs = np.concatenate([[0.0], self.logs])
        self.blocks = -(-n // BLOCK)
        self.low = of.terms.astype(np.uint16)
        wide = np.flatnonzero(np.bincount(of.terms, minlength=words) > DENSE * n)
        self.column = np.full(words, -1, dtype=np.int32)
        self.column[wide] = np.arange(len(wide))
        self.norms = np.zeros(n)
        sketch = np.zeros((n, 256), dtype=np.float32)
        for low in range(0, n, 1024):  # Parts only bound the memory.
            sizes = of.sizes[low : low + 1024]
            at = slice(self.starts[low], self.starts[low] + sizes.sum())
            owner, terms = np.repeat(np.arange(len(sizes)), sizes), of.terms[at]
            weights = self.logs[of.counts[at]] * of.idf[terms]
            self.norms[low : low + 1024] = np.sqrt(np.bincount(owner, weights**2, len(sizes)))
            weights /= self.norms[low : low + 1024][owner]
            sign = 1 - 2 * (terms * np.int64(40503) >> 8 & 1)
            sketch[low : low + 1024] = np.bincount(
                owner * 256 + terms % 256, weights * sign, len(sizes) * 256).reshape(-1, 256)
        #: The example at each place; alike ones are neighbours.
        self.example = _alike(sketch, self.norms)
        del sketch
        self.place = np.empty(n, dtype=np.int32)
        self.place[self.example] = np.arange(n)
        #: The columns, by place.
        self.dense = np.zeros((self.blocks * BLOCK, len(wide)), dtype=np.float32)
        for low in range(0, n, 1024):
            sizes = of.sizes[low : low + 1024]
            at = slice(self.starts[low], self.starts[low] + sizes.sum())
            wide = np.flatnonzero(self.column[of.terms[at]] >= 0)
            terms, owner = of.terms[at][wide], low + np.repeat(np.arange(len(sizes)), sizes)[wide]
            self.dense[self.place[owner], self.column[terms]] = self._weights(at.start + wide, owner)
        self._post()

    def _weights(self, entries: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Weights of entries of the examples ``owner``, in single precision."""
        weights = self.logs[self.of.counts[entries]] * self.of.idf[self.of.terms[entries]]
        return (weights / self.norms[owner]).astype(np.float32)

    def _post(self) -> None:
        """Postings of the words without a column, by parts of the words; frequent words'
        largest weights, and where their postings of a block start.
        """
        of, words, n = self.of, len(self.of.idf), len(self.of.sizes)
        narrow = (self.column < 0)[of.terms]
        sizes = np.bincount(of.terms, minlength=words) * (self.column < 0)
        some = np.flatnonzero(sizes > RARE * n)
        some = np.sort(some[np.argsort(-sizes[some], kind="stable")[:PEAKS]])
        #: The row of each frequent word.
        self.row = np.full(words, -1, dtype=np.int32)
        self.row[some] = np.arange(len(some))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        total = int(self.first[-1])
        #: Places by word and count; postings of one word and count make a run.
        self.places = np.empty(total, dtype=np.min_scalar_type(self.blocks * BLOCK))
        self.peaks = np.zeros((len(some), self.blocks), dtype=np.float32)
        self.cuts = np.zeros((len(some), self.blocks + 1), dtype=np.int32)
        runs, near = [], []
        for low, high in _parts(self.first):
            some = np.flatnonzero((of.terms >= low) & (of.terms < high) & narrow)
            owner = np.searchsorted(self.starts, some, side="right") - 1
            order = np.lexsort((self.place[owner], of.counts[some], of.terms[some]))
            some, owner = some[order], owner[order]
            terms, counts, at = of.terms[some], of.counts[some], self.place[owner]
            self.places[self.first[low] : self.first[high]] = at
            new = np.ones(len(some), dtype=bool)
            new[1:] = (terms[1:] != terms[:-1]) | (counts[1:] != counts[:-1])
            new = np.flatnonzero(new)
            runs.append((terms[new], counts[new], np.diff(new, append=len(some)).astype(np.int32)))
            often = np.flatnonzero(self.row[terms] >= 0)
            often = often[np.lexsort((at[often], terms[often]))]
            row, at, value = self.row[terms[often]], at[often], self._weights(some[often], owner[often])
            np.maximum.at(self.peaks, (row, at // BLOCK), value)
            np.add.at(self.cuts, (row, at // BLOCK + 1), 1)
            near.append((at.astype(self.places.dtype), value))
        runs.append((of.terms[:0], of.counts[:0], np.zeros(0, dtype=np.int32)))
        terms, self.run_count, self.run_size = (np.concatenate(x) for x in zip(*runs))
        self.run = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=words))])
        #: The frequent words' postings by place, and where those of a block start.
        near.append((self.places[:0], np.zeros(0, dtype=np.float32)))
        self.near, self.value = (np.concatenate(x) for x in zip(*near))
        self.held = self.cuts.sum(axis=0)[1:]
        self.cuts = np.cumsum(self.cuts, axis=None, dtype=np.int32).reshape(self.cuts.shape)
        self.scale = np.zeros(self.blocks * BLOCK)
        self.scale[:n] = 1 / np.maximum(self.norms[self.example], 1e-300)

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights, by the words that some example has."""
        weights = (1 + np.log(counts)) * self.of.idf[terms]
        norm = np.sqrt((weights**2).sum())
        return terms, weights / norm if norm else weights

    def own(self, example: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[example], self.starts[example] + self.of.sizes[example])
        weights = self.logs[self.of.counts[at]] * self.of.idf[self.of.terms[at]]
        return self.of.terms[at], weights / self.norms[example]

    def search(
        self, queries: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each query (examples, cosines, telling parts) of its nearest, ties to
        the smaller example. Only examples that share a word count. ``without`` leaves
        out one example per query, also from G.
        """
        rows, blocks, k = len(queries), self.blocks, self.of.neighbours
        if not blocks:
            return [(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0))] * rows
        terms = np.concatenate([t for t, _ in queries])
        weights = np.concatenate([w for _, w in queries]).astype(np.float32)
        row = np.repeat(np.arange(rows), [len(t) for t, _ in queries])
        column, often = self.column.take(terms), self.row.take(terms)
        dense, bounds = (
            np.zeros((rows, len(part)), dtype=np.float32) for part in (self.dense.T, self.peaks))
        for part, own in (dense, column), (bounds, often):
            some = np.flatnonzero(own >= 0)
            part[row[some], own[some]] = weights[some]
        dense = (dense @ self.dense.T).reshape(rows, blocks, BLOCK)
        bounds = bounds @ self.peaks
        rare, often = ((column < 0) & (often < 0)).nonzero()[0], (often >= 0).nonzero()[0]
        rare, often = (
            [(terms[x], weights[x]) for x in np.split(
                some, np.cumsum(np.bincount(row[some], minlength=rows))[:-1])]
            for some in (rare, often))
        nearest = [
            self._nearest(*of, None if without is None else self.place[without[i]])
            for i, of in enumerate(zip(dense, bounds, rare, often))]
        out, full, maybe = [], np.zeros(len(self.of.idf)), np.zeros(1 << 16, dtype=bool)
        for i, (t, w) in enumerate(queries):
            at, single = nearest[i]
            if len(at) > k:
                at = at[single >= np.partition(single, -k)[-k] - SLACK]
            found = self.example[at]
            full[t] = w * self.of.idf[t]
            maybe[t & 0xFFFF] = True
            starts, sizes = self.starts.take(found), self.of.sizes.take(found)
            ends = np.cumsum(sizes)
            # Shared words by the low bits first; what only looks shared adds nothing.
            entry = maybe.take(np.concatenate([
                self.low[:0], *[self.low[a:b] for a, b in zip(starts.tolist(), (starts + sizes).tolist())],
            ])).nonzero()[0]
            owner = np.searchsorted(ends, entry, side="right")
            entry += (starts - ends + sizes).take(owner)
            some = self.of.terms.take(entry)
            product = full.take(some) * self.logs.take(self.of.counts.take(entry))
            told = self.of.told[
                0 if without is None else 1 if self.of.share[without[i]] > 0 else 2]
            exact, telling = (
                np.bincount(owner, x, len(found)) / self.norms.take(found)
                for x in (product, product * told.take(some)))
            full[t] = 0
            maybe[t & 0xFFFF] = False
            order = np.lexsort((found, -np.round(exact, 12)))[:k]
            out.append((found[order], np.minimum(exact[order], 1.0), telling[order]))
        return out

    def _nearest(
        self, score: np.ndarray, bound: np.ndarray, rare: tuple[np.ndarray, np.ndarray],
        often: tuple[np.ndarray, np.ndarray], without: int | None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places of what may be nearest, and their scores. ``score`` has the columns' part by
        block, ``bound`` the most that frequent words can add; ``rare`` and ``often`` are the
        (terms, weights) of the words without a column.
        """
        self.offered += self.blocks
        flat = score.reshape(-1)
        terms, weights = rare
        flat += self._sums(terms, weights)
        if without is not None:
            flat[without] = -1
        # What has been summed is no more than the score, so it gives a limit.
        top = score.max(axis=1)
        visited = np.flatnonzero(top + bound > self._limit(flat, top))
        self.visited += len(visited)
        terms, weights = often
        if WHOLE * self.held.take(visited).sum() < self.held.sum():
            rows = self.row.take(terms)[:, None]
            start = self.cuts[rows, visited].ravel()
            sizes = self.cuts[rows, visited + 1].ravel() - start
            entry = _ranges(start, sizes)
            value = np.repeat(np.repeat(weights, len(visited)), sizes) * self.value.take(entry)
            flat += np.bincount(self.near.take(entry), value, flat.size)
        else:
            flat += self._sums(terms, weights)
        if without is not None:
            flat[without] = -1
        top = score.max(axis=1)
        limit = self._limit(flat, top)
        hit = np.flatnonzero(top > limit)
        score = score[hit].ravel()
        some = np.flatnonzero(score > limit)
        return hit[some // BLOCK] * BLOCK + some % BLOCK, score[some]

    def _sums(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the whole lists of words add to the scores, by place."""
        ends = self.first.take(terms + 1).tolist()
        places = np.concatenate([
            self.places[:0], *(self.places[a:b] for a, b in zip(self.first.take(terms).tolist(), ends))])
        run = self.run.take(terms)
        many = self.run.take(terms + 1) - run
        run = _ranges(run, many)
        # All postings of a run add the same, but for the example's norm.
        value = np.repeat(weights * self.of.idf.take(terms), many) * self.logs.take(self.run_count.take(run))
        return np.bincount(places, np.repeat(value, self.run_size.take(run)), len(self.scale)) * self.scale

    def _limit(self, scores: np.ndarray, top: np.ndarray) -> float:
        """What the k nearest exceed, from the blocks' largest scores if they are enough."""
        k = self.of.neighbours
        if len(top) < 2 * k:
            top = scores
        return max(np.partition(top, -k)[-k] - SLACK, 0) if len(top) > k else 0


def vote(share: np.ndarray, cosines: np.ndarray, telling: np.ndarray) -> float:
    """Weighted share of toxic examples among the nearest, -1 without any.

    Equal examples vote once, with the share of toxic ones among them.
    """
    weight = (PLAIN + telling) / (1 - cosines + 0.05)
    return float((weight * share).sum() / weight.sum()) if len(share) else -1.0


def _alike(rows: np.ndarray, norms: np.ndarray, most: int = 64, rounds: int = 3) -> np.ndarray:
    """An order of the rows (sketches of vectors) in which alike ones are neighbours, by k-means,
    in a group by their norms, as weights of long texts are small.

    Only the bounds' tightness depends on it, never a result.
    """
    groups = min(most, len(rows) // BLOCK)
    if groups < 2:
        return np.arange(len(rows))
    centres = rows[np.linspace(0, len(rows) - 1, groups).astype(int)]
    for _ in range(rounds):
        group = np.argmax(rows @ centres.T, axis=1)
        order = np.argsort(group, kind="stable")
        used, starts = np.unique(group[order], return_index=True)
        centres = np.add.reduceat(rows[order], starts, axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    # Groups follow one another by likeness too, since blocks do not end with them.
    group = np.argmax(rows @ centres.T, axis=1)
    near, at, rank = centres @ centres.T, 0, np.zeros(len(centres), dtype=np.int64)
    for i in range(len(centres)):
        rank[at] = i
        near[:, at] = -1
        at = int(np.argmax(near[at]))
    return np.lexsort((norms, rank[group]))


@dataclass
class Calibration:
    """Votes to probabilities: a rising step function, and the rate without votes."""

    edges: np.ndarray
    values: np.ndarray
    none: float

    def __call__(self, vote: float) -> float:
        if vote < 0 or not len(self.edges):
            return self.none
        return float(np.interp(vote, self.edges, self.values))


def calibrated(votes: np.ndarray, total: np.ndarray, toxic: np.ndarray) -> Calibration:
    """Monotone regression of the toxic share on the vote (pool adjacent violators)."""
    none = votes < 0
    rate = float((toxic[none].sum() + 0.0) / max(total[none].sum(), 1))
    order = np.argsort(votes[~none], kind="stable")
    pools: list[list[float]] = []
    for v, n, t in zip(votes[~none][order], total[~none][order], toxic[~none][order]):
        pools.append([v * n, float(n), float(t)])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    edges = np.array([p[0] / p[1] for p in pools])
    values = np.array([p[2] / p[1] for p in pools])
    return Calibration(edges, values, rate)


def _told(toxic: np.ndarray, clean: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The likelihood ratio statistic of word and label, by texts with the word."""
    if n1 <= 0 or n0 <= 0:
        return np.zeros(len(toxic))
    n, some = n1 + n0, toxic + clean
    total = np.zeros(len(some))
    for seen, expected in (
        (toxic, some * n1 / n), (clean, some * n0 / n),
        (n1 - toxic, (n - some) * n1 / n), (n0 - clean, (n - some) * n0 / n),
    ):
        total += seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300))
    return np.maximum(2 * total, 0)


def _vocabulary(examples: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of the examples' words, rising, and in how many toxic and other texts each occurs."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts, "text", 8 << 20):
            counts: dict[int, Counter[bytes]] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(utf8(batch.column("text")), batch.column("toxic").to_pylist()):
                counts[toxic > 0].update(set(words_of(text)))
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.record_batch(
                [pa.array(digests(words)), pa.array([counts[0][w] for w in words], pa.int64()),
                 pa.array([counts[1][w] for w in words], pa.int64())],
                names=["word", "clean", "toxic"])
        trim()

    found = (
        examples.select("text", "toxic")
        .mapInArrow(batches, "word long, clean long, toxic long")
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow().sort_by("word"))
    return tuple(found[c].to_numpy() for c in ("word", "toxic", "clean"))


def _counted(rows: DataFrame, shared, kept: str) -> DataFrame:
    """The columns ``kept``, and how often each text uses the examples' words and others.

    The words' numbers rise; ``gaps`` has the first and the steps to the next ones (see
    ``_terms``), which take less room on disk. ``others`` are 64-bit digests.
    """
    names = rows.select(*[c.split()[0] for c in kept.split(", ")]).columns

    def lists(owner: np.ndarray, rows: int, values: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(parts, "text", 1 << 20):
            sizes, words, n = [], [], []
            for text in utf8(batch.column("text")):
                hits = Counter(words_of(text))
                sizes.append(len(hits))
                words += hits.keys()
                n += hits.values()
            word, n = digests(words), np.array(n, dtype=np.int32)
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((word, row))
            word, n, row = word[order], n[order], row[order]
            at = np.searchsorted(known, word)
            inside = known[np.minimum(at, len(known) - 1)] == word if len(known) else at < 0
            gaps = np.diff(at[inside], prepend=0)
            first = np.flatnonzero(np.diff(row[inside], prepend=-1))
            gaps[first] = at[inside][first]
            parts_of = [
                lists(row[some], len(sizes), values) for some, values in (
                    (inside, gaps.astype(np.int32)), (inside, n[inside]),
                    (~inside, word[~inside]), (~inside, n[~inside]))]
            yield pa.record_batch(
                [*(batch.column(c) for c in names), *parts_of],
                names=[*names, "gaps", "counts", "others", "other_counts"])
        trim()

    return rows.mapInArrow(
        batches,
        f"{kept}, gaps array<int>, counts array<int>, others array<long>, other_counts array<int>")


def _terms(gaps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The words' numbers of rows of ``sizes`` gaps."""
    whole = np.cumsum(gaps, dtype=np.int64)
    sizes = sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    whole -= np.repeat(whole[starts] - gaps[starts], sizes)
    return whole.astype(np.int32)


def _seen(counted: DataFrame, words: int) -> DataFrame:
    """(t, n): how many texts use each of the examples' words, those of any text."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(words, dtype=np.int64)
        for batch in parts:
            gaps = batch.column("gaps")
            seen += np.bincount(
                _terms(pc.list_flatten(gaps).to_numpy(), pc.list_value_length(gaps).to_numpy()), minlength=words)
        term = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(term, pa.int32()), pa.array(seen[term], pa.int64())], names=["t", "n"])
        trim()

    return counted.select("gaps").mapInArrow(batches, "t int, n long").groupBy("t").agg(F.sum("n").alias("n"))


def _vectors(
    batches: Iterator[pa.RecordBatch], number: np.ndarray
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches of few rows and words, with the rows' (terms, counts), words as ``number`` has them."""
    for whole in batches:
        sizes = pc.list_value_length(whole.column("gaps")).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        low = 0
        while low < whole.num_rows:
            before = ends[low - 1] if low else 0
            high = int(np.searchsorted(ends, before + BATCH_WORDS, side="right"))
            high = min(max(high, low + 1), low + BATCH, whole.num_rows)
            batch = whole.slice(low, high - low)
            gaps, counts = (pc.list_flatten(batch.column(c)).to_numpy() for c in ("gaps", "counts"))
            flat = number.take(_terms(gaps, sizes[low:high])), counts
            cuts = ends[low : high - 1] - before
            yield batch, list(zip(*(np.split(f, cuts) for f in flat)))
            low = high


def score(
    docs: DataFrame,
    labels: DataFrame,
    held_divisor: int = 3,
    held_remainder: int = 1,
    max_examples: int = MAX_EXAMPLES,
    neighbours: int = NEIGHBOURS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, held_out, score, predicted, evidence.

    ``labels`` has doc_id and toxic (0 or 1; null and other values are left
    out). Rows held out by the crc32 of their id give no example. ``evidence``
    lists the nearest examples with doc_id, share of toxic ones among equals,
    and cosine. Texts without any word of an example, empty and null ones among
    them, get the rate of such examples; without examples of both labels all scores
    are that of the examples there are, or 0. Repeated rows and null ids are
    rows like any other; a label that occurs twice counts as toxic if one is.

    About ``max_examples`` labelled rows are used, those of the smallest hash of
    id and text; that is the bound on what is fitted and broadcast.
    """
    spark = docs.sparkSession
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    ).filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(id_remainder(held_divisor) != held_remainder)
    with shuffles_freed(spark):
        rows = known.count()
    part = min(1.0, max_examples / max(rows, 1))
    place = F.xxhash64("doc_id", F.lit("example")).cast("double") / 2.0**64 + 0.5
    # Written first, so that the planner sees the bounded size and moves no texts.
    chosen = settle_and_free(known.filter(place < part), "toxicity-labels")
    with Scratch(spark) as scratch, shuffles_freed(spark):
        # Equal texts are one example: copies tell nothing more.
        distinct = scratch.settle(
            id_and_text(docs).join(chosen, "doc_id").groupBy("text").agg(
                F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"), F.min("doc_id").alias("id"))
            .withColumn("text_hash", F.xxhash64("text")),
            "toxicity-texts")
        words, toxic, other = _vocabulary(distinct)
        number = spark.sparkContext.broadcast(words)
        labelled = _counted(distinct, number, "id long, text_hash long, n long, toxic long").drop(
            "others", "other_counts").toArrow()
    texts = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    counted = settle_and_free(_counted(texts, number, "doc_id long, text_hash long"), "toxicity-counts", "zstd")
    frequency = np.zeros(len(words))
    with shuffles_freed(spark):
        total = counted.count()
        seen = _seen(counted, len(words)).toArrow()
    frequency[seen["t"].to_numpy()] = seen["n"].to_numpy()
    order = np.lexsort((labelled["text_hash"].to_numpy(), labelled["id"].to_numpy()))
    sizes = pc.list_value_length(labelled["gaps"]).to_numpy().astype(np.int64)
    flat = [pc.list_flatten(labelled[c]).to_numpy() for c in ("gaps", "counts")]
    flat[0] = _terms(flat[0], sizes)
    ids, share = labelled["id"].to_numpy(), labelled["toxic"].to_numpy() / labelled["n"].to_numpy()
    del labelled
    flat[1] = flat[1].astype(np.min_scalar_type(int(flat[1].max(initial=0))))
    n1, n0 = int((share > 0).sum()), int((share == 0).sum())
    told = [_told(toxic, other, n1, n0), _told(np.maximum(toxic - 1, 0), other, n1 - 1, n0),
            _told(toxic, np.maximum(other - 1, 0), n1, n0 - 1)]
    wordy = order[sizes[order] > 0]
    blank = share[sizes == 0]
    entry = _ranges((np.cumsum(sizes) - sizes)[wordy], sizes[wordy], np.int32)
    falling = np.argsort(-(toxic + other), kind="stable")
    rank = np.empty(len(falling), dtype=np.int32)
    rank[falling] = np.arange(len(falling))
    shared = spark.sparkContext.broadcast(Examples(
        words[:0], np.log((1 + total) / (1 + frequency[falling])) + 1,
        np.array([t[falling] for t in told], dtype=np.float32),
        sizes[wordy], rank[flat[0][entry]], flat[1][entry], share[wordy], ids[wordy], neighbours, rank))
    del flat, entry, told

    def left_out(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.open()
        for batch in parts:
            entries = batch.column("id").to_pylist()
            for low in range(0, len(entries), BATCH):
                own = entries[low : low + BATCH]
                found = index.search([index.own(e) for e in own], own)
                yield pa.record_batch(
                    [pa.array(own, pa.int64()), pa.array(
                        [vote(index.of.share[f[0]], *f[1:]) for f in found], pa.float64())],
                    names=["id", "vote"])
        trim()

    votes = np.zeros(len(wordy))
    with shuffles_freed(spark):
        done = spark.range(len(wordy)).repartition(max(1, len(wordy) // 2048)).mapInArrow(
            left_out, "id long, vote double").toArrow()
    votes[done["id"].to_numpy()] = done["vote"].to_numpy()
    fit = calibrated(
        np.concatenate([votes, np.full(len(blank), -1.0)]), np.ones(len(share)),
        np.concatenate([share[wordy], blank]))

    # The squared weight of the words no example has, by their frequencies.
    key = F.coalesce("doc_id", F.lit(MIN_LONG)).alias("__k")
    words = counted.select(
        key, "text_hash", F.explode(F.arrays_zip("others", "other_counts")).alias("o")).select(
        "__k", "text_hash", F.col("o.others").alias("word"), F.col("o.other_counts").alias("c"))
    weight = (1 + F.log("c")) * (F.log((1 + F.lit(total)) / (1 + F.col("f"))) + 1)
    rest = settle_and_free(
        words.distinct().join(words.groupBy("word").agg(F.count(F.lit(1)).alias("f")), "word")
        .groupBy("__k", "text_hash").agg(F.sum(weight * weight).alias("rest")), "toxicity-others")

    def searched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.open()
        for batch, vectors in _vectors(parts, index.of.number):
            found = index.search([index.vector(t, n) for t, n in vectors])
            squares = [(((1 + np.log(n)) * index.of.idf[t]) ** 2).sum() for t, n in vectors]
            ends = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])])
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate([f[i] for f in found]), kind, safe=False))
                for i, kind in enumerate((pa.int32(), pa.float32(), pa.float32()))]
            yield pa.record_batch(
                [*(batch.column(c) for c in ("doc_id", "__k", "text_hash")),
                 pa.array(squares, pa.float64()), *lists],
                names=["doc_id", "__k", "text_hash", "squares", "found", "cosines", "telling"])
        trim()

    # The norm's other words change no order, so texts are searched where they are read and
    # only their neighbours meet the rest.
    near = counted.select("doc_id", key, "text_hash", "gaps", "counts").mapInArrow(
        searched,
        "doc_id long, __k long, text_hash long, squares double, found array<int>, "
        "cosines array<float>, telling array<float>")
    known_of = spark.sparkContext.broadcast((share[wordy], ids[wordy]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, ids = known_of.value
        kind = pa.list_(pa.struct(
            [("doc_id", pa.int64()), ("toxic", pa.float64()), ("cosine", pa.float64())]))
        for batch in parts:
            scores, evidence = [], []
            squares, rest = (batch.column(c).to_numpy() for c in ("squares", "rest"))
            scale = np.sqrt(squares / np.maximum(squares + rest, 1e-300))
            for i, part in enumerate(scale.tolist()):
                found, cosines, telling = (
                    batch.column(c)[i].values.to_numpy() for c in ("found", "cosines", "telling"))
                cosines = cosines.astype(float) * part
                scores.append(fit(vote(share[found], cosines, telling.astype(float) * part)))
                evidence.append([
                    {"doc_id": int(ids[e]), "toxic": float(share[e]), "cosine": float(s)}
                    for e, s in zip(found[:3], cosines[:3])])
            scores = np.array(scores)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_hash"), batch.column("held_out"),
                 pa.array(scores, pa.float64()),
                 pa.array((scores >= threshold).astype(np.int32), pa.int32()),
                 pa.array(evidence, kind)],
                names=["doc_id", "text_hash", "held_out", "score", "predicted", "evidence"])

    held = id_remainder(held_divisor) == held_remainder
    return (
        near.join(rest, ["__k", "text_hash"], "left")
        .select("doc_id", "text_hash", held.alias("held_out"), "squares", "found", "cosines", "telling",
                F.coalesce("rest", F.lit(0.0)).alias("rest"))
        .mapInArrow(
            batches,
            "doc_id long, text_hash long, held_out boolean, score double, predicted int, "
            "evidence array<struct<doc_id:long,toxic:double,cosine:double>>"))


def clean(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns as they are."""
    found = settle_and_free(
        score(docs, labels, **settings).filter("predicted = 1").select(
            F.coalesce("doc_id", F.lit(MIN_LONG)).alias("__k"), F.col("text_hash").alias("__t"))
        .distinct(), "toxicity-found")
    return keyed(docs).join(found, ["__k", "__t"], "left_anti").select(*docs.columns)
