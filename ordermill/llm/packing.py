"""Mixture-controlled packing of documents into fixed-length sequences.

Every source is a queue of tokens. Deficit round-robin fills each window (a
whole number of sequences) with every queue's share of tokens; what a queue got
too little or too much, less than one token, is its deficit and is carried on.
A queue's deficit after n windows is its share of all tokens so far less the
tokens it gave. Both follow from n alone, so any task computes the cut of any
queue at any window without seeing the windows before: that is how deficits pass
window and partition borders. Rare sources share a queue, in which they take turns:
there a deficit is less than one document. Every window is full, and only the very last
sequence of all is short.

Documents are cut freely at window shares and sequence ends. Token ids are
written once to the shared folder, two bytes each where the vocabulary allows;
positions come from prefix sums over (chunk, source) counts, not from a sort.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ordermill.llm.common import slices, utf8
from ordermill.sources.shared import new_path

SEQUENCE = 1024
WINDOW_SEQUENCES = 16
MAX_QUEUES = 1000
END_ID = 0
BATCH_BYTES = 24 << 20
#: Tokens of the shared queue that are put in order together.
RANGE_TOKENS = 1 << 20

# First bytes of UTF-8 characters that may be white space (fixed by Unicode).
_MAYBE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)


class Encoder:
    """Byte-level BPE over whole batches; every distinct word is encoded once.

    ``vocabulary`` is a file of ranks. The ids are those that the library
    ``tokenizers`` gives for the same vocabulary without special tokens (tests
    compare them). A blank before a visible character always starts a new piece
    of the split pattern, so texts may be cut there, equal cuts share their ids,
    and the cuts' ids put together are the text's.
    """

    def __init__(self, vocabulary: str, pattern: str) -> None:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding(
            "bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self._lengths = np.zeros(self.size, dtype=np.int64)
        for token, rank in ranks.items():
            self._lengths[rank] = len(token)
        starts = np.zeros(256, dtype=bool)
        starts[0x21:0x7F] = True
        starts[0x80:] = True
        starts[list(_MAYBE_SPACE)] = False
        self._visible = starts

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, the place where each text ends)."""
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        if not len(data):
            return np.zeros(0, dtype=np.int64), ends
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[:-2] = (data[:-1] == 0x20) & self._visible[data[1:]]
        cut[ends] = True
        cut[0] = True
        at = np.flatnonzero(cut)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy()
        ids, until = self._distinct(coded.dictionary)
        first = np.concatenate([[0], until[:-1]])
        out, out_end = _ranges(ids, first[which], (until - first)[which])
        word_ends = np.concatenate([[0], out_end])
        return out, word_ends[np.searchsorted(at, ends)]

    def _distinct(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's ids end.

        Words that start with a blank are encoded as one text and told apart by
        their lengths; the few others, which start a text, one by one.
        """
        data, at, size = _bytes_of(words)
        joined = np.zeros(len(size), dtype=bool)
        long = np.flatnonzero(size > 1)
        joined[long] = (data[at[long]] == 0x20) & self._visible[data[at[long] + 1]]
        flat = np.zeros(0, dtype=np.uint32)
        starts = np.zeros(len(words), dtype=np.int64)
        ends = np.zeros(len(words), dtype=np.int64)
        if joined.any():
            text, _, lengths = _bytes_of(words.filter(pa.array(joined)))
            flat = self._bpe.encode_to_numpy(text.tobytes().decode())
            byte_ends = np.cumsum(self._lengths[flat])
            wanted = np.cumsum(lengths)
            until = np.searchsorted(byte_ends, wanted) + 1
            if not np.array_equal(byte_ends[until - 1], wanted):
                raise AssertionError("a token crosses a word border")
            ends[joined] = until
            starts[joined] = np.concatenate([[0], until[:-1]])
        parts, total = [flat], len(flat)
        for i in np.flatnonzero(~joined).tolist():
            ids = self._bpe.encode_ordinary(words[i].as_py().decode())
            parts.append(np.array(ids, dtype=np.uint32))
            starts[i], total = total, total + len(ids)
            ends[i] = total
        return _ranges(np.concatenate(parts), starts, ends - starts)


def _bytes_of(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words in a row, where each starts, its length)."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset :][: len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[:-1] - offsets[0], np.diff(offsets)


def _ranges(
    values: np.ndarray, starts: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The values of each range, one range after the other, and where each ends."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0], ends
    small = np.int32 if max(len(values), ends[-1]) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - sizes)).astype(small), sizes)
    at += np.arange(ends[-1], dtype=small)
    return values[at], ends


@lru_cache(maxsize=2)
def encoder(vocabulary: str, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(vocabulary, pattern)


def tokenized(
    docs: DataFrame, vocabulary: str, pattern: str, source_col: str = "source", end_id: int = END_ID
) -> DataFrame:
    """(chunk, source, start, doc_id, n, ids): each row's token ids as a binary.

    ``chunk`` is the input partition and ``start`` the tokens of the same source
    before the row in that chunk. Null texts are empty, null sources an empty
    name, and so are all where the column is missing; each text gets ``end_id``.
    """
    source = F.col(source_col).cast("string") if source_col in docs.columns else F.lit("")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(source, F.lit("")).alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary, pattern)
        width = np.dtype("<u2") if bpe.size <= 1 << 16 else np.dtype("<u4")
        chunk = TaskContext.get().partitionId()
        so_far: dict[str, int] = {}
        for batch in slices(parts, "text", BATCH_BYTES):
            ids, ends = bpe.encode(utf8(batch.column("text")))
            ids = ids.astype(width)
            sources = batch.column("source").to_pylist()
            starts, sizes, packed = [], [], []
            at = 0
            for name, end in zip(sources, ends.tolist()):
                size = end - at + 1
                before = so_far.get(name, 0)
                starts.append(before)
                so_far[name] = before + size
                sizes.append(size)
                packed.append(ids[at:end].tobytes() + width.type(end_id).tobytes())
                at = end
            yield pa.record_batch(
                [
                    pa.array([chunk] * batch.num_rows, pa.int32()), batch.column("source"),
                    pa.array(starts, pa.int64()), batch.column("doc_id"),
                    pa.array(sizes, pa.int64()), pa.array(packed, pa.binary()),
                ],
                names=["chunk", "source", "start", "doc_id", "n", "ids"])

    return rows.mapInArrow(
        batches, "chunk int, source string, start long, doc_id long, n long, ids binary")


class Mixture:
    """Where each queue is cut at each window border.

    ``totals`` are the queues' tokens, ``weights`` their target shares (up to a
    factor). Up to time t a queue gives its weight times t tokens, rounded, and
    never more than it has; so all windows hold the shares until a queue is
    empty, and from then on the others share in proportion. With weights equal
    to the totals, the default, all queues end together.
    """

    def __init__(self, totals: list[int], weights: list[float] | None, window: int) -> None:
        self.window = window
        self.totals = np.array(totals, dtype=np.int64)
        self.all = int(self.totals.sum())
        self.weights = np.array(weights if weights else totals, dtype=np.float64)
        self.end = float((self.totals / self.weights).max()) * 1.01 if len(totals) else 0.0

    def _given(self, time: np.ndarray) -> np.ndarray:
        due = np.floor(time[:, None] * self.weights[None, :] + 0.5)
        return np.minimum(due, self.totals[None, :]).astype(np.int64)

    def cuts(self, windows: np.ndarray) -> np.ndarray:
        """Tokens that each queue has given before each of the windows.

        The latest time is searched at which no more than the windows' tokens
        are given; queues that give a token at the very next moment then fill
        the rest, in their order. So cuts never fall from window to window.
        """
        tokens = np.minimum(windows.astype(np.int64) * self.window, self.all)
        # Positive doubles sort as their bits do, which bounds the search.
        low = np.zeros(len(tokens), dtype=np.int64)
        high = np.full(len(tokens), np.float64(self.end).view(np.int64))
        while (high - low > 1).any():
            middle = low + (high - low) // 2
            fits = self._given(middle.view(np.float64)).sum(axis=1) <= tokens
            low, high = np.where(fits, middle, low), np.where(fits, high, middle)
        cut = self._given(low.view(np.float64))
        more = self._given(high.view(np.float64)) - cut
        left = tokens - cut.sum(axis=1)
        before = np.cumsum(more, axis=1) - more
        cut += np.clip(left[:, None] - before, 0, more)
        cut[tokens >= self.all] = self.totals
        return cut

    def about(self, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The window, give or take one, in which a queue's token lies."""
        time = token / self.weights[queue]
        return np.concatenate(
            [self._given(t).sum(axis=1) // self.window for t in np.array_split(time, len(time) // 4096 + 1)])


def _pieces(
    mix: Mixture, queue: np.ndarray, start: np.ndarray, size: np.ndarray, sequence: int
) -> dict[str, np.ndarray]:
    """The pieces of documents at ``start`` of their ``queue``, by document."""
    first = np.maximum(mix.about(queue, start) - 1, 0)
    last = mix.about(queue, start + size) + 1
    many = last - first + 1
    doc = np.repeat(np.arange(len(queue)), many)
    window = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[doc]
    seen, back = np.unique(window, return_inverse=True)
    low, high = mix.cuts(seen), mix.cuts(seen + 1)
    place = np.cumsum(high - low, axis=1) - (high - low)
    q = queue[doc]
    a = np.maximum(start[doc], low[back, q])
    b = np.minimum(start[doc] + size[doc], high[back, q])
    has = b > a
    doc, window, a, b, q, back = (x[has] for x in (doc, window, a, b, q, back))
    at = window * mix.window + place[back, q] + a - low[back, q]
    # Cut at the sequences' ends.
    many = (at + (b - a) - 1) // sequence - at // sequence + 1
    part = np.repeat(np.arange(len(doc)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    border = (at[part] // sequence + nth) * sequence
    begin = np.maximum(at[part], border)
    end = np.minimum((at + (b - a))[part], border + sequence)
    return {
        "doc": doc[part],
        "start": a[part] - start[doc[part]] + begin - at[part],
        "length": end - begin,
        "sequence_id": begin // sequence,
        "offset": begin % sequence,
    }


def _in_turn(rows: DataFrame, tokens: int) -> DataFrame:
    """(chunk, source, start, at): where in their shared queue the documents of rare sources lie.

    Each source gives its documents at an even pace, over the whole queue: a document comes
    when its source's share of tokens is due, so at any place every source is within one
    document of its share. Sources start at different phases of their first document. The
    places are prefix sums inside of ranges of time of about ``RANGE_TOKENS``.
    """
    phase = F.xxhash64("source").cast("double") / 2.0**64 + 0.5
    ranges = tokens // RANGE_TOKENS + 1
    timed = rows.select(
        "chunk", "source", "start", "n",
        ((F.col("base") + F.col("start") + phase * F.col("n")) / F.col("all")).alias("time"),
    ).withColumn("range", F.least(F.floor(F.col("time") * ranges), F.lit(ranges - 1)))
    order = Window.partitionBy("range").orderBy("time", "source", "chunk", "start").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = timed.groupBy("range").agg(F.sum("n").alias("m")).withColumn(
        "before", F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("range")) - F.col("m"))
    inside = timed.withColumn("inside", F.coalesce(F.sum("n").over(order), F.lit(0)))
    return inside.join(sums, "range").select(
        "chunk", "source", "start", (F.col("before") + F.col("inside")).alias("at"))


def pack(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    weights: Mapping[str, float] | None = None,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
    source_col: str = "source",
    max_queues: int = MAX_QUEUES,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``start`` counts the document's ids before the piece, ``ids_crc32`` covers
    the piece's ids as little-endian unsigned 32-bit values, ``source`` names
    the queue's document source, ``ids`` (``with_ids``) holds the ids
    themselves. Every row of ``docs`` is packed, repeated ones and null ids
    too. ``weights`` gives target shares by source; the default is each
    source's share of all tokens. Sources with less than 1 / ``max_queues`` of
    the tokens share one queue, so the number of queues is bounded whatever the
    number of sources; inside it they take turns by whole documents, each in
    proportion to its tokens.

    Runs jobs: the ids are written to the shared folder, the sums of at most
    ``max_queues`` + 1 queues come to the driver.
    """
    spark = docs.sparkSession
    path = new_path(spark, "packing-ids")
    tokenized(docs, vocabulary, pattern, source_col).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)

    counts = tokens.groupBy("chunk", "source").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    large = [
        (r.source, r.n)
        for r in counts.groupBy("source").agg(F.sum("n").alias("n"))
        .filter(F.col("n") * max_queues >= total).orderBy("source").collect()
    ]
    rest = total - sum(n for _, n in large)
    totals = [n for _, n in large] + ([rest] if rest else [])
    shares = None
    if weights is not None:
        known = sum(n for s, n in large if s in weights) or 1
        scale = known / (sum(w for s, w in weights.items() if s in dict(large)) or 1)
        shares = [weights[s] * scale if s in weights else float(n) for s, n in large]
        shares += [float(rest)] if rest else []
    mix = Mixture(totals, shares, sequence * window_sequences)

    names = spark.createDataFrame(
        [(s, i) for i, (s, _) in enumerate(large)], "source string, queue int")
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumns({
        "base": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "all": F.sum("n").over(Window.partitionBy("source"))}).drop("n")
    placed = tokens.join(offsets.join(F.broadcast(names), "source"), ["chunk", "source"]).select(
        "doc_id", "source", "queue", (F.col("base") + F.col("start")).alias("at"), "n", "ids")
    if rest:
        rare = tokens.join(F.broadcast(names), "source", "left_anti")
        at = _in_turn(rare.join(offsets, ["chunk", "source"]), int(rest))
        placed = placed.unionByName(rare.join(at, ["chunk", "source", "start"]).select(
            "doc_id", "source", F.lit(len(large)).alias("queue"), "at", "n", "ids"))

    fields = [("doc_id", "long"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"),
              ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"),
              ("source", "string")] + ([("ids", "array<int>")] if with_ids else [])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts, "ids", 16 << 20):
            size = batch.column("n").to_numpy()
            found = _pieces(
                mix, batch.column("queue").to_numpy(), batch.column("at").to_numpy(), size, sequence)
            packed = batch.column("ids").to_pylist()
            doc = found.pop("doc")
            checks, texts = [], []
            for d, s, n in zip(doc.tolist(), found["start"].tolist(), found["length"].tolist()):
                width = len(packed[d]) // int(size[d])
                ids = np.frombuffer(
                    packed[d], dtype=f"<u{width}", count=n, offset=s * width).astype("<u4")
                checks.append(zlib.crc32(ids.tobytes()))
                if with_ids:
                    texts.append(ids.astype(np.int32))
            take = pa.array(doc)
            columns = [
                batch.column("doc_id").take(take), found["start"], found["length"],
                pa.array(checks, pa.int64()), size[doc], found["sequence_id"], found["offset"],
                batch.column("source").take(take),
            ] + ([pa.array(texts, pa.list_(pa.int32()))] if with_ids else [])
            yield pa.record_batch(
                [c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in columns],
                names=[n for n, _ in fields])

    return placed.mapInArrow(batches, ", ".join(f"{n} {t}" for n, t in fields))
