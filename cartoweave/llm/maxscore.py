"""Ranked lexical search with Block-Max MaxScore over an inverted index in shards.

``build`` turns documents into shards of bounded size. A shard holds, for each of its
terms, the documents and occurrences in compressed blocks of 128 (gaps and counts in
bytes of seven bits), and for each block its last document and the few (occurrences,
length) pairs that no other pair of the block beats in both. Whatever the statistics of
the corpus turn out to be, a block's exact largest impact is among these, so shards are
built in one pass, and shards of several tables can be searched as one.

``search`` takes queries in blocks of bounded size. Only the lists of their terms are
read, and dealt out by shard. For a query, a shard's lists are ordered by their bound.
The strong ones are essential: they are decompressed and summed up, until the bounds of
those left add up to less than the score of the ``k``-th document, so a document in none
of the essential lists cannot get in. For the candidates, each weaker list is first asked
for the block maximum around the candidate; only where that leaves a chance is the block
decompressed. The ``k``-th score is handed from shard to shard within a task, and the
heaps of all tasks are merged.

Bounds are compared strictly, so documents of equal score are never lost to a tie.

Terms are the maximal runs of ASCII letters, digits and all characters beyond ASCII; only
A-Z are lower-cased. The weights are in ``statistics``; scores are whole numbers.

Defined results: null and empty texts have no term and are never found; a text of any
length is cut into terms piece by piece; rows that repeat an id are documents of their
own; rows without id come after others of the same score; every row of the queries is a
query, repeated ones and those without id too; a query without any known term has no
rows; an empty table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartoweave.llm.common import as_bytes, prepare, staged, texts

BLOCK = 128
SHARD_ROWS, SHARD_BYTES = 4096, 16 << 20
#: Queries and bytes of their terms that travel to the tasks at a time.
QUERY_ROWS, QUERY_BYTES = 1024, 4 << 20
PIECE = 4 << 20
#: Bytes to terms: letters in lower case, digits and bytes beyond ASCII stay, others part.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, a bounded piece at a time."""
    folded = text.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE) if len(folded) - at > PIECE else len(folded)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


# Blocks


def _pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers in bytes of seven bits, the last byte below 128, and where each starts."""
    size = np.ones(len(values), np.int64)
    rest = values >> 7
    while rest.any():
        size += rest > 0
        rest >>= 7
    starts = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(starts[-1]), np.uint8)
    for place in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > place)
        more = np.where(size[rows] > place + 1, 128, 0)
        out[starts[rows] + place] = (values[rows] >> (7 * place) & 127) | more
    return out, starts


def _unpack(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    if not len(ends):
        return np.zeros(0, np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(begins, ends - begins + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), begins)


def _skyline(block: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Rows of each block that no other row beats in count and length both."""
    order = np.lexsort([length, -count, block])
    b, n = block[order], length[order]
    # Shorter than every row of the same block with as many or more occurrences.
    floor = np.minimum.accumulate(n - b * (int(n.max(initial=0)) + 1))
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != b[:-1]) | (floor[1:] < floor[:-1])
    return order[keep]


class _Shard:
    """Collects documents and writes them as rows of the index."""

    def __init__(self, name: str):
        self.name, self.size = name, 0
        self.numbers: dict[bytes, int] = {}
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.ids: list = []
        self.lengths: list[int] = []

    def add(self, own_id, text: bytes) -> None:
        numbers = self.numbers
        found: list[np.ndarray] = []
        total = 0
        for piece in terms(text):
            for t in set(piece).difference(numbers):
                numbers[t] = len(numbers)
            total += len(piece)
            found.append(np.fromiter(map(numbers.__getitem__, piece), np.int64, len(piece)))
        if not total:
            return
        key, count = np.unique(np.concatenate(found) if len(found) > 1 else found[0], return_counts=True)
        self.keys.append(key << 32 | len(self.ids))
        self.counts.append(count)
        self.ids.append(own_id)
        self.lengths.append(total)
        self.size += len(text)

    def batches(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        # Numbers of documents follow their ids, so that ties fall to the smaller one.
        place = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] if self.ids[i] is not None else 0))
        number = np.empty(len(place), np.int64)
        number[place] = np.arange(len(place))
        length = np.array(self.lengths, np.int64)[place]
        key, count = np.concatenate(self.keys), np.concatenate(self.counts)
        key = key >> 32 << 32 | number[key & 0xFFFFFFFF]
        order = np.argsort(key)
        key, count = key[order], count[order]
        term, doc = key >> 32, key & 0xFFFFFFFF
        starts = np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1, [len(term)]])
        held = np.diff(starts)
        within = np.arange(len(term)) - np.repeat(starts[:-1], held)
        opens = np.flatnonzero(within % BLOCK == 0)
        block = np.cumsum(within % BLOCK == 0) - 1
        gap = np.diff(doc, prepend=0)
        gap[opens] = doc[opens]
        data, at = _pack(np.stack([gap, count], 1).ravel())
        list_bytes = at[2 * starts]
        blocks_of = (held + BLOCK - 1) // BLOCK
        first_block = np.concatenate([[0], np.cumsum(blocks_of)])
        last = doc[np.concatenate([opens[1:], [len(doc)]]) - 1]
        begin = at[2 * opens] - np.repeat(list_bytes[:-1], blocks_of)
        best = _skyline(block, count, length[doc])
        sky = np.stack([block[best] - np.repeat(first_block[:-1], blocks_of)[block[best]], count[best], length[doc[best]]], 1)
        sky_at = np.searchsorted(block[best], first_block)

        names = np.empty(len(self.numbers), object)
        names[list(self.numbers.values())] = list(self.numbers)
        n = len(held)
        buffers = [None, pa.py_buffer(list_bytes.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
        lists = pa.RecordBatch.from_arrays(
            [
                pa.array([self.name] * n),
                pa.array(names[term[starts[:-1]]].tolist(), pa.string()),
                pa.array(held),
                pa.ListArray.from_arrays(pa.array((2 * first_block).astype(np.int32)), pa.array(np.stack([last, begin], 1).ravel())),
                pa.ListArray.from_arrays(pa.array((3 * sky_at).astype(np.int32)), pa.array(sky.ravel())),
                pa.Array.from_buffers(pa.binary(), n, buffers),
                pa.nulls(n, pa.list_(kind)),
                pa.nulls(n, pa.list_(pa.int64())),
            ],
            names=FIELDS,
        )
        for i in range(0, n, 10_000):
            yield lists.slice(i, 10_000)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([self.name]),
                pa.nulls(1, pa.string()),
                pa.array([len(place)], pa.int64()),
                pa.nulls(1, pa.list_(pa.int64())),
                pa.nulls(1, pa.list_(pa.int64())),
                pa.nulls(1, pa.binary()),
                pa.array([[self.ids[i] for i in place]], pa.list_(kind)),
                pa.array([length.tolist()], pa.list_(pa.int64())),
            ],
            names=FIELDS,
        )


FIELDS = ["shard", "term", "held", "blocks", "sky", "data", "ids", "lengths"]


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SHARD_ROWS, size: int = SHARD_BYTES) -> DataFrame:
    """The index of all rows: ``shard, term, held, blocks, sky, data, ids, lengths``. One
    row for each term of a shard, and one without term that holds the shard's documents.
    A shard ends at ``rows`` documents or ``size`` bytes, or holds one longer text."""
    prepare(docs.sparkSession)
    source = texts(docs, id_col, text_col)
    kind = source.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        now = None
        for batch in batches:
            of = batch.schema.field(0).type
            for own_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                if now is None or len(now.ids) >= rows or now.size + len(text) > size and now.ids:
                    if now is not None:
                        yield from now.batches(of)
                    now, made = _Shard(f"{part}-{made}"), made + 1
                now.add(own_id, text)
        if now is not None:
            yield from now.batches(of)

    return staged(
        source.mapInArrow(run, f"shard string, term string, held long, blocks array<long>, sky array<long>, data binary, ids array<{kind}>, lengths array<long>")
    )


# Search


@dataclass
class Statistics:
    """``docs`` with at least one term, ``length``: all their terms."""

    docs: int
    length: int

    def weight(self, held: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * held + 1)))

    def impact(self, count: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 75 + 25 * length * self.docs // self.length
        return 1_000_000_000 * count // (1000 * count + 12 * m)


def statistics(index: DataFrame) -> Statistics:
    row = index.where("term IS NULL").agg(F.sum("held").alias("docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("length")).first()
    return Statistics(row["docs"] or 0, row["length"] or 0)


class _List:
    """One term in one shard. Blocks are decompressed when asked for, and then kept."""

    def __init__(self, row: dict, lengths: np.ndarray, corpus: Statistics):
        self.n, self.data = row["held"], np.frombuffer(row["data"], np.uint8)
        blocks = np.array(row["blocks"], np.int64).reshape(-1, 2)
        self.last, begin = blocks[:, 0], blocks[:, 1]
        self.bytes = np.concatenate([begin, [len(self.data)]])
        sky = np.array(row["sky"], np.int64).reshape(-1, 3)
        starts = np.searchsorted(sky[:, 0], np.arange(len(blocks)))
        self.most = np.maximum.reduceat(corpus.impact(sky[:, 1], sky[:, 2]), starts)
        self.bound = int(self.most.max())
        self.open = np.zeros(len(blocks), bool)
        self.lengths, self.corpus = lengths, corpus
        # A closed block holds its last document everywhere: the order stays ascending.
        self.docs = np.repeat(self.last, BLOCK)[: self.n] if len(blocks) == 1 else np.repeat(self.last, [BLOCK] * (len(blocks) - 1) + [self.n - BLOCK * (len(blocks) - 1)])
        self.impacts = np.zeros(self.n, np.int64)

    def decompress(self, wanted: np.ndarray) -> None:
        wanted = wanted[~self.open[wanted]]
        if not len(wanted):
            return
        if len(wanted) == len(self.open):
            values, rows = _unpack(self.data), np.arange(self.n)
        else:
            values = _unpack(np.concatenate([self.data[self.bytes[b] : self.bytes[b + 1]] for b in wanted.tolist()]))
            rows = (wanted[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            rows = rows[rows < self.n]
        gap, count = values[::2], values[1::2]
        sums = np.cumsum(gap)
        heads = np.flatnonzero(rows % BLOCK == 0)
        docs = sums - np.repeat(sums[heads] - gap[heads], np.diff([*heads.tolist(), len(rows)]))
        self.docs[rows] = docs
        self.impacts[rows] = self.corpus.impact(count, self.lengths[docs])
        self.open[wanted] = True

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        self.decompress(np.arange(len(self.open)))
        return self.docs, self.impacts


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def find(lists: list[tuple[_List, int]], docs: int, k: int, least: int, trace: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Documents of one shard that score ``least`` or more, ascending, and their scores:
    the ``k`` best at least, ties whole. ``lists`` come with their weights in the query."""
    order = sorted(lists, key=lambda x: x[0].bound * x[1])
    bound = np.concatenate([[0], np.cumsum([x.bound * w for x, w in order])]).tolist()
    sums = np.zeros(docs, np.int64)
    at = len(order)
    # Essential lists: whoever is in none of them stays below ``least``.
    while at and bound[at] >= least:
        at -= 1
        own, weight = order[at]
        found, impacts = own.all()
        sums[found] += weight * impacts
        least = max(least, _kth(sums, k))
    left = np.flatnonzero(sums)
    left = left[sums[left] + bound[at] >= least]
    while at and len(left):
        at -= 1
        own, weight = order[at]
        block = np.searchsorted(own.last, left)
        inside = block < len(own.last)
        most = np.zeros(len(left), np.int64)
        most[inside] = own.most[block[inside]]
        chance = sums[left] + weight * most + bound[at] >= least
        if trace is not None:
            trace["asked"] += len(own.last)
            trace["open"] += len(np.unique(block[chance & inside]))
        left, block, inside = left[chance], block[chance], inside[chance]
        here = left[inside]
        own.decompress(np.unique(block[inside]))
        place = np.searchsorted(own.docs, here)
        hit = own.docs[place] == here
        sums[here[hit]] += weight * own.impacts[place[hit]]
        least = max(least, _kth(sums[left], k))
        left = left[sums[left] + bound[at] >= least]
    return left, sums[left]


def _shard_hits(rows: list[dict], queries: list[tuple], corpus: Statistics, weights: dict, heaps: dict, k: int) -> None:
    """Put the hits of one shard into the heaps: ``query: [(score, absent, id), ...]``."""
    whole = next(r for r in rows if r["term"] is None)
    lengths = np.array(whole["lengths"], np.int64)
    lists = {r["term"]: _List(r, lengths, corpus) for r in rows if r["term"] is not None}
    for number, counts in queries:
        own = [(lists[t], n * weights[t]) for t, n in counts.items() if t in lists and weights[t] > 0]
        if not own:
            continue
        heap = heaps.setdefault(number, [])
        least = heap[-1][0] if len(heap) == k else 1
        docs, scores = find(own, len(lengths), k, least)
        if not len(docs):
            continue
        top = np.lexsort([docs, -scores])[:k]
        new = [(int(scores[i]), whole["ids"][docs[i]]) for i in top]
        heaps[number] = heapq.nsmallest(k, [*heap, *new], key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """``(id, {term: occurrences})`` of all rows in lists of bounded size. Long queries are
    fetched one partition after the other, never all at once."""
    block, size = [], 0
    for own_id, text in queries.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).toLocalIterator():
        counts: Counter = Counter()
        for piece in terms(text.encode()):
            counts.update(piece)
        if block and (len(block) >= QUERY_ROWS or size + len(text) > QUERY_BYTES):
            yield block
            block, size = [], 0
        block.append((own_id, {t.decode(): n for t, n in counts.items()}))
        size += len(text)
    if block:
        yield block


def _search_block(index: DataFrame, block: list[tuple], corpus: Statistics, k: int, query_kind: str) -> DataFrame:
    spark = index.sparkSession
    wanted = sorted({t for _, counts in block for t in counts})
    asked = spark.createDataFrame([(t,) for t in wanted], "term string")
    lists = index.join(F.broadcast(asked), "term", "left_semi")
    held = lists.groupBy("term").agg(F.sum("held").alias("held")).collect()
    weights = {r["term"]: corpus.weight(r["held"]) for r in held}
    sent = spark.sparkContext.broadcast(([(i, counts) for i, (_, counts) in enumerate(block)], [q for q, _ in block], weights))
    kind = index.schema["ids"].dataType.elementType.simpleString()
    names = FIELDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, ids, weights = sent.value
        heaps: dict[int, list[tuple]] = {}
        rows: list[dict] = []
        of = pa.int64()
        for batch in batches:
            of = batch.schema.field("ids").type.value_type
            for row in batch.select(names).to_pylist():
                if rows and rows[0]["shard"] != row["shard"]:
                    _shard_hits(rows, queries, corpus, weights, heaps, k)
                    rows = []
                rows.append(row)
        if rows:
            _shard_hits(rows, queries, corpus, weights, heaps, k)
        flat = [(q, s, d) for q, heap in heaps.items() for s, d in heap]
        if flat:
            numbers, scores, docs = zip(*flat)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([ids[q] for q in numbers]), pa.array(scores, pa.int64()), pa.array(docs, of)], names=["query", "item_id", "score", "doc_id"])

    dealt = lists.select(*names).unionByName(index.where("term IS NULL").select(*names)).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, f"query int, item_id {query_kind}, score long, doc_id {kind}")


def search(index: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 for
    every row of ``queries``, equal scores by ascending id."""
    spark = prepare(index.sparkSession)
    corpus = statistics(index)
    query_kind = queries.schema[id_col].dataType.simpleString()
    kind = index.schema["ids"].dataType.elementType.simpleString()
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    out = spark.createDataFrame([], f"item_id {query_kind}, rank int, doc_id {kind}, score long")
    if corpus.docs:
        for block in query_blocks(queries, id_col, text_col):
            hits = _search_block(index, block, corpus, k, query_kind)
            ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
            out = out.unionByName(staged(ranked))
    return out


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 20, **columns) -> DataFrame:
    """``search`` over a new index of ``docs``."""
    return search(build(docs), queries, k, **columns)
