"""Ranked lexical search over bit-sliced Bloom signatures, with exact results.

Documents of about the same number of terms are the columns of a bit matrix; each term sets a few
rows, its slices, in its document's column. ANDed slices tell of a whole block of documents at once
which may hold a term: never too few, sometimes too many. A term that occurs several times sets more
slices, one set for each step of a fixed ladder, so the slices also bound how often it occurs. Sums
of slices, weighted by the terms, thus bound every document's score from above.

A search takes the best bounds, scores those documents exactly, and so knows for each query a score
that its last hit has at least. Every document whose bound does not exclude it is then scored from
its text. The index does not know the queries; terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import batches
from tidemark.llm.store import materialize, sent_if_small
from tidemark.operators.ranks import numbered

SLICES = 4  # of a term
BITS = 8  # of a signature for each of the most terms that its block allows, at least
WIDEST = 1 << 22  # rows of a matrix; beyond, bounds are looser and results the same
BLOCK = 2048  # documents of a block, at most
BLOCK_BITS = 1 << 24  # of its matrix, about
# Numbers of occurrences that have slices of their own: 1, 2, 3, 4, 6, 8, 12 and so on.
LADDER = np.array(sorted({1, 3, *(x << k for k in range(1, 24) for x in (1, 3))}))
TERMS = 1 << 17  # of the queries that are searched at once, about
QUERIES = 256  # whose bounds a task adds up at once
COUNTED = 1 << 19  # distinct terms that a task counts before it hands them on

_U = np.uint64
_INDEX = (
    "width int, ids array<long>, lengths array<long>, slices binary,"
    " terms array<long>, counts array<long>"
)
_LAST = (1 << 63) - 1  # stands for no id: behind all others


class Index(NamedTuple):
    """Stored blocks, document frequencies by term, and the totals that scores need."""

    blocks: DataFrame
    frequencies: DataFrame
    documents: int  # with a term at least
    terms: int  # of all documents, repeats included


def _codes(terms: np.ndarray, step: int) -> np.ndarray:
    """What the terms set slices by on a step of the ladder."""
    return batches.mix(terms + _U(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def _entries(terms: np.ndarray, often: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each step of the ladder, which of the terms reach it and what they set slices by."""
    reach = np.arange(len(terms))
    for step, least in enumerate(LADDER):
        reach = reach[often[reach] >= least]
        if not len(reach):
            return
        yield reach, _codes(terms[reach], step)


def _rows_of(entries: np.ndarray, width: int) -> np.ndarray:
    """The slices of each entry: a row of SLICES numbers below ``width``, a power of two."""
    low, step = entries & _U(0xFFFFFFFF), (entries >> _U(32)) | _U(1)
    return ((low[:, None] + step[:, None] * np.arange(SLICES, dtype=_U)) & _U(width - 1)).astype(np.int64)


def _terms_of(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms with their document and number of occurrences, and terms per document."""
    _, _, hashes, at = batches.hash_words(raw, begins, batches.WORD_OF_ALNUM)
    lengths = np.diff(at)
    documents = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((hashes, documents))
    hashes, documents = hashes[order], documents[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (documents[1:] != documents[:-1])
    starts = np.flatnonzero(first)
    often = np.diff(np.append(starts, len(hashes)))
    return hashes[starts], documents[starts], often, lengths


class _Blocks:
    """Documents gathered by the width of their signatures, and counts of their terms."""

    def __init__(self):
        self.open: dict[int, list[tuple]] = {}
        self.seen: list[np.ndarray] = []
        self.n_seen = 0

    def add(self, doc_id: int | None, length: int, entries: np.ndarray) -> tuple | None:
        width = min(BITS << max(5, int(len(entries) - 1).bit_length()), WIDEST)
        held = self.open.setdefault(width, [])
        held.append((doc_id, length, entries))
        return self.block(width) if len(held) >= max(8, min(BLOCK, BLOCK_BITS // width)) else None

    def block(self, width: int) -> tuple:
        held = self.open.pop(width)
        matrix = np.zeros((width, len(held)), bool)
        sizes = [len(entries) for _, _, entries in held]
        entries = np.concatenate([entries for _, _, entries in held])
        matrix[_rows_of(entries, width), np.repeat(np.arange(len(held)), sizes)[:, None]] = True
        packed = np.packbits(matrix, axis=1, bitorder="little")
        ids, lengths = [i for i, _, _ in held], [n for _, n, _ in held]
        return width, ids, lengths, packed.tobytes(), None, None

    def count(self, terms: np.ndarray) -> tuple | None:
        self.seen.append(terms)
        self.n_seen += len(terms)
        return self.counts() if self.n_seen > COUNTED else None

    def counts(self) -> tuple:
        terms, counts = np.unique(np.concatenate(self.seen), return_counts=True)
        self.seen, self.n_seen = [], 0
        return None, None, None, None, terms.view(np.int64), counts


def _index(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks = _Blocks()
    for batch in rows:
        ids = batch.column("doc_id").to_pylist()
        raw, begins = batches.text_bytes(batch.column("text"))
        for first, last in batches.slices(begins):
            low = begins[first]
            own = raw[low : begins[last]], begins[first : last + 1] - low
            terms, documents, often, lengths = _terms_of(*own)
            found = list(_entries(terms, often))
            owners = np.concatenate([documents[reach] for reach, _ in found] or [documents])
            entries = np.concatenate([codes for _, codes in found] or [terms])
            order = np.argsort(owners, kind="stable")
            ends = np.searchsorted(owners[order], np.arange(len(lengths) + 1))
            entries = entries[order]
            for at in np.flatnonzero(lengths):
                full = blocks.add(
                    ids[first + at], int(lengths[at]), entries[ends[at] : ends[at + 1]]
                )
                if full:
                    yield _record(full)
            if len(terms) and (counted := blocks.count(terms)):
                yield _record(counted)
    for width in list(blocks.open):
        yield _record(blocks.block(width))
    if blocks.seen:
        yield _record(blocks.counts())


def _record(row: tuple) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    kinds = (pa.int32(), longs, longs, pa.binary(), longs, longs)
    names = ("width", "ids", "lengths", "slices", "terms", "counts")
    return pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)


def build_index(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """The index of all whole texts of ``df``, in one pass; only counts of terms are shuffled.

    Texts without terms are not in it and count for nothing. Every row is a document, repeated rows
    and rows without id too. Other columns are ignored.
    """
    texts = batches.id_and_text(df, id_column, text_column)
    made = materialize(texts.mapInArrow(_index, _INDEX), "signatures")
    blocks = made.where("width IS NOT NULL").select("width", "ids", "lengths", "slices")
    each = made.where("width IS NULL").select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    counted = each.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df"))
    totals = blocks.agg(
        F.sum(F.size("ids")),
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)),
    ).first()
    frequencies = materialize(counted, "frequencies")
    return Index(blocks, frequencies, int(totals[0] or 0), int(totals[1] or 0))


class Queries(NamedTuple):
    """A bounded run of queries: their terms, and which terms each of them holds how often."""

    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    numbers: np.ndarray  # of the queries, sorted
    begins: np.ndarray  # of each query in the two below
    places: np.ndarray  # in ``terms``
    often: np.ndarray
    documents: int
    all_terms: int

    def lengths_part(self, lengths: np.ndarray) -> np.ndarray:
        """``m`` of documents of so many terms."""
        return 25 + (75 * lengths * self.documents) // self.all_terms


def _count_terms(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        raw, begins = batches.text_bytes(batch.column("text"))
        for first, last in batches.slices(begins):
            low = begins[first]
            terms, owners, often, _ = _terms_of(
                raw[low : begins[last]], begins[first : last + 1] - low
            )
            ids = batch.column("item").slice(first, last - first).take(pa.array(owners))
            yield pa.record_batch(
                [ids, pa.array(terms.view(np.int64)), pa.array(often)], ["item", "term", "often"]
            )


def _queries(index: Index, rows: DataFrame) -> Queries:
    """A run of queries on the driver, at most about TERMS rows or one query."""
    found = rows.join(index.frequencies, "term").select("number", "term", "often", "df").toArrow()
    number, term, often, df = (found.column(i).to_numpy() for i in range(4))
    term = term.view(np.uint64)
    terms, first, places = np.unique(term, return_index=True, return_inverse=True)
    most = 2 * index.documents + 2
    weights = np.array([math.floor(1000 * math.log(most / (2 * int(n) + 1))) for n in df[first]])
    order = np.argsort(number, kind="stable")
    numbers, begins = np.unique(number[order], return_index=True)
    return Queries(
        terms, weights.astype(np.int64), numbers, np.append(begins, len(order)),
        places[order], often[order].astype(np.int64), index.documents, index.terms,
    )


def _part(tf: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score for each unit of its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _bounds(queries: Queries, block: dict) -> Iterator[tuple[int, np.ndarray]]:
    """Upper bounds of the scores of a block's documents, a row for each of some queries.

    What a term adds rises with its occurrences, so each step of the ladder adds the difference
    from the step below to the documents whose slices say that they may have reached it.
    """
    width, count = block["width"], len(block["ids"])
    matrix = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
    lengths = np.array(block["lengths"], np.int64)
    m = queries.lengths_part(lengths)
    for first in range(0, len(queries.numbers), QUERIES):
        last = min(first + QUERIES, len(queries.numbers))
        span = slice(queries.begins[first], queries.begins[last])
        own, places = np.unique(queries.places[span], return_inverse=True)
        amount = queries.often[span] * queries.weights[queries.places[span]]
        begins = queries.begins[first : last + 1] - queries.begins[first]
        found = np.zeros((last - first, count), np.int64)
        active, below, alive = np.arange(len(own)), np.zeros(count, np.int64), None
        for step in range(len(LADDER)):
            rows = _rows_of(_codes(queries.terms[own[active]], step), width)
            present = matrix[rows[:, 0]]
            for at in range(1, SLICES):
                present = present & matrix[rows[:, at]]
            if alive is not None:
                present &= alive
            some = present.any(axis=1)
            active, alive = active[some], present[some]
            if not len(active):
                break
            # A document may have all occurrences up to just below the next step, or all its terms.
            most = LADDER[step + 1] - 1 if step + 1 < len(LADDER) else _LAST >> 31
            now = _part(np.minimum(most, lengths), m)
            gain, below = now - below, now
            held = np.unpackbits(alive, axis=1, count=count, bitorder="little").astype(np.float64)
            line = np.full(len(own), -1)
            line[active] = np.arange(len(active))
            lines = line[places]
            for query in range(last - first):
                mine = slice(begins[query], begins[query + 1])
                met = lines[mine] >= 0
                if met.any():
                    sums = amount[mine][met].astype(np.float64) @ held[lines[mine][met]]
                    found[query] += sums.astype(np.int64) * gain
        yield first, found


def _blocks_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(batch.num_rows):
        block = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
        block["sorted"] = np.array([_LAST if i is None else i for i in block["ids"]], np.int64)
        yield block


_FOUND = "number long, doc_id long"


def _best(shared, top: int):
    """The ``top`` documents of each query with the highest bounds in a task."""
    def best(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        least = np.zeros(len(queries.numbers), np.int64)
        for batch in rows:
            for block in _blocks_of(batch):
                for first, bounds in _bounds(queries, block):
                    high = bounds.max(axis=1, initial=0)
                    for at in np.flatnonzero(high > least[first : first + len(bounds)]):
                        query = first + int(at)
                        good = np.flatnonzero(bounds[at] > least[query])
                        bound, ids = bounds[at][good], block["sorted"][good]
                        if query in held:
                            bound = np.concatenate([held[query][0], bound])
                            ids = np.concatenate([held[query][1], ids])
                        order = np.lexsort((ids, -bound))[:top]
                        held[query] = bound[order], ids[order]
                        if len(order) == top:
                            least[query] = bound[order[-1]]
        for query, (bound, ids) in held.items():
            yield pa.record_batch(
                [pa.array(np.full(len(ids), queries.numbers[query])),
                 pa.array(ids, mask=ids == _LAST), pa.array(bound)],
                ["number", "doc_id", "bound"],
            )

    return best


def _possible(shared, limits):
    """All documents that the score and id of a query's last hit so far do not exclude."""
    def possible(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, (scores, last_ids) = shared.value, limits.value
        for batch in rows:
            for block in _blocks_of(batch):
                ids = block["sorted"]
                for first, bounds in _bounds(queries, block):
                    own = slice(first, first + len(bounds))
                    score, last_id = scores[own][:, None], last_ids[own][:, None]
                    left = (bounds > score) | ((bounds == score) & (ids <= last_id))
                    query, at = np.nonzero(left & (bounds > 0))
                    yield pa.record_batch(
                        [pa.array(queries.numbers[first + query]),
                         pa.array(ids[at], mask=ids[at] == _LAST)], ["number", "doc_id"]
                    )

    return possible


def _exact(shared):
    """Exact scores of texts for the queries in ``numbers``."""
    def exact(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        for batch in rows:
            ids, wanted = batch.column("doc_id"), batch.column("numbers")
            raw, begins = batches.text_bytes(batch.column("text"))
            found: list[tuple] = []
            for at in range(batch.num_rows):
                part = raw[begins[at] : begins[at + 1]]
                terms, _, often, lengths = _terms_of(part, np.array([0, len(part)]))
                place = np.minimum(np.searchsorted(queries.terms, terms), len(queries.terms) - 1)
                met = queries.terms[place] == terms
                added = np.zeros(len(queries.terms), np.int64)
                m = queries.lengths_part(lengths)
                added[place[met]] = queries.weights[place[met]] * _part(often[met], m)
                for number in wanted[at].as_py():
                    query = np.searchsorted(queries.numbers, number)
                    mine = slice(queries.begins[query], queries.begins[query + 1])
                    score = int((queries.often[mine] * added[queries.places[mine]]).sum())
                    if score > 0:
                        found.append((number, ids[at].as_py(), score))
            columns = list(zip(*found, strict=True)) or [()] * 3
            yield pa.record_batch(
                [pa.array(x, pa.int64()) for x in columns], ["number", "doc_id", "score"]
            )

    return exact


def _ranked(scores: DataFrame, by: str, top: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.col(by).desc(), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _rescored(texts: DataFrame, pairs: DataFrame, shared) -> DataFrame:
    """Exact scores of ``number, doc_id`` pairs, from the texts of all rows with such an id."""
    wanted = pairs.groupBy(F.col("doc_id").alias("_id")).agg(
        F.sort_array(F.collect_set("number")).alias("numbers")
    )
    wanted = sent_if_small(materialize(wanted, "wanted"), 64)
    met = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")))
    return met.select("doc_id", "text", "numbers").mapInArrow(
        _exact(shared), "number long, doc_id long, score long"
    )


def _search(index: Index, texts: DataFrame, queries: Queries, top: int) -> DataFrame:
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(queries)
    bounds = index.blocks.mapInArrow(_best(shared, top), f"{_FOUND}, bound long")
    seeds = materialize(_ranked(bounds, "bound", top).select("number", "doc_id"), "seeds")
    first = _ranked(materialize(_rescored(texts, seeds, shared), "seed_scores"), "score", top)
    scores = np.zeros(len(queries.numbers), np.int64)
    ids = np.full(len(queries.numbers), _LAST)
    for row in first.where(F.col("rank") == top).select("number", "score", "doc_id").collect():
        at = np.searchsorted(queries.numbers, row.number)
        scores[at] = row.score
        ids[at] = _LAST if row.doc_id is None else row.doc_id
    limits = spark.sparkContext.broadcast((scores, ids))
    left = materialize(index.blocks.mapInArrow(_possible(shared, limits), _FOUND), "possible")
    return _ranked(materialize(_rescored(texts, left, shared), "scores"), "score", top)


def search(
    index: Index,
    documents: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's best ``top`` documents with a score above 0.

    ``index`` is that of the same ``documents``. Terms are runs of ASCII letters and digits and of
    all other than ASCII characters, A-Z lower-cased. Equal scores rank by id, no id last. Rows with
    the same item are one item of all their terms; an item without terms, or whose terms no document
    holds, has no rows. Repeated documents are ranked each. Items are searched in runs of about
    ``TERMS`` terms, each of which reads the signatures twice; all documents meet all items.
    """
    texts = batches.id_and_text(documents, id_column, text_column)
    named = items.select(
        F.col(f"`{item_column}`").alias("item"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )
    item_type = named.schema["item"].dataType.simpleString()
    counted = named.mapInArrow(_count_terms, f"item {item_type}, term long, often long")
    counted = materialize(counted.groupBy("item", "term").agg(F.sum("often").alias("often")), "terms")
    sizes = materialize(counted.groupBy("item").agg(F.count("*").alias("n")), "items")
    placed = numbered(sizes, [], ["item"], add="n").select(
        F.col("item").alias("_item"), F.col("position").alias("number"),
        F.expr(f"before div {TERMS}").alias("run"),
    )
    placed = materialize(placed, "numbers")
    known = sent_if_small(placed, 64)
    terms = counted.join(known, F.col("item").eqNullSafe(F.col("_item")))
    terms = materialize(terms.select("run", "number", "term", "often"), "query_terms")
    runs = sorted(row.run for row in placed.select("run").distinct().collect())
    found = None
    for run in runs:
        queries = _queries(index, terms.where(F.col("run") == run).drop("run"))
        if len(queries.numbers):
            hits = materialize(_search(index, texts, queries, top), "hits")
            found = hits if found is None else found.union(hits)
    if found is None:
        spark = documents.sparkSession
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    return found.join(known, "number").select(
        F.col("_item").alias("item_id"), "rank", "doc_id", "score"
    )
