"""Language-model scores by context-tree weighting over bytes, beside a smoothed unigram score.

A byte is eight binary decisions. For each decision and each context of up to ``DEPTH`` preceding
bytes, a Krichevsky-Trofimov estimator counts zeros and ones, and the estimates of all depths are
mixed by how well they have coded the training texts. Preceding bytes are seen through 32 classes
(letters without case, digits, spaces, line ends, punctuation, other ASCII, the rest).

Every training text is counted and every counted context is kept: the counts are a Spark table by
context and byte. It is weighed in subtrees below the nearest three bytes, sorted by context; only
the sums of the 1,057 contexts of up to two bytes come to the driver. Texts are cut into chunks, and
a chunk meets the chances of its own contexts by a join, so no task and no driver holds the tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches
from tidemark.llm.store import materialize

DEPTH = 5
CLASSES = 32
TOP = 2  # depth of the contexts that the driver weighs: 1,057 at every scale
CHUNK_BYTES = 1 << 25  # text that is scored with a table of its own contexts
PAIRS_AT_ONCE = 1 << 15  # counted pairs weighed at once, or those of one subtree if they are more
PACKED_ROWS = 1 << 19  # chances that are packed at once on their way to the chunks
PAIRS_HELD = 1 << 22  # distinct contexts with their bytes that a task counts before it passes them on
COMMON_WORDS = 1 << 19  # words whose counts are sent to every task: 8 MB at every scale
WORDS_HELD = 1 << 19  # distinct words a task counts before it passes them on

_LINE_CLASS = 28
_NODES = 256  # node 1 is the first bit's, node 2n + bit the next one's

_CHUNKED = "chunk long, row long, doc_id long, text string, learned boolean"
_SCORED = (
    "row long, doc_id long, n_tokens long, n_known long, log_counts double, score double,"
    " n_bytes long, rare array<long>, often array<int>"
)


def _classes() -> np.ndarray:
    classes = np.full(256, 30, np.int32)
    classes[128:] = 31
    classes[list(b".,;:!?")] = 29
    classes[list(b"\t\n\x0b\x0c\r")] = _LINE_CLASS
    classes[32] = 27
    classes[48:58] = 26
    classes[97:123] = classes[65:91] = np.arange(26)
    return classes


CLASS_OF = _classes()


def classes_before(data: np.ndarray, begins: np.ndarray) -> Iterator[np.ndarray]:
    """The class of the byte before each byte, then of the one before that, and so on.

    Before a text's first byte are line ends.
    """
    starts = begins[:-1][begins[:-1] < len(data)]
    before = CLASS_OF[data]
    for _ in range(DEPTH):
        before = np.concatenate([[_LINE_CLASS], before[:-1]]).astype(np.int32)
        before[starts] = _LINE_CLASS
        yield before


def coded(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Context and value of every byte as one number: nearest class first, the byte last."""
    number = np.zeros(len(data), np.int64)
    for before in classes_before(data, begins):
        number = number * CLASSES + before
    return number * 256 + data


def sorted_places(numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The coded bytes in sorted order, with where each one was; long texts in several pieces.

    A number has 33 bits, so its place fits beside it and one sort of plain numbers gives both.
    """
    for first in range(0, len(numbers), 1 << _PLACE_BITS):
        piece = numbers[first : first + (1 << _PLACE_BITS)]
        both = np.sort(piece << _PLACE_BITS | np.arange(len(piece)))
        yield both >> _PLACE_BITS, first + (both & ((1 << _PLACE_BITS) - 1))


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct number of a sorted array begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]]))


def found_in(keys: np.ndarray, values: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The value of each number by sorted ``keys``, which hold all of them.

    Distinct numbers are looked up in order, which passes over the keys once.
    """
    found = np.empty(len(numbers), values.dtype)
    for ordered, places in sorted_places(numbers):
        starts = _starts(ordered)
        each = values[np.searchsorted(keys, ordered[starts])]
        found[places] = np.repeat(each, np.diff(starts, append=len(ordered)))
    return found


def counted(numbers: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how many of each have a weight, which is 0 or 1."""
    both = np.sort(numbers << 1 | weight)
    ordered = both >> 1
    starts = _starts(ordered)
    if not len(starts):
        return ordered, ordered
    return ordered[starts], np.add.reduceat(both & 1, starts)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    distinct, place = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in distinct])[place].reshape(x.shape)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability that KT estimators give to so many zeros and ones."""
    whole = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
    return whole - 2 * math.lgamma(0.5)


def _found(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([
        pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)),
        pa.array(n.astype(np.int64)),
    ], ["kind", "key", "n"])


def _count_words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (kind 1) and of texts (2) of a task."""
    words: list[np.ndarray] = []
    held = texts = 0
    for batch in rows:
        raw, begins = batches.text_bytes(batch.column(0))
        texts += batch.num_rows
        for first, last in batches.slices(begins):
            low = begins[first]
            part, own = raw[low : begins[last]], begins[first : last + 1] - low
            words.append(batches.hash_words(part, own, batches.WORD_OF_SPACES)[2])
            held += len(words[-1])
            if held >= 8 * WORDS_HELD:
                yield _found(1, *_distinct(words))
                words, held = [], 0
    yield _found(1, *_distinct(words))
    yield _found(2, np.zeros(1), np.array([texts]))


def _summed(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    none = np.zeros(0, np.int64)
    keys, place = np.unique(np.concatenate([none, *(k for k, _ in pairs)]), return_inverse=True)
    counts = np.concatenate([none, *(n for _, n in pairs)])
    return keys, np.bincount(place, counts, len(keys)).astype(np.int64)


def _distinct(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]), return_counts=True)
    return keys.view(np.int64), n


class Level(NamedTuple):
    """Bit nodes with counts in contexts of one depth; ``node_of`` has one for each coded bit."""

    key: np.ndarray  # context * 256 + node
    node_of: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_weighted: np.ndarray
    share: np.ndarray


_BITS = np.arange(7, -1, -1)
_PLACE_BITS = 63 - 8 - 5 * DEPTH  # beside a coded byte
_KEY_BYTES = 5  # of a coded byte: 5 classes of 5 bits and 8 bits


def weigh_pairs(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[Level]]:
    """The bits of sorted coded bytes (pairs by 8), and the levels from ``DEPTH`` to ``TOP + 1``.

    All pairs of a subtree of ``TOP + 1`` bytes must be among them. A pair that was not learned from
    has a count of 0 and changes no chance but gets its own.
    """
    byte = keys & 255
    bits = (byte[:, None] >> _BITS) & 1
    nodes = (1 << (7 - _BITS)) | (byte[:, None] >> (_BITS + 1))
    ones = (bits * counts[:, None]).ravel().astype(float)
    zeros = ((1 - bits) * counts[:, None]).ravel().astype(float)
    own = ((keys >> 8)[:, None] << 8 | nodes).ravel()
    node_of = np.arange(len(own))
    below, levels = None, []
    for depth in range(DEPTH, TOP, -1):
        if depth < DEPTH:
            own = (own >> 13 << 8) | (own & 255)
        own, up = np.unique(own, return_inverse=True)
        node_of = up[node_of]
        zeros, ones = np.bincount(up, zeros, len(own)), np.bincount(up, ones, len(own))
        log_weighted = log_estimate(zeros, ones)
        share = np.ones(len(own))
        if below is not None:
            below = np.bincount(up, below, len(own))
            share = 1 / (1 + np.exp(np.clip(below - log_weighted, -700, 700)))
            log_weighted = np.logaddexp(log_weighted, below) - math.log(2)
        levels.append(Level(own, node_of, zeros, ones, log_weighted, share))
        below = log_weighted
    return bits, levels


def whole_subtrees(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted ``key, n`` in runs that do not cut a subtree of ``TOP + 1`` bytes."""
    shift = 8 + 5 * (DEPTH - TOP - 1)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in rows:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size < PAIRS_AT_ONCE:
            continue
        keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        cut = int(np.searchsorted(keys, keys[-1] >> shift << shift))
        if cut:
            yield keys[:cut], counts[:cut]
        held, size = [(keys[cut:], counts[cut:])], len(keys) - cut
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _tops(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the subtrees add to each bit node of their parent of ``TOP`` bytes."""
    for keys, counts in whole_subtrees(rows):
        _, levels = weigh_pairs(keys, counts)
        top = levels[-1]
        own, up = np.unique((top.key >> 13 << 8) | (top.key & 255), return_inverse=True)
        yield pa.record_batch([
            pa.array(own), *(pa.array(np.bincount(up, x, len(own))) for x in (
                top.zeros, top.ones, top.log_weighted
            )),
        ], ["node", "zeros", "ones", "below"])


def upper_mix(node: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By context of ``TOP`` bytes and bit node: the chance of a one that shorter contexts add, and
    the weight of the chance from longer ones."""
    totals = [np.zeros(CLASSES**TOP * _NODES) for _ in sums]
    for total, x in zip(totals, sums, strict=True):
        total[node] = x
    zeros, ones, below = (x.reshape(-1, _NODES) for x in totals)
    added, left = np.zeros((1, _NODES)), np.ones((1, _NODES))
    mixes = []
    for _ in range(TOP + 1):
        own = log_estimate(zeros, ones)
        share = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
        mixes.append((share, (ones + 0.5) / (zeros + ones + 1.0)))
        if len(own) > 1:
            below = np.logaddexp(own, below) - math.log(2)
            zeros, ones, below = (
                x.reshape(-1, CLASSES, _NODES).sum(1) for x in (zeros, ones, below)
            )
    for share, estimate in reversed(mixes):
        more = len(share) // len(added)
        added, left = np.repeat(added, more, 0), np.repeat(left, more, 0)
        added, left = added + left * share * estimate, left * (1 - share)
    return added, left


def _log_chances(shared):
    def log_chances(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The log10 probability of each counted byte after its context."""
        added, left = (x.reshape(-1) for x in shared.value)
        for keys, counts in whole_subtrees(rows):
            bits, levels = weigh_pairs(keys, counts)
            chance = None
            for level in levels:
                own = (level.ones + 0.5) / (level.zeros + level.ones + 1.0)
                each, share = own[level.node_of], level.share[level.node_of]
                chance = each if chance is None else share * each + (1 - share) * chance
            top = levels[-1]
            above = ((top.key >> 13 << 8) | (top.key & 255))[top.node_of]
            chance = (added[above] + left[above] * chance).reshape(bits.shape)
            logs = np.log10(np.where(bits == 1, chance, 1 - chance)).sum(1)
            yield pa.record_batch(
                [pa.array(keys), pa.array(logs.astype(np.float32))], ["key", "log10"]
            )

    return log_chances


def _chunks(chunk_bytes: int):
    def chunks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text with a number of its own and that of its chunk."""
        task = TaskContext.get().partitionId()
        row, size = task << 40, 0
        for batch in rows:
            _, begins = batches.text_bytes(batch.column(1))
            yield pa.record_batch([
                pa.array((task << 32) + (size + begins[:-1]) // chunk_bytes),
                pa.array(np.arange(row, row + batch.num_rows)), *batch.columns,
            ], ["chunk", "row", "doc_id", "text", "learned"])
            row += batch.num_rows
            size += int(begins[-1])

    return chunks


def _chunk_pairs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct coded bytes of each chunk, and how often they are in texts that are learned from."""
    chunk, held, size = None, [], 0

    def found() -> pa.RecordBatch:
        keys, n = _summed(held)
        return pa.record_batch(
            [pa.array(np.full(len(keys), chunk, np.int64)), pa.array(keys), pa.array(n)],
            ["chunk", "key", "n"],
        )

    for batch in rows:
        if not batch.num_rows:
            continue
        raw, begins = batches.text_bytes(batch.column(1))
        chunks = batch.column(0).to_numpy()
        learned = batch.column(2).to_numpy(zero_copy_only=False)
        borders = np.flatnonzero(chunks[1:] != chunks[:-1]) + 1
        for low, high in zip([0, *borders], [*borders, len(chunks)], strict=True):
            if held and chunks[low] != chunk:
                yield found()
                held, size = [], 0
            chunk = int(chunks[low])
            for first, last in batches.slices(begins[low : high + 1]):
                at = begins[low + first : low + last + 1]
                keys = coded(raw[at[0] : at[-1]], at - at[0])
                weight = np.repeat(learned[low + first : low + last], np.diff(at))
                held.append(counted(keys, weight))
                size += len(held[-1][0])
                if size >= PAIRS_HELD:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size >= PAIRS_HELD // 2:
                        yield found()
                        held, size = [], 0
    if held:
        yield found()


def _packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``chunk, key, log10`` with the keys (40 bits each) and chances of a chunk together."""
    def packed() -> pa.RecordBatch:
        chunks, keys, logs = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((keys, chunks))
        chunks, keys, logs = chunks[order], keys[order], logs[order]
        borders = [0, *(np.flatnonzero(chunks[1:] != chunks[:-1]) + 1), len(chunks)]
        short = keys.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES]
        parts = list(zip(borders, borders[1:], strict=False))
        return pa.record_batch([
            pa.array(chunks[borders[:-1]]),
            pa.array([short[a:b].tobytes() for a, b in parts], pa.binary()),
            pa.array([logs[a:b].tobytes() for a, b in parts], pa.binary()),
        ], ["chunk", "keys", "logs"])

    held, size = [], 0
    for batch in rows:
        if batch.num_rows:
            held.append(tuple(x.to_numpy() for x in batch.columns))
            size += batch.num_rows
        if size >= PACKED_ROWS:
            yield packed()
            held, size = [], 0
    if held:
        yield packed()


def _unpacked(chances: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and chances of a chunk in the order of the keys."""
    raw = [np.frombuffer(x, np.uint8) for x in chances.column("keys").to_pylist()]
    short = np.concatenate([np.zeros(0, np.uint8), *raw]).reshape(-1, _KEY_BYTES)
    keys = np.zeros((len(short), 8), np.uint8)
    keys[:, :_KEY_BYTES] = short
    keys = keys.view("<i8").reshape(-1)
    logs = [np.frombuffer(x, np.float32) for x in chances.column("logs").to_pylist()]
    logs = np.concatenate([np.zeros(0, np.float32), *logs])
    order = np.argsort(keys)
    return keys[order], logs[order]


def chances(pairs: DataFrame) -> DataFrame:
    """``key, log10`` of every coded byte in ``pairs`` (``key, n``), by the tree of all of them."""
    spark = pairs.sparkSession
    counts = materialize(pairs.groupBy("key").agg(F.sum("n").alias("n")), "counts")
    subtree = F.shiftright("key", 8 + 5 * (DEPTH - TOP - 1))
    by_subtree = counts.repartition(subtree).sortWithinPartitions("key")
    tops = counts.where("n > 0").repartition(subtree).sortWithinPartitions("key").mapInArrow(
        _tops, "node long, zeros double, ones double, below double"
    )
    sums = [F.sum(x).alias(x) for x in ("zeros", "ones", "below")]
    added = tops.groupBy("node").agg(*sums).toArrow()  # 8 MB at most, at every scale
    shared = spark.sparkContext.broadcast(upper_mix(*(x.to_numpy() for x in added.columns)))
    return by_subtree.mapInArrow(_log_chances(shared), "key long, log10 float")


class Words(NamedTuple):
    """Word counts of the training texts and their totals."""

    common: np.ndarray  # hashes of common words, sorted
    log_counts: np.ndarray  # log10(count + 0.1) of each
    words: DataFrame  # key, n of all other words
    tokens: int  # N
    distinct: int  # V
    texts: int  # training texts: the count of the end token


def _at_most(counted: DataFrame, limit: int) -> DataFrame:
    """The rows with the greatest ``n``, at most so many: all above one of the steps of a scale."""
    step = "cast(floor(log2(n) * 16) AS int)"
    steps = counted.groupBy(F.expr(step).alias("step")).agg(F.count("*").alias("rows")).collect()
    least = None
    for row in sorted(steps, key=lambda r: -r.step):
        limit -= row.rows
        if limit < 0:
            break
        least = row.step
    return counted.where("false" if least is None else f"{step} >= {least}")


def count_words(texts: DataFrame, common_words: int = COMMON_WORDS) -> Words:
    """Count the words of all ``texts`` (column ``text``)."""
    found = texts.select("text").mapInArrow(_count_words, "kind int, key long, n long")
    counts = materialize(found.groupBy("kind", "key").agg(F.sum("n").alias("n")), "words")
    words = counts.where("kind = 1").select("key", "n")
    total = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    totals = {row.kind: row for row in total.collect()}
    n_texts = totals[2].n if 2 in totals else 0
    n_words, distinct = (totals[1].n, totals[1].rows) if 1 in totals else (0, 0)

    common = _at_most(words, common_words).toArrow()
    keys, often = (column.to_numpy() for column in common.columns)
    order = np.argsort(keys.view(np.uint64))
    least = int(often.min()) if len(often) else None
    return Words(
        keys.view(np.uint64)[order],
        np.log10(often[order] + 0.1),
        words if least is None else words.where(F.col("n") < least),
        int(n_words + n_texts),
        int(distinct + (1 if n_texts else 0)),
        int(n_texts),
    )


def _score(shared, end_count: int):
    def score(texts: pa.Table, chances: pa.Table) -> pa.Table:
        """A chunk's texts with the chances of its coded bytes."""
        common, log_counts = shared.value
        keys, logs = _unpacked(chances)
        out = []
        for batch in texts.to_batches():
            raw, begins = batches.text_bytes(batch.column("text"))
            for first, last in batches.slices(begins):
                low = begins[first]
                part, own = raw[low : begins[last]], begins[first : last + 1] - low
                columns = _score_slice(part, own, keys, logs, common, log_counts, end_count)
                ids = (batch.column(x).slice(first, last - first) for x in ("row", "doc_id"))
                out.append(pa.record_batch([*ids, *columns], [
                    "row", "doc_id", "n_tokens", "n_known", "log_counts", "score", "n_bytes",
                    "rare", "often",
                ]))
        return pa.Table.from_batches(out)

    return score


def _score_slice(part, begins, keys, chances, common, log_counts, end_count: int) -> list[pa.Array]:
    def per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        summed = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return summed[at[1:]] - summed[at[:-1]]

    _, _, words, at = batches.hash_words(part, begins, batches.WORD_OF_SPACES)
    known = np.zeros(len(words), bool)
    logs = np.zeros(len(words))
    if len(common):
        place = np.minimum(np.searchsorted(common, words), len(common) - 1)
        known = common[place] == words
        logs = np.where(known, log_counts[place], 0.0)
    rare, often, ends = [], [], [0]
    for low, high in zip(at, at[1:], strict=False):
        own, n = np.unique(words[low:high][~known[low:high]], return_counts=True)
        rare.append(own)
        often.append(n)
        ends.append(ends[-1] + len(own))
    logs_of_bytes = found_in(keys, chances, coded(part, begins))
    offsets = pa.array(ends, pa.int32())
    none = np.zeros(0, np.uint64)
    return [
        pa.array(np.diff(at) + 1),
        pa.array(per_text(known, at).astype(np.int64) + (1 if end_count else 0)),
        pa.array(per_text(logs, at) + math.log10(end_count + 0.1)),
        pa.array(per_text(logs_of_bytes, begins)),
        pa.array(np.diff(begins)),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none, *rare]).view(np.int64))),
        pa.ListArray.from_arrays(
            offsets, pa.array(np.concatenate([none.view(np.int64), *often]).astype(np.int32))
        ),
    ]


def score_texts(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 10,
    common_words: int = COMMON_WORDS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Rows outside fold 0 of ``folds`` are learned from; all rows are scored. ``score`` is the log10
    probability of the text's bytes by the context tree and ``bits_per_byte`` its code length
    (null for an empty text). Tokens are words without ASCII white space, A-Z lower-cased, and one
    end per text; ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1))) over them.

    Null or empty text is its end alone. Every row is scored by itself, repeated rows too; a null id
    counts as empty for its fold; without training rows all counts are zero; other columns are
    ignored. Words are told apart by 64-bit hashes.
    """
    texts = batches.id_and_text(df, id_column, text_column)
    texts = texts.withColumn("learned", batches.fold("doc_id", folds) != 0)
    texts = materialize(texts.mapInArrow(_chunks(chunk_bytes), _CHUNKED), "chunks")
    model = count_words(texts.where("learned"), common_words)
    pairs = texts.select("chunk", "text", "learned").mapInArrow(
        _chunk_pairs, "chunk long, key long, n long"
    )
    pairs = materialize(pairs, "pairs")
    met = pairs.select("chunk", "key").join(chances(pairs.select("key", "n")), "key").select(
        "chunk", "key", "log10"
    ).mapInArrow(_packed, "chunk long, keys binary, logs binary")
    shared = df.sparkSession.sparkContext.broadcast((model.common, model.log_counts))
    scored = texts.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(
        _score(shared, model.texts), _SCORED
    )
    scored = materialize(scored, "scored")

    # Counts of common words are in the score already; the others meet their counts by a join.
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "often")).alias("w")).select(
        "row", F.col("w.rare").alias("key"), F.col("w.often").alias("often")
    )
    met = rare.join(model.words, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    added = met.groupBy("row").agg(
        F.sum(F.col("often") * F.log10(F.col("n") + 0.1)).alias("more_logs"),
        F.sum(F.when(F.col("n") > 0, F.col("often")).otherwise(0)).alias("more_known"),
    )
    whole = scored.drop("rare", "often").join(added, "row", "left")
    zero = F.lit(0)
    norm = math.log10(model.tokens + 0.1 * (model.distinct + 1))
    return whole.select(
        "doc_id",
        (batches.fold("doc_id", folds) == 0).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.coalesce("more_logs", zero) - F.col("n_tokens") * norm).alias(
            "base_score"
        ),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") * math.log2(10) / F.col("n_bytes")).alias(
            "bits_per_byte"
        ),
    )
