"""Documents that share most of their word n-grams: a grouped prefix join.

Shingles are ordered by rarity. A document's prefix are its rarest shingles, so many that two
documents over the threshold must share one. Documents with the same shingles are one class, and
classes with the same prefix and size are one group: the join runs over groups, and only groups that
pass the filters are expanded into their classes, whose texts are then compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tidemark.llm import batches
from tidemark.llm.components import components
from tidemark.llm.store import materialize, sent_if_small

SKETCH_BITS = 20  # a counter per value of so many bits of a shingle's hash: 4 MB at every scale
CHUNK = 1 << 14  # counters per row while counters are summed
BROADCAST_BYTES = 4 << 20  # ids of documents to compare are broadcast up to this size

_HEADS = (
    "doc_id long, n_shingles long, sig_1 long, sig_2 long, prefix binary,"
    " edge struct<rarity: long, token: long>"
)


def document_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; one for a short text, none for an empty."""
    raw, begins = batches.text_bytes(column)
    for first, last in batches.slices(begins):
        low = begins[first]
        part = raw[low : begins[last]]
        _, _, words, at = batches.hash_words(part, begins[first : last + 1] - low,
                                             batches.WORD_OF_SPACES)
        windows = batches.hash_windows(words, width)
        for i in range(last - first):
            count = at[i + 1] - at[i]
            if count >= width:
                yield np.unique(windows[at[i] : at[i + 1] - width + 1])
            else:
                yield batches.hash_windows(words[at[i] : at[i + 1]], max(count, 1))


def _count_shingles(width: int):
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        shift = np.uint64(64 - SKETCH_BITS)
        for batch in rows:
            raw, begins = batches.text_bytes(batch.column(0))
            for first, last in batches.slices(begins):
                low = begins[first]
                _, _, words, at = batches.hash_words(
                    raw[low : begins[last]], begins[first : last + 1] - low, batches.WORD_OF_SPACES
                )
                if len(words) >= width:
                    inside = np.zeros(len(words) + 1, np.int32)
                    lengths = np.diff(at)
                    np.add.at(inside, at[:-1][lengths >= width], 1)
                    np.add.at(inside, at[1:][lengths >= width] - width + 1, -1)
                    whole = np.cumsum(inside)[: len(words) - width + 1] > 0
                    found = batches.hash_windows(words, width)[whole] >> shift
                    np.add.at(counts, found.astype(np.int64), 1)
        chunks = counts.reshape(-1, CHUNK)
        yield pa.record_batch([
            pa.array(range(len(chunks)), pa.int32()),
            pa.array([c.tobytes() for c in chunks], pa.binary()),
        ], ["chunk", "counts"])

    return count


@pandas_udf(T.BinaryType())
def _summed(counts: pd.Series) -> bytes:
    total = np.zeros(CHUNK, np.uint64)
    for part in counts:
        total += np.frombuffer(part, np.uint32)
    return np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()


def shingle_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How often the shingles of each hash range occur in all texts: a table of fixed size.

    Each task counts into the whole table; tables are summed in two steps, the first over one of
    64 shares of the tasks.
    """
    parts = texts.mapInArrow(_count_shingles(width), "chunk int, counts binary")
    some = F.pmod(F.spark_partition_id(), F.lit(64))
    partial = parts.groupBy("chunk", some.alias("some")).agg(_summed("counts").alias("counts"))
    total = partial.groupBy("chunk").agg(_summed("counts").alias("counts")).collect()
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in total:
        counts[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, np.uint32)
    return counts


def _heads(counts, width: int, threshold: int):
    def heads(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = counts.value
        shift = np.uint64(64 - SKETCH_BITS)
        for batch in rows:
            sizes, sums, mixed, prefixes, edges = [], [], [], [], []
            for shingles in document_sets(batch.column(1), width):
                size = len(shingles)
                length = size - (size * threshold + 99) // 100 + 1 if size else 0
                order = np.lexsort((shingles, rarity[(shingles >> shift).astype(np.int64)]))
                sizes.append(size)
                sums.append(shingles.sum(dtype=np.uint64))
                mixed.append(batches.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(
                    dtype=np.uint64))
                prefixes.append(shingles[order[:length]].tobytes())
                last = shingles[order[length - 1 : length]].tolist()
                edges.append({
                    "rarity": int(rarity[last[0] >> int(shift)]), "token": last[0] - (1 << 63)
                } if last else None)
            yield pa.record_batch([
                batch.column(0), pa.array(sizes, pa.int64()),
                pa.array(np.array(sums, np.uint64).view(np.int64)),
                pa.array(np.array(mixed, np.uint64).view(np.int64)),
                pa.array(prefixes, pa.binary()),
                pa.array(edges, pa.struct([("rarity", pa.int64()), ("token", pa.int64())])),
            ], ["doc_id", "n_shingles", "sig_1", "sig_2", "prefix", "edge"])

    return heads


def _prefix_tokens(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per group and token of its prefix."""
    for batch in rows:
        step = 256
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            tokens = [np.frombuffer(x, np.int64) for x in part.column(3).to_pylist()]
            lengths = np.array([len(x) for x in tokens], np.int64)
            if not lengths.sum():
                continue
            place = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])
            which = np.repeat(np.arange(len(tokens)), lengths)
            yield pa.record_batch([
                pa.array(np.concatenate(tokens)),
                part.column(0).take(pa.array(which)),
                part.column(1).take(pa.array(which)),
                pa.array(place),
                part.column(2).take(pa.array(which)),
            ], ["token", "gid", "n", "pos", "members"])


def _verify(width: int, threshold: int):
    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in rows:
            linked = []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = part.column(0).to_pylist()
                fresh = [i for i, x in enumerate(ids) if x not in kept and x not in ids[:i]]
                texts = part.column(2).take(pa.array(fresh, pa.int64()))
                kept = {x: kept[x] for x in ids if x in kept}
                kept |= zip((ids[i] for i in fresh), document_sets(texts, width), strict=True)
                for a, right in zip(ids, document_sets(part.column(3), width), strict=True):
                    left = kept[a]
                    common = len(np.intersect1d(left, right, assume_unique=True))
                    union = len(left) + len(right) - common
                    linked.append(common > 0 and 100 * common >= threshold * union)
            yield pa.record_batch(batch.columns[:2], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return verify


def _linked(texts: DataFrame, pairs: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs ``a, b`` whose texts are over the threshold.

    Texts are fetched once per document that is in a pair. Their ids go to every executor if they
    are few bytes, else both tables are shuffled; then texts meet by id.
    """
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    ids = materialize(ids, "compared_ids")
    if ids.count() * 8 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    needed = materialize(texts.join(ids, "doc_id", "left_semi"), "compared")
    right = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    left = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.hint("merge").join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    compared = both.select("a", "b", "text_a", "text_b").mapInArrow(
        _verify(width, threshold), "a long, b long"
    )
    return materialize(compared.distinct(), "linked")


def _bound(threshold: int, n_a: str, n_b: str, overlap) -> F.Column:
    """Whether an overlap, at most so large, can reach the threshold."""
    return (100 + threshold) * overlap >= threshold * (F.col(n_a) + F.col(n_b))


def _shared_tokens(groups: DataFrame, members: DataFrame) -> DataFrame:
    """``token, rep, n, pos, hub`` for tokens that several classes have in their prefix.

    Groups are expanded into their classes here, after tokens of one class alone are gone. The hub
    of a token is its least class.
    """
    tokens = groups.mapInArrow(
        _prefix_tokens, "token long, gid long, n long, pos int, members long"
    )
    shared = materialize(tokens.selectExpr(
        "*",
        "sum(members) OVER (PARTITION BY token) classes",
        "min(struct(gid, n, pos)) OVER (PARTITION BY token) hub",
    ).where("classes > 1"), "shared")
    several = members.join(groups.where("members > 1").select("gid"), "gid", "left_semi")
    single = shared.where("members = 1").withColumn("rep", F.col("gid"))
    expanded = shared.where("members > 1").join(several, "gid")
    columns = ["token", "rep", "n", "pos", "hub"]
    return single.select(columns).union(expanded.select(columns))


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    threshold: int = 80,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` of every row.

    Texts are lower-cased (A-Z) and split at ASCII white space; a text's set are its distinct
    ``width``-word shingles, or all its words as one if there are fewer. Two documents are linked if
    their sets' Jaccard similarity is ``threshold`` percent or more. ``component_id`` is the least
    id reachable by links, ``class_id`` the least id with the same set.

    Null or empty text: no shingles, linked with nothing. Null id: counted, but in no component.
    Rows with the same id are one document: they share a component, whatever their texts. Other
    columns are ignored. The result is exact but for collisions of 64-bit hashes within a pair of
    documents: a link that is not compared joins documents that other links have joined already.
    """
    spark: SparkSession = df.sparkSession
    texts = batches.id_and_text(df, id_column, text_column)
    counts = spark.sparkContext.broadcast(shingle_counts(texts.select("text"), width))
    heads = materialize(texts.mapInArrow(_heads(counts, width, threshold), _HEADS), "heads")

    key = ["n_shingles", "sig_1", "sig_2"]
    known = heads.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(
        known.groupBy(key).agg(
            F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"),
            F.first("edge").alias("edge"),
        ),
        "classes",
    )
    grouped = classes.withColumn(
        "gid", F.min("rep").over(Window.partitionBy("n_shingles", "prefix"))
    ).select("gid", "rep", F.col("n_shingles").alias("n"), "prefix", "edge")
    grouped = materialize(grouped, "groups")
    sizes = grouped.groupBy("gid").agg(F.count("*").alias("members"))
    groups = grouped.where("gid = rep").join(sizes, "gid").select("gid", "n", "members", "prefix")
    shared = _shared_tokens(groups, grouped.select("gid", "rep"))

    # Of two classes, consider the one whose prefix ends first in the order: tokens of that prefix
    # which no other prefix has are not in the other class. Hence an overlap is at most its reach.
    prefix_size = F.expr(f"n - div(n * {threshold} + 99, 100) + 1")
    counted = shared.groupBy("rep", "n").agg(F.count("*").alias("shared_tokens"))
    counted = counted.withColumn("e", F.col("n") - prefix_size + F.col("shared_tokens"))
    reach = counted.join(grouped.select("rep", "edge"), "rep").select("rep", "n", "e", "edge")
    reach = materialize(reach, "reach")

    near_hub = shared.where("rep != hub.gid").selectExpr(
        "hub.gid a", "rep b", "least(n - pos, hub.n - hub.pos) most", "n n_b", "hub.n n_a"
    )
    near_hub = near_hub.where(_bound(threshold, "n_a", "n_b", F.col("most"))).select("a", "b")
    pairs = materialize(_reachable(near_hub.distinct(), reach, threshold), "pairs")
    links = _linked(texts, pairs, width, threshold)
    joined = components(links)

    rest = _unjoined_pairs(shared, reach, joined, threshold)
    rest = materialize(rest.join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = _linked(texts, rest, width, threshold)

    rows = heads.select("doc_id", *key).join(classes.select("rep", *key), key, "left")
    rows = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep"))
                       .alias("class_id"))
    rows = materialize(rows, "classes_of_rows")
    several = rows.where("class_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("class_id").alias("a"), F.max("class_id").alias("b")
    ).where("a < b")
    same_id = rows.join(several.select("doc_id", "a"), "doc_id").select(
        "a", F.col("class_id").alias("b")
    ).where("a != b")
    final = components(links.union(more).union(same_id))
    named = rows.join(final.withColumnRenamed("node", "class_id"), "class_id", "left")
    return named.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "class_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def _overlap(a: str, b: str) -> str:
    return f"if(edge_{a} <= edge_{b}, e_{a}, e_{b})"


def _reachable(pairs: DataFrame, reach: DataFrame, threshold: int) -> DataFrame:
    """Pairs of classes that have enough shareable shingles between them."""
    a = reach.selectExpr("rep a", "n n_a", "e e_a", "edge edge_a")
    b = reach.selectExpr("rep b", "n n_b", "e e_b", "edge edge_b")
    both = pairs.join(a, "a").join(b, "b")
    return both.where(_bound(threshold, "n_a", "n_b", F.expr(_overlap("a", "b")))).select("a", "b")


def _unjoined_pairs(
    shared: DataFrame, reach: DataFrame, joined: DataFrame, threshold: int
) -> DataFrame:
    """All pairs that share a token, pass the filters and are not in the same component yet.

    Tokens whose classes are all in one component need no pairs any more, and of the others only
    the classes outside the component of the token's first class look for partners.
    """
    own = shared.select("token", "rep", "n", "pos").join(reach.select("rep", "e", "edge"), "rep").join(
        joined.withColumnRenamed("node", "rep"), "rep", "left"
    )
    own = own.withColumn("component", F.coalesce("component", "rep"))
    open_tokens = own.selectExpr(
        "*", "min(component) OVER (PARTITION BY token) low",
        "max(component) OVER (PARTITION BY token) high",
        "min(struct(rep, component)) OVER (PARTITION BY token).component main",
    ).where("low != high")
    open_tokens = materialize(open_tokens, "open_tokens")
    x = open_tokens.where("component != main").selectExpr(
        "token", "rep x", "n n_x", "e e_x", "edge edge_x", "pos pos_x", "component c_x"
    )
    y = open_tokens.selectExpr(
        "token", "rep y", "n n_y", "e e_y", "edge edge_y", "pos pos_y", "component c_y", "main"
    )
    fits = _bound(threshold, "n_x", "n_y", F.expr(
        f"least({_overlap('x', 'y')}, n_x - pos_x, n_y - pos_y)"
    ))
    found = x.hint("merge").join(y.hint("merge"), "token").where(
        (F.col("c_x") != F.col("c_y")) & fits & ((F.col("c_y") == F.col("main")) | (F.expr("x < y")))
    )
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def keep_first(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options):
    """One row of ``df`` for each component, that of its least id; options as above.

    Rows with the same id are one document: of those with the surviving id, the one with the least
    text stays. A row without id takes part under a number from 2^62 on that its text decides, so
    that copies without id are one row, and a document with a smaller id survives before them. Null
    and empty texts are linked with nothing: without id, all their rows stay. The columns of ``df``
    are returned whatever their names. Ids of rows that go, and of rows that repeat, are sent to every
    executor if they are few bytes, else both tables are shuffled.
    """
    columns = df.columns
    key = "row_key"
    while key in {c.lower() for c in columns}:
        key += "_"
    text = F.col(f"`{text_column}`").cast("string")
    derived = F.xxhash64(text).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    own = F.col(f"`{id_column}`").cast("long")
    keyed = df.withColumn(key, F.coalesce(own, F.when(text.rlike(r"[^\x20\x09-\x0D]"), derived)))
    found = near_duplicates(keyed, key, text_column, **options).where("doc_id IS NOT NULL")
    rows = found.groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("times")
    )
    copies = materialize(rows.where("doc_id != component_id OR times > 1"), "copies")
    others = copies.where("doc_id != component_id").select(F.col("doc_id").alias(key))
    kept = keyed.join(sent_if_small(others, 8), key, "left_anti")
    repeated = copies.where("doc_id = component_id").select(F.col("doc_id").alias(key))
    if repeated.isEmpty():
        return kept.select(*(F.col(f"`{c}`") for c in columns))
    repeated = sent_if_small(repeated, 8)
    whole = F.struct(*(F.col(f"`{c}`") for c in columns))
    once = kept.join(repeated, key, "left_semi").groupBy(key).agg(
        F.min_by(whole, F.coalesce(text, F.lit(""))).alias("row")
    )
    once = once.select(*(F.col("row").getField(c).alias(c) for c in columns))
    return kept.join(repeated, key, "left_anti").select(*(F.col(f"`{c}`") for c in columns)).union(once)
