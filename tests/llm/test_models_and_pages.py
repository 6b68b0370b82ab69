"""The context tree, url rules and WARC archives."""

import base64
import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from cases import ODD, documents, workers  # noqa: F401

from tidemark.llm import context_tree, url_rules, warc
from tidemark.llm.store import open_file
from tidemark.session import work_dir

# Context tree.

def kt(zeros, ones):
    return math.exp(float(context_tree.log_estimate(np.array([zeros]), np.array([ones]))[0]))


def test_estimator_is_sequential():
    chance, seen = 1.0, [0, 0]
    for bit in (1, 1, 0, 1):
        chance *= (seen[bit] + 0.5) / (sum(seen) + 1)
        seen[bit] += 1
    assert math.isclose(kt(*seen), chance)


def scores(df, **options):
    return {r.doc_id: r for r in context_tree.score_texts(df, **options).collect()}


@pytest.mark.parametrize("common", [1 << 20, 3, 0])
def test_base_scores_equal_brute_force(documents, common):
    rng = random.Random(2)
    rows = [*ODD[:9], *((100 + i, " ".join(rng.choice(["The", "cat", "sat", f"w{i}", "on"])
                                         for _ in range(rng.randrange(30)))) for i in range(80))]
    got = scores(documents(*rows), common_words=common)
    tokens = lambda text: [*(text or "").encode().lower().split(), None]
    held = lambda key: zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0
    counts = Counter(t for key, text in rows if not held(key) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for key, text in rows:
        row, own = got[key], tokens(text)
        expected = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held(key), len(own), total)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        assert math.isclose(row.base_score, expected, rel_tol=1e-9)
        assert row.score <= 0 and (row.bits_per_byte is None) == (not text)


def test_learned_texts_are_shorter_than_noise(documents):
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "cat", "sat", "on", "mat"])
    rows = [(i, " ".join(word() for _ in range(50))) for i in range(200)]
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200))
    got = scores(documents(*rows, (9000, noise)))
    plain = [got[i].bits_per_byte for i in range(200) if got[i].held_out]
    assert plain and max(plain) < 2 < got[9000].bits_per_byte


def test_without_training_texts(documents):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = scores(documents((held, "abcd")))[held]
    assert row.train_tokens == 0 and row.n_known == 0
    assert math.isclose(row.score, -4 * 8 * math.log10(2), rel_tol=1e-5)
    assert scores(documents()) == {}



@pytest.mark.parametrize("chunk_bytes", [1 << 22, 700])
def test_every_counted_context_is_in_the_model(documents, chunk_bytes):
    """Scores by all of 60,000 contexts equal the recursion over the whole tree."""
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz \n.é") for _ in range(250)))
            for i in range(150)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)]
    held = lambda key: zlib.crc32(str(key).encode()) % 10 == 0

    def bits(text):
        raw = text.encode()
        before = [context_tree._LINE_CLASS] * 5 + [int(context_tree.CLASS_OF[c]) for c in raw]
        for at, byte in enumerate(raw):
            path = tuple(before[at : at + 5][::-1])
            for bit in range(8):
                yield path, (1 << bit) | (byte >> (8 - bit)), byte >> (7 - bit) & 1

    counts, children = {}, {}
    for key, text in rows:
        for path, node, bit in bits(text) if not held(key) else ():
            for depth in range(6):
                counts.setdefault((path[:depth], node), [0, 0])[bit] += 1
                if depth:
                    children.setdefault((path[: depth - 1], node), set()).add(path[:depth])
    assert len({path for path, _ in counts}) > 60_000
    log_kt = lambda z, o: (math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1)
                           - math.log(math.pi))
    weights = {}
    for depth in range(5, -1, -1):
        for path, node in [c for c in counts if len(c[0]) == depth]:
            own = log_kt(*counts[path, node])
            below = sum(weights[c, node][0] for c in children.get((path, node), ()))
            weights[path, node] = (own, 1.0) if depth == 5 else (
                float(np.logaddexp(own, below)) - math.log(2),
                1 / (1 + math.exp(min(below - own, 700))))

    def chance(path, node, depth=0):
        z, o = counts.get((path[:depth], node), (0, 0))
        share = weights.get((path[:depth], node), (0, 0.5 if depth < 5 else 1))[1]
        deeper = chance(path, node, depth + 1) if depth < 5 else 0
        return share * (o + 0.5) / (z + o + 1) + (1 - share) * deeper

    got = scores(documents(*rows), chunk_bytes=chunk_bytes)
    for key, text in rows[::7]:
        expected = sum(math.log10(c if bit else 1 - c)
                       for path, node, bit in bits(text) for c in [chance(path, node)])
        assert math.isclose(got[key].score, expected, rel_tol=1e-5)


# Url rules.

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("a.example.net", "", "block"), ("a.example.net", "", "allow"),
         ("Example.ORG", "/fr/x", "block"), ("", "/", "block"), ("com", None, "allow"),
         ("zz", "/", None)]


def verdict(url):
    rest = url.partition("://")[2] if url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    path = rest[cut:]
    for mark in "?#":
        path = path.partition(mark)[0]
    fits = []
    for h, p, v in RULES:
        h, p = h.lower(), p or ""
        if h and v and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), v == "block", h + p, v))
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("parts", [1, 7])
def test_verdicts_equal_brute_force(spark, parts):
    rng = random.Random(7)
    hosts = ["net", "example.net", "a.example.net", "b.a.Example.NET", "notexample.net", "x-example.net",
             "example.com", "de.example.com", "example.org", "org", "forg", "co", "localhost:80", "..", ""]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/x/y", "/fr/", "?q=/en/", "#/", "/en/?a#b"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}"
            for _ in range(300)]
    urls += ["http://busy.example.net/en/"] * 200 + [None, "", "no scheme", "a://b://c/d", "x://\n/y"]
    rows = list(enumerate(urls)) + [(None, "http://net/"), (0, urls[0])]
    df = spark.createDataFrame([(i, u, "k", "h") for i, u in rows],
                               "page_id long, url string, key string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = Counter(tuple(r) for r in url_rules.judge_urls(df, rules).collect())
        none = url_rules.judge_urls(df.where("false"), rules).collect()
        free = url_rules.judge_urls(df, rules.where("false")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == Counter((i, *verdict(u)) for i, u in rows)
    assert none == [] and {(r.rule, r.verdict) for r in free} == {(None, "allow")}


# WARC.

def test_archives_round_trip(spark):
    body = "<p>" + "shared text of every page " * 30
    rows = [(i, f"http://h/{i}", body + str(i % 12)) for i in range(60)]
    rows += [(100, None, None), (101, "a\r\nb c", ""), (None, "http://x", body + "1"), (59, "twice", body + "11"),
             (102, "http://long", "é" * 400_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "page_id long, url string, html string, digest string")
    archives = warc.write_archives(df.repartition(3), work_dir(spark, "warc"))
    got = Counter(tuple(r)[:1] + tuple(r)[2:] for r in warc.read_archives(archives).collect())
    most = {}
    for key, _, html in rows:
        most[html or ""] = max(most.get(html or "", -1), -1 if key is None else key)
    expected = Counter()
    for key, _, html in rows:
        raw, kept = (html or "").encode(), most[html or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = key is None or key < kept
        expected[(key, len(raw), digest, "revisit" if again else "response", kept if again else None)] += 1
    assert got == expected
    assert sum(r.records for r in archives.files.collect()) == len(rows)


def test_an_archive_begins_with_its_dictionary(spark):
    rng = random.Random(1)
    rows = [(i, "u", " ".join(rng.choice(["alpha", "beta", "gamma"]) + str(rng.randrange(50))
                              for _ in range(60))) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(df, work_dir(spark, "warc"))
    (row,) = archives.files.collect()
    with open_file(archives.folder, row.file) as file:
        data = file.read()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    assert zstandard.ZstdCompressionDict(dictionary).dict_id() != 0
    whole = zstandard.ZstdCompressor().compress("".join(r[2] for r in rows).encode())
    assert len(data) < 4 * len(whole)
    frame = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    first = frame.decompressobj().decompress(data[8 + size :])
    assert first.startswith(b"WARC/1.1\r\n") and first.endswith(b"\r\n\r\n")


def test_small_payloads_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    archives = warc.write_archives(df, work_dir(spark, "warc"), min_bytes=3)
    assert {r.record_type for r in warc.read_archives(archives).collect()} == {"response"}
    none = warc.write_archives(df.where("false"), work_dir(spark, "warc"))
    assert warc.read_archives(none).collect() == []


def test_coded_bytes_are_looked_up_and_counted_in_order(monkeypatch):
    import numpy as np

    from tidemark.llm import context_tree

    rng = np.random.default_rng(5)
    numbers = rng.integers(0, 1 << 33, 500)[rng.integers(0, 500, 3000)]
    numbers[:2] = [0, (1 << 33) - 1]
    weight = rng.random(3000) < 0.5
    keys = np.unique(np.concatenate([numbers, rng.integers(0, 1 << 33, 500)]))
    values = rng.random(len(keys)).astype(np.float32)
    expected = values[np.searchsorted(keys, numbers)]
    assert (context_tree.found_in(keys, values, numbers) == expected).all()
    monkeypatch.setattr(context_tree, "_PLACE_BITS", 10)  # the same in pieces
    assert (context_tree.found_in(keys, values, numbers) == expected).all()
    distinct, place = np.unique(numbers, return_inverse=True)
    own, n = context_tree.counted(numbers, weight)
    assert (own == distinct).all() and (n == np.bincount(place, weight)).all()
    for none in (context_tree.found_in(keys, values, numbers[:0]), *context_tree.counted(numbers[:0], weight[:0])):
        assert len(none) == 0
