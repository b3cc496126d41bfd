"""Corpus operators against brute force on small tables with nulls, ties, repeats and clashing names."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import ann, graph, lm, mixing, packing, quality, repeats, sharding, simhash, substring, suffixes, warc
from footfall.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, row string"
WORDS = [f"w{i}" for i in range(400)]


def corpus():
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passage = say(70)
    texts = [None, "", "   ", "one", say(3), "a " * 500, "é" * 450, say(3000)]
    texts += [say(80) for _ in range(25)]
    texts += [f"{say(40)}\n{passage}  {say(30)}" for _ in range(12)]
    texts += [passage] * 4 + [passage + " " + say(5), "x" * 1500, "x" * 700 + "y" * 300]
    rows = [(i, t, "en", "big" if i % 3 else None, None if t is None else len(t), 1, "r") for i, t in enumerate(texts)]
    return rows + [rows[9], rows[-3]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def data(text):
    return (text or "").encode()


def as_set(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_empty_tables(nothing, spark):
    assert quality.judge(nothing).count() == 0
    assert quality.keep_good(nothing).count() == 0
    assert sharding.balanced_shards(nothing).count() == 0
    assert mixing.poisson_mix(nothing).count() == 0
    assert simhash.simhash_components(nothing).count() == 0
    assert simhash.keep_one_each(nothing).count() == 0
    assert suffixes.removal_report(nothing).count() == 0
    assert suffixes.remove_repeats(nothing).count() == 0
    assert substring.removal_report(nothing).count() == 0
    assert lm.score(nothing).count() == 0
    assert packing.pack(nothing, tokenizer()).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_quality_statistics(docs):
    def brute(text):
        words = data(text).split()
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        seen, covered, lines, dup = Counter(windows), set(), set(), 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                covered.update(range(i, i + 8))
        for line in (text or "").split("\n"):
            if line.split():
                dup += line in lines
                lines.add(line)
        n, r = len(words), len(covered)
        return n, sum(len(w.decode()) for w in words), sum(c in quality.SYMBOLS for c in text or ""), dup, r, n < 20 or 100 * r > 30 * n

    got = as_set(quality.judge(docs), "doc_id", *quality.BASE_COLUMNS, "base_failed")
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert not quality.judge(docs).filter("base_failed AND kept").count()


def test_rules_learn_who_is_right():
    # Two rules agree on a tenth of the documents; the third now and then votes at random.
    rng = random.Random(1)
    patterns = Counter()
    for i in range(2000):
        v = -1 if i % 10 == 0 else 1
        patterns[(v, v, -1 if rng.random() < 0.03 else 1)] += 1
    prior, shares = quality.fit_rules(list(patterns.items()), 3)
    assert abs(prior - 0.9) < 0.02
    assert quality.posterior_of((-1, -1, 1), prior, shares) < 0.1 < 0.9 < quality.posterior_of((1, 1, 1), prior, shares)


def test_shards(docs):
    rows = sharding.balanced_shards(docs, shards=4).collect()
    want = Counter((r.doc_id, len(data(r.text)) + 1, zlib.crc32(data(r.text))) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    for shard in range(4):
        own = [r for r in rows if r.shard == shard]
        assert abs(sum(r.size for r in own) - total / 4) <= largest
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_poisson_draws(spark, docs):
    rates = spark.createDataFrame([(0.3,), (1.0,), (7.5,), (900.0,)], "rate double")
    draws = rates.join(spark.range(3000)).withColumn("k", mixing.inverse_poisson(mixing.hashed_uniform(3, F.col("id")), F.col("rate")))
    for r in draws.groupBy("rate").agg(F.avg("k").alias("m"), F.var_samp("k").alias("v")).collect():
        assert abs(r.m - r.rate) < 5 * (r.rate / 3000) ** 0.5
        assert abs(r.v / r.rate - 1) < 0.15
    mixed = mixing.poisson_mix(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    assert mixed.groupBy("source").count().count() == 2
    targets = spark.createDataFrame([("big", 1.0)], "source string, weight double")
    assert mixing.poisson_mix(docs, targets=targets).filter("source IS NULL AND text <> ''").isEmpty()


@pytest.mark.parametrize("equal_rows", [3, mixing.EQUAL_ROWS])
def test_rows_that_share_an_id_draw_apart(spark, equal_rows):
    rows = [(None, "same", "en", "a", 4, 1, "r")] * 1500 + [(None, f"t{i}", "en", "b", 4, 1, "r") for i in range(500)]
    rows += [(7, "seven", "en", "a", 4, 1, "r")] * 10 + [(i, "once", "en", "a", 4, 1, "r") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    draws = lambda d: mixing.with_draws(d, "doc_id", 1, "u", equal_rows)
    drawn = draws(docs).collect()
    assert sorted((r[:-1] for r in drawn), key=repr) == sorted((tuple(r) for r in docs.collect()), key=repr)
    assert sorted(map(tuple, drawn), key=repr) == as_set(draws(docs.repartition(2)), *docs.columns, "u")
    assert len({r.u for r in drawn}) == len(drawn)
    for r in drawn:
        if r.doc_id is not None and r.doc_id >= 100:
            assert r.u == int(hashlib.md5(f"1|{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    mixed = mixing.poisson_mix(docs)
    parts = mixed.filter("doc_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = {r.text: r["count"] for r in mixed.groupBy("text").count().collect()}
    assert 1000 < copies["same"] < 2000 and 100 < sum(1 for i in range(500) if copies.get(f"t{i}", 0) != 1) < 500


def brute_print(text):
    words = data(text).lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs):
    rows = docs.collect()
    prints = [brute_print(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), r.doc_id)
    want = sorted(((r.doc_id, f"{p:016x}", least[find(i)]) for i, (r, p) in enumerate(zip(rows, prints))), key=repr)
    assert as_set(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id") == want
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_one_row_of_every_component_stays(spark):
    say = lambda k: " ".join(f"t{k}x{i}" for i in range(60))
    rows = [
        (None, say(0)), (3, say(0)), (None, say(1)), (None, say(1)), (None, say(2)),  # ids missing
        (5, say(3)), (6, say(3)), (5, say(4)), (4, say(4)),  # 5 is smallest in one component only
        (7, say(5)), (8, say(5)), (7, say(6)),  # two components with the same smallest id
    ]
    # Rows that differ only in which of two columns is null are two rows.
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(None, say(7), 9), (9, say(8), None)], "doc_id long, text string, n long")
    got = Counter((r.doc_id, r.text) for r in simhash.keep_one_each(frame).collect())
    want = [(3, say(0)), (None, say(1)), (None, say(2)), (5, say(3)), (4, say(4)), (7, say(5)), (7, say(6)), (None, say(7)), (9, say(8))]
    assert got == Counter(want)


def test_gray_index_finds_every_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (300, 3), dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ flips[:, 0], base ^ flips[:, 1] ^ flips[:, 2], base ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]]))
    q, place = simhash.probe(fps, fps, fps)
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None]) <= 2)
    assert sorted(zip(q.tolist(), place.tolist())) == sorted(map(tuple, near.tolist()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, 3), (3, 9), (7, 3), (None, 4)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 3: 3, 7: 3, 9: 3}


def test_components_of_long_chains_and_stars(spark):
    def chain(ids):
        return list(zip(ids, ids[1:]))

    both_ends = [0, *range(10, 1008), 1]  # its two smallest vertices are its two ends
    rng = random.Random(4)
    mixed = rng.sample(range(20_000, 30_000), 1_000)
    star = [(50_000, 60_000 + i) for i in range(10_000)]
    edges = chain(both_ends) + chain(mixed) + star
    rng.shuffle(edges)
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {v: 0 for v in both_ends} | {v: min(mixed) for v in mixed} | {v: 50_000 for e in star for v in e}
    assert got == want


def test_rounds_on_a_chain_grow_with_its_bits(spark, monkeypatch):
    staged, stage = [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, name: staged.append(name) or stage(df, name))
    ids = [0, *range(2, 400), 1]
    found = graph.components(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long"))
    assert found.select("component").distinct().count() == 1
    assert staged.count("reached") <= 2 * 9


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


@pytest.mark.parametrize("size", [1024, 4096])
def test_long_words_with_equal_sums_are_different_words(spark, size):
    one, other = thue_morse(size, "ab"), thue_morse(size, "ba")
    rng = random.Random(9)
    before, after = ([rng.choice(WORDS) for _ in range(40)] for _ in range(2))
    texts = [" ".join([*before, word, *after]) for word in (one, other, one)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring.removal_report(frame).collect()}
    assert got == {0: 0, 1: 0, 2: 81}
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    learned = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    frame = spark.createDataFrame([(learned, f"known {one}"), (held, f"known {other}")], "doc_id long, text string")
    assert {r.doc_id: r.n_known for r in lm.score(frame).collect()} == {learned: 3, held: 2}


@pytest.fixture(params=[1 << 9, 8 << 20])
def part_bytes(request, monkeypatch):
    """Contents per range partition: so few that groups go on across many, and the default."""
    monkeypatch.setattr(repeats, "PART_BYTES", request.param)


def test_suffix_dedup(docs, part_bytes):
    rows = docs.collect()
    starts = Counter(data(r.text)[i : i + 200] for r in rows for i in range(len(data(r.text)) - 199))

    def brute(text):
        d = data(text)
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if starts[d[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        runs = sum(g and not p for g, p in zip(gone, b"\0" + gone))
        return len(d), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()

    want = sorted(((r.doc_id, *brute(r.text)) for r in rows), key=repr)
    assert as_set(suffixes.removal_report(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    cleaned = suffixes.remove_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()


def test_first_occurrences_stay_where_asked(spark, docs, part_bytes):
    rows = [tuple(r) for r in docs.collect()]
    rows += [(None, r[1], *r[2:]) for r in rows[-6:]] + [(None, "z" * 300, "en", "a", 300, 1, "r")] * 2
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    last = 1 << 63
    place = lambda r: last if r[0] is None else r[0]
    first = {}
    for r in sorted(rows, key=place):
        d = data(r[1])
        for i in range(len(d) - 199):
            first.setdefault(d[i : i + 200], place(r))

    def brute(r):
        d = data(r[1])
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if first[d[i : i + 200]] < place(r):
                gone[i : i + 200] = b"\1" * 200
        rest = bytes(b for b, g in zip(d, gone) if not g).decode("utf-8", "ignore")
        return r[0], None if r[1] is None else rest

    cleaned = suffixes.remove_repeats(frame, keep_first=True)
    assert as_set(cleaned, "doc_id", "text") == sorted(map(brute, rows), key=repr)
    assert sorted(len(r.text) for r in cleaned.collect() if r.text and set(r.text) == {"z"}) == [300, 300]


def test_substring_dedup(docs, part_bytes):
    rows = docs.collect()
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        w = data(r.text).split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), r.doc_id)

    def brute(r):
        w = data(r.text).split()
        gone = bytearray(len(w))
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < r.doc_id:
                gone[i : i + 50] = b"\1" * 50
        return len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()

    want = sorted(((r.doc_id, *brute(r)) for r in rows), key=repr)
    assert as_set(substring.removal_report(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want


@pytest.mark.parametrize("earlier", [True, False])
def test_windows_of_a_line_that_many_share_are_sorted_in_slices(monkeypatch, earlier):
    monkeypatch.setattr(repeats, "SORT_WINDOWS", 500)
    at_once, equal_windows = [], repeats.equal_windows
    monkeypatch.setattr(repeats, "equal_windows", lambda d, starts, *a: at_once.append(len(starts)) or equal_windows(d, starts, *a))
    rng = random.Random(3)
    some = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    line = some(240)
    blobs = [data(some(60) + line + some(60)) for _ in range(60)] + [b"z" * rng.randint(400, 900) for _ in range(12)]
    n, size = len(blobs), [len(b) - 199 for b in blobs]
    contents = {"key": np.full(n, 7), "content": np.arange(n), "n": np.ones(n, np.int64), "doc": np.arange(n) % 50, "row": np.arange(n),
                "first": np.full(n, 3), "windows": np.array(size), "blob": blobs}
    places = {}
    for i, b in sorted(enumerate(blobs), key=lambda x: x[0] % 50):
        for j in range(size[i]):
            places.setdefault(b[j : j + 200], []).append((i, j))
    want = {w for same in places.values() for w in same if (same[0][0] % 50 < w[0] % 50 if earlier else len(same) > 1)}

    gone, told = [], []
    for intervals, edge in repeats.match_windows(suffixes.BYTES, earlier, contents, np.array([7])):
        for _, content, low, high, *_ in zip(*intervals or [[]]):
            gone += [(content, offset) for offset in range(low, high + 1)]
        if edge is not None:
            assert len(edge) <= 4 * 500
            told += edge.tolist()
    assert set(gone) == want and len(gone) == len(want)
    assert sorted(t[2] for t in told if not t[-1]) == sorted(map(len, places.values()))
    assert {(t[7], t[8]) for t in told if t[-1]} == {w for same in places.values() for w in same} - want
    assert sum(size) > 10 * 500 and max(at_once) <= 4 * 500


def test_packing(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    rows = packing.pack(docs, tokenizer()).collect()
    want = Counter()
    for r in docs.collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 2]
        n, cuts = len(ids), [0, len(ids)]
        if n > 1024:
            cuts = [0, *range(n % 1024 or 1024, n, 1024), n]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r.doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 1024
    assert len(bins) <= -(-sum(r.length for r in rows) // 1024) + 1


def test_word_tokenizer_equals_the_tokenizer():
    encode = packing.WordTokenizer(tokenizer())
    for text in ["a  b", " x y", "x y ", "a \n b", "a\t b c", "", "   ", "<|endoftext|> a b", "é à ü", "a  b", "x 　y z",
                 "it's 12 3!! a", "\n\n a", "日本 語 a", "a b c a b"]:
        assert encode(text) == np.array(encode.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_local_search_empties_bins():
    sizes = [6, 5, 5, 4, 3, 3, 4]
    bins = packing.local_search([[0, 4], [1, 3], [2, 5], [6]], sizes, 10)
    assert len(bins) == 3 and all(sum(sizes[i] for i in b) <= 10 for b in bins)
    assert sorted(i for b in bins for i in b) == list(range(7))


def test_local_search_tries_every_pair_of_bins():
    # Twenty groups of four bins that make three, each only by an exchange, with every bin underfull.
    sizes, bins = [], []
    for _ in range(20):
        for b in ([6, 3], [5, 4], [5, 3], [4]):
            bins.append(list(range(len(sizes), len(sizes) + len(b))))
            sizes += b
    packed = packing.local_search(bins, sizes, 10)
    assert sorted(i for b in packed for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 10 for b in packed)
    assert len(packed) == sum(sizes) // 10
    # Two documents are given for one.
    assert len(packing.local_search([[0, 1], [2]], [3, 3, 7], 10)) == 2
    packed = packing.local_search([[0, 1, 2], [3], [4]], [3, 3, 2, 7, 2], 10)
    assert len(packed) == 2


def test_groups_meet_until_nothing_is_gained(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 40)
    rng = random.Random(4)
    sizes = [rng.randint(256, 512) for _ in range(400)]
    placed = packing.assign(spark.createDataFrame(list(enumerate(sizes)), "id long, length long")).collect()
    fills = Counter()
    for r in placed:
        fills[r.sequence_id] += sizes[r.id]
    assert sorted(r.id for r in placed) == list(range(400)) and max(fills.values()) <= 1024
    # As good as one group that holds everything, though every group holds forty pieces.
    assert len(fills) <= len(packing.local_search(packing.best_fit(sizes, 1024), sizes, 1024))


def test_warc_round_trip_and_salvage(spark, tmp_path):
    big = "<p>é</p>" * 300
    pages = [(1, "u", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (7, "u\r\nx", "z" * 1000)]
    got = {int(r.record_id): r for r in warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {1: ("revisit", "2")}
    for i, _, html in pages:
        assert got[i].payload_bytes == len(data(html)) and got[i].payload_digest == hashlib.sha1(data(html)).hexdigest()
        assert got[i].record_type == "revisit" or got[i].payload == data(html)

    def archive(name, records):
        path = tmp_path / name
        path.write_bytes(b"".join(records))
        return (f"file://{path}", path.stat().st_size)

    plain = [warc.record(i, "u", b"body%d" % i * 9, hashlib.sha1(b"body%d" % i * 9).hexdigest(), "response", 45, None) for i in range(6)]
    broken = bytearray(plain[2])
    broken[-10] ^= 1
    zipped = [warc.member(r) for r in plain]
    torn = bytearray(zipped[3])
    torn[40] ^= 255
    files = [archive("a.warc", [*plain[:2], bytes(broken), *plain[3:]]), archive("b.warc.gz", [*zipped[:3], bytes(torn), *zipped[4:]]),
             archive("c.warc.gz", [b"noise", *zipped[:1], zipped[1][:-3]])]
    rows = warc.read_archives(spark, spark.createDataFrame(files, "archive string, bytes long")).collect()
    of = lambda n: [r for r in rows if n in r.archive]
    assert sorted(r.record_id for r in of("a.warc") if r.record_type) == ["0", "1", "3", "4", "5"]
    assert [(r.position, r.gap_bytes) for r in of("a.warc") if r.gap_bytes] == [(len(plain[0]) + len(plain[1]), len(broken))]
    assert sorted(r.record_id for r in of("b.warc") if r.record_type) == ["0", "1", "2", "4", "5"]
    assert [r.gap_bytes for r in of("b.warc") if r.gap_bytes] == [len(torn)]
    assert sorted(r.gap_bytes for r in of("c.warc") if r.gap_bytes) == [5, len(zipped[1]) - 3]


def test_warc_ranges_meet(tmp_path, monkeypatch):
    records = [warc.member(warc.record(i, "u", os.urandom(300), hashlib.sha1(b"").hexdigest(), "revisit", 300, 1)) for i in range(50)]
    path = tmp_path / "r.warc.gz"
    path.write_bytes(b"".join(records))
    size, seen = path.stat().st_size, []
    for begin in range(0, size, 777):
        with path.open("rb") as f:
            seen += [r[1]["warc-record-id"] for r in warc.read_range(f, size, begin, begin + 777, True)]
    assert seen == [f"<urn:page:{i}>" for i in range(50)]


def test_warc_gaps_at_range_borders(tmp_path):
    records = [warc.member(warc.record(i, "u", os.urandom(300), hashlib.sha1(b"").hexdigest(), "revisit", 300, 1)) for i in range(50)]
    starts = np.cumsum([0, *map(len, records)]).tolist()

    def read(broken, step):
        torn = [r[:60] + bytes([r[60] ^ 255]) + r[61:] if i in broken else r for i, r in enumerate(records)]
        path = tmp_path / "t.warc.gz"
        path.write_bytes(b"".join(torn))
        with path.open("rb") as f:
            rows = [row for begin in range(0, starts[-1], step) for row in warc.read_range(f, starts[-1], begin, begin + step, True)]
        assert [r[1]["warc-record-id"] for r in rows if r[1]] == [f"<urn:page:{i}>" for i in range(50) if i not in broken]
        return [(r[0], r[3]) for r in rows if r[1] is None]

    # The first member after a border that a record ends at, and after one that a record crosses.
    for step in (starts[10], starts[10] - 100):
        assert read({10}, step) == [(starts[10], len(records[10]))]
    # Damage over whole ranges, in the middle and up to the end.
    assert read({*range(20, 30)}, 777) == [(starts[20], starts[30] - starts[20])]
    assert read({*range(40, 50)}, 777) == [(starts[40], starts[50] - starts[40])]
    # Ranges of any size log the same.
    broken = {0, 5, 6, 17, 30, 49}
    assert all(read(broken, step) == read(broken, starts[-1]) for step in range(300, 3000, 97))


def test_warc_records_of_any_length(tmp_path):
    def read(data, compressed):
        path = tmp_path / "long.warc"
        path.write_bytes(data)
        with path.open("rb") as f:
            return list(warc.read_range(f, len(data), 0, len(data), compressed))

    def response(i, payload, url="u"):
        return warc.record(i, url, payload, hashlib.sha1(payload).hexdigest(), "response", len(payload), None)

    large = bytes(257 << 20)
    rows = read(warc.member(response(1, large)) + warc.member(response(2, b"after")), True)
    assert [(r[1] and r[1]["warc-record-id"], r[3]) for r in rows] == [("<urn:page:1>", 0), ("<urn:page:2>", 0)]
    assert rows[0][2] == large
    # Headers of more than one chunk, and a break between any two pieces.
    for n in (100_000, *range(warc.CHUNK - 400, warc.CHUNK, 7)):
        assert [r[2] for r in read(response(1, b"body", "u" * n) + response(2, b"after"), False)] == [b"body", b"after"]
    # The search behind the start of a long member that fails near its end.
    torn = bytearray(warc.member(response(1, os.urandom(9 << 20))))
    torn[-3000] ^= 255
    rows = read(bytes(torn) + warc.member(response(2, b"after")), True)
    assert [(r[0], r[2], r[3]) for r in rows] == [(0, None, len(torn)), (len(torn), b"after", 0)]


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x[7] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3001, None), (3002, [0.0] * 24), (3003, [float("nan")] * 24), (3004, [1.0]), (None, x[1].tolist())]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).collect()
    hits = 0
    for q in range(0, 3000, 100):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        distance = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert all(abs(r.score - distance[r.vec_id]) < 1e-12 for r in own) and q not in [r.vec_id for r in own]
        distance[q] = np.inf
        hits += len({r.vec_id for r in own} & set(np.argsort(distance)[:10].tolist()))
    assert hits >= 0.9 * 300
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert ann.nearest(few, F.col("vec_id") % 100 == 0).count() == 3


def test_language_model(docs):
    rows = docs.collect()
    tokens = {id(r): [*data(r.text).lower().split(), None] for r in rows}
    train = [r for r in rows if not lm.held_out(r.doc_id)]
    c = Counter(t for r in train for t in tokens[id(r)])
    n, v = sum(c.values()), len(c)
    want = {}
    for r in rows:
        t = tokens[id(r)]
        want[r.doc_id] = (lm.held_out(r.doc_id), len(t), sum(c[x] > 0 for x in t), n, sum(np.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t))
    got = lm.score(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert abs(r.base_score - want[r.doc_id][4]) < 1e-6 and r.score < 0
    # Repeated passages are known to the bigram model: it does better on what it learned from.
    assert sum(r.score for r in got if not r.held_out) > sum(r.base_score for r in got if not r.held_out)


def test_counts_beyond_32_bits():
    key, counts = np.array([7], np.uint64).tobytes(), np.array([3_000_000_000], np.uint32).tobytes()
    rows = [{"shard": 0, "kind": 1, "block": b, "keys": key, "train": counts, "gone": counts} for b in range(2)]
    answers = lm._add_up(pa.Table.from_pylist(rows)).to_pylist()
    assert [x.tolist() for x in lm._answers_of(answers[:1])[:2]] == [[6_000_000_000]] * 2
    assert sum(a["total"] for a in answers) == 6_000_000_000
    # A block outside the deleted part is not told what was seen there.
    rows.append({**rows[0], "block": 2, "gone": np.zeros(1, np.uint32).tobytes()})
    answers = lm._add_up(pa.Table.from_pylist(rows)).to_pylist()
    assert [np.frombuffer(a["gone"], np.int64).tolist() for a in answers] == [[6_000_000_000]] * 2 + [[]]


def test_language_model_without_a_deleted_part(spark):
    ids = [i for i in range(40) if not lm.deleted_part(i)][:12]
    got = lm.score(spark.createDataFrame([(i, "one two one two three") for i in ids], "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == ids and all(r.n_tokens == 6 and -20 < r.score < 0 for r in got)


@pytest.mark.parametrize("at_once", [1, 7, 1000])
def test_a_shard_is_added_up_by_ranges_of_keys(monkeypatch, at_once):
    monkeypatch.setattr(lm, "ADDED_AT_ONCE", at_once)
    monkeypatch.setattr(lm, "ANSWERS_AT_ONCE", 3)
    rng, rows = np.random.default_rng(5), []
    pool = np.concatenate([rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2), np.array([0, 2**64 - 1], np.uint64)])
    for block in range(8):
        keys = np.unique(rng.choice(pool, 20))
        counts = [rng.integers(0, 5, len(keys)).astype(np.uint32) for _ in range(2)]
        rows.append({"shard": 1, "kind": 2, "block": block, "keys": keys.tobytes(), "train": counts[0].tobytes(), "gone": counts[1].tobytes()})
    # As Spark hands it over: in several batches, some of them cut out of longer ones.
    whole = pa.Table.from_pylist(rows)
    table = pa.concat_tables([whole.slice(0, 3), whole.slice(3, 5)])
    for given in (table, whole.slice(2, 6), whole):
        wanted = rows[2:] if given.num_rows == 6 else rows
        counts = [Counter(), Counter()]
        for r in wanted:
            for c, name in zip(counts, ("train", "gone")):
                for k, n in zip(np.frombuffer(r["keys"], np.uint64).tolist(), np.frombuffer(r[name], np.uint32).tolist()):
                    c[k] += n
        answers = lm._add_up(given).to_pylist()
        assert [a["block"] for a in answers] == [r["block"] for r in wanted]
        for answer, r in zip(answers, wanted):
            keys = np.frombuffer(r["keys"], np.uint64).tolist()
            for c, name in zip(counts, ("train", "gone")):
                assert np.frombuffer(answer[name], np.int64).tolist() == [c[k] for k in keys]
        assert sum(a["total"] for a in answers) == counts[0].total() and sum(a["gone_total"] for a in answers) == counts[1].total()
        assert sum(a["distinct"] for a in answers) == sum(n > 0 for n in counts[0].values())


def test_language_model_scores_equal_brute_force(spark):
    """Counts, EM on the deleted part and scores in plain Python."""
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choices(WORDS[:40], weights=range(1, 41), k=rng.randrange(0, 30)))) for i in range(120)]
    rows += [(None, "w1 w2"), (7, None), (7, "never W39 seen")]
    rest = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    said = [(rest(i), [*(t or "").lower().split(), "</s>"]) for i, t in rows]
    pairs = lambda words: list(zip(["</s>", *words], words))

    def counted(keep):
        word, pair = Counter(), Counter()
        for r, words in said:
            if keep(r):
                word.update(words)
                pair.update(pairs(words))
        return word, pair

    word, pair = counted(lambda r: r != 0)
    kept_word, kept_pair = counted(lambda r: r > 1)
    total, kept_total, distinct = word.total(), kept_word.total(), len(word)
    bucket = lambda c: 0 if c <= 0 else min(c.bit_length(), lm.BUCKETS - 1)

    def shares(w, p, n, a, b):
        return p[a, b] / w[a] if w[a] else 0.0, w[b] / max(n, 1), (w[b] + lm.ALPHA) / (n + lm.ALPHA * (distinct + 1))

    weights = np.tile([0.4, 0.4, 0.2], (lm.BUCKETS, 1))
    cells = [(bucket(kept_word[a]), shares(kept_word, kept_pair, kept_total, a, b)) for r, ws in said if r == 1 for a, b in pairs(ws)]
    for _ in range(30):
        sums = {}
        for k, p in cells:
            parts = weights[k] * np.array(p)
            sums[k] = sums.get(k, 0) + parts / parts.sum()
        new = weights.copy()
        for k, got in sums.items():
            new[k] = (got + 1e-3) / (got + 1e-3).sum()
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-3:
            break
    want = sorted(
        (repr(i), len(ws), sum(np.log10(weights[bucket(word[a])] @ np.array(shares(word, pair, total, a, b))) for a, b in pairs(ws)))
        for (i, _), (_, ws) in zip(rows, said)
    )
    got = sorted((repr(r.doc_id), r.n_tokens, r.score) for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-6)
