"""Engine for passages that repeat exactly within or across documents of any number.

Documents are sequences of symbols (bytes, or words). Every window of fixed length is judged by the
sequence it holds. Windows are too many to shuffle, so they travel bundled: consecutive windows with
the same minimizer (the smallest hash among a window's k-mers) form a run. Equal windows have equal
minimizers, so only runs whose minimizer occurs elsewhere matter, and a run whose whole content
recurs stands for all its windows. Runs that share a minimizer but not their content are fetched,
range-partitioned by the symbols from their minimizer on (sampled splitters), and their windows are
sorted and compared inside each partition; the groups at a partition's two ends are compared across
partitions by window digests. No step holds more than one partition's share of runs, and of the windows
of a key that many runs share it sorts and tells a slice at a time.

Row identity is a hash of (doc_id, text), so repeated ids and repeated rows do not mix spans.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm.common import (
    BYTE_HASH, mix, ngram_hash, shuffle_partitions, sliding_min, stage, word_hashes, word_spans,
)

#: Bytes of run contents in one range partition, windows sorted at once inside it, and edge records settled at once.
PART_BYTES, SORT_WINDOWS, SETTLE_EDGES = 8 << 20, 50_000, 100_000
#: Odd factor of the hash that deals windows to slices.
HASH_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of contents fetched, or of words hashed, at once.
AT_ONCE_BYTES = 1 << 20


@dataclass(frozen=True)
class Units:
    """What a document consists of, the length of a window and of the k-mers it is bundled by."""

    words: bool
    window: int
    kmer: int

    def symbols(self, data):
        return word_hashes(data) if self.words else BYTE_HASH[np.frombuffer(data, np.uint8)]

    def plain(self, text):
        """The text as bytes; of words, joined by one space."""
        data = (text or "").encode("utf-8", "surrogatepass")
        return b" ".join(data.split()) if self.words else data

    def places(self, data):
        """Byte offsets at which symbol i starts and ends."""
        if self.words:
            return word_spans(data)
        return np.arange(len(data)), np.arange(1, len(data) + 1)

    def cuts(self, data):
        """A function from the symbols at which windows of ``data`` start to their byte offsets, (start, end) each."""
        if not self.words:
            return lambda first: zip(first.tolist(), (first + self.window).tolist())
        start, end = word_spans(data)
        return lambda first: zip(start[first].tolist(), end[first + self.window - 1].tolist())


def identified(docs, id_col, text_col):
    """(row, doc_id, text); ids that are null sort behind all others."""
    largest = F.lit((1 << 63) - 1)
    doc = F.coalesce(F.col(id_col).cast("long"), largest)
    return docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), doc.alias("doc"), F.col(text_col).alias("text"))


# -- runs


def runs_of(units, data):
    """(first window, last window, minimizer, k-mer occurs twice) of every run of ``data``, as arrays."""
    x = units.symbols(data)
    if len(x) < units.window:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), np.empty(0, bool)
    kmers = ngram_hash(x, units.kmer)
    width = units.window - units.kmer + 1
    least = sliding_min(kmers, width)
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change - 1, [len(least) - 1]])
    # A window can only recur inside its own run if the run's minimizer does.
    place = np.flatnonzero(np.isin(kmers, least[first]))
    at_key = kmers[place]
    many = np.zeros(len(first), bool)
    left, right = np.searchsorted(place, first), np.searchsorted(place, last + width)
    for i in np.flatnonzero(right - left > 1):
        many[i] = np.count_nonzero(at_key[left[i] : right[i]] == least[first[i]]) > 1
    return first, last, least[first], many


def _runs(units):
    def of_batches(batches):
        for batch in batches:
            rows, docs, out = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
            for row, doc, text in zip(rows, docs, batch.column(2)):
                data = units.plain(text.as_py())
                first, last, key, many = runs_of(units, data)
                if not len(first):
                    continue
                start, end = units.places(data)
                cuts = zip(start[first].tolist(), end[last + units.window - 1].tolist())
                digest = b"".join(hashlib.blake2b(data[a:b], digest_size=8).digest() for a, b in cuts)
                n = len(first)
                out.append((np.full(n, row), np.full(n, doc), first.astype(np.int32), last.astype(np.int32),
                            key.view(np.int64), np.frombuffer(digest, np.int64), many))
                if sum(len(o[0]) for o in out) >= 50_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    names = ["row", "doc", "first", "last", "key", "content", "many"]

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

    return of_batches


RUN_SCHEMA = "row bigint, doc bigint, first int, last int, key bigint, content bigint, many boolean"


# -- windows of runs that share a minimizer


def equal_windows(digits, starts, step, depth, group):
    """Number of the class of every window, equal for equal windows of one group, by multikey quicksort.

    Digit t of window w is ``digits[starts[w] + step * t]``, t < depth. Each round sorts what is still
    tied by one digit; windows that differ leave, ties go on to the next digit. Ties found equal
    in all digits left are done at once.
    """
    label = np.full(len(starts), -1, np.int64)
    alive, tied, used, t = np.arange(len(starts)), group.astype(np.int64), 0, 0
    while len(alive):
        digit = digits[starts[alive] + step * t]
        order = np.lexsort((digit, tied))
        alive, tied, digit = alive[order], tied[order], digit[order]
        new = np.ones(len(alive), bool)
        new[1:] = (tied[1:] != tied[:-1]) | (digit[1:] != digit[:-1])
        tied = np.cumsum(new) - 1
        size = np.bincount(tied)
        t += 1
        same = np.ones(len(alive), bool)
        if t < depth:
            head = np.flatnonzero(new)[tied]
            open_ = np.flatnonzero(size[tied] > 1)
            for later in range(t, depth):
                a, b = starts[alive[open_]], starts[alive[head[open_]]]
                same[open_] &= digits[a + step * later] == digits[b + step * later]
        done = (np.bincount(tied, weights=~same) == 0)[tied]
        label[alive[done]] = used + tied[done]
        used += len(size)
        alive, tied = alive[~done], tied[~done]
    return label


def _digits(units, blobs, joint):
    """(digits, step, number of digits per window) for the contents joined in ``joint``."""
    if units.words:
        size = np.cumsum([len(b) for b in blobs])
        some = np.split(np.arange(len(blobs)), np.flatnonzero(np.diff(size // AT_ONCE_BYTES)) + 1)
        return np.concatenate([word_hashes(b" ".join(blobs[i[0] : i[-1] + 1])) for i in some]), 1, units.window
    assert units.window % 8 == 0
    # Eight bytes from every byte on, seen in place. Written out they sort faster and take eight times the contents.
    eight = np.ndarray(len(joint), ">u8", joint + b"\0" * 8, strides=(1,))
    return eight.astype(np.uint64) if len(joint) <= PART_BYTES else eight, 8, units.window // 8


def _run_chunks(begin, most):
    """(first, stop) of runs with about ``most`` windows together; ``begin`` numbers their first windows."""
    at = 0
    while at < len(begin) - 1:
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + most, "right")) - 1)
        yield at, to
        at = to


class _Windows:
    """The windows of some whole groups of runs, numbered through; see ``match_windows``."""

    def __init__(self, units, contents):
        self.units, self.contents = units, contents
        count = contents["windows"]
        self.begin = np.concatenate([[0], np.cumsum(count)])
        self.joint = (b" " if units.words else b"").join(contents["blob"])
        self.digits, self.step, self.depth = _digits(units, contents["blob"], self.joint)
        self.symbol = np.concatenate([[0], np.cumsum(count + units.window - 1)[:-1]])
        self.group = np.unique(contents["key"], return_inverse=True)[1]

    def __len__(self):
        return int(self.begin[-1])

    def owned(self, windows):
        """(run, place in the run) of windows."""
        owner = np.searchsorted(self.begin, windows, "right") - 1
        return owner, windows - self.begin[owner]

    def starts(self, windows):
        """The symbols of ``joint`` they start at."""
        owner, offset = self.owned(windows)
        return self.symbol[owner] + offset

    def labels(self, windows):
        owner, offset = self.owned(windows)
        return equal_windows(self.digits, self.symbol[owner] + offset, self.step, self.depth, self.group[owner])

    def slices(self):
        """All windows, about SORT_WINDOWS at a time but equal ones always together: dealt by a hash of all their digits."""
        parts = -(-len(self) // SORT_WINDOWS)
        if parts <= 1:
            yield np.arange(len(self))
            return
        part = np.empty(len(self), np.min_scalar_type(parts))
        for a, b in _run_chunks(self.begin, SORT_WINDOWS):
            starts = self.starts(np.arange(self.begin[a], self.begin[b]))
            h = np.zeros(len(starts), np.uint64)
            with np.errstate(over="ignore"):
                for t in range(self.depth):
                    h = h * HASH_STEP + self.digits[starts + self.step * t]
            part[self.begin[a] : self.begin[b]] = mix(h) % np.uint64(parts)
        order = np.argsort(part, kind="stable").astype(np.min_scalar_type(len(self)))
        ends = np.cumsum(np.bincount(part, minlength=parts))
        del part
        for a, b in zip([0, *ends[:-1]], ends):
            if b > a:
                yield order[a:b].astype(np.int64)

    def classes(self, chosen):
        """(windows, source of each, occurrences of its class) for the windows of a slice, in pieces.

        The source of a class is its place with the smallest (doc, row, position). A slice far over
        SORT_WINDOWS holds few classes, each of many windows: pieces are compared with one window per class.
        """
        of = self.contents
        pieces = np.array_split(chosen, -(-len(chosen) // (2 * SORT_WINDOWS)))
        source, weight = np.empty(0, np.int64), np.empty(0, np.int64)
        for piece in pieces:
            both = np.concatenate([source, piece])
            label = self.labels(both)
            owner, offset = self.owned(both)
            order = np.lexsort((of["first"][owner] + offset, of["row"][owner], of["doc"][owner], label))
            lead = np.ones(len(order), bool)
            lead[1:] = label[order][1:] != label[order][:-1]
            counts = np.concatenate([weight, of["n"][owner[len(source) :]]])
            source, weight = np.empty(label.max() + 1, np.int64), np.bincount(label, weights=counts).astype(np.int64)
            source[label[order[lead]]] = both[order[lead]]
            # Only labels in use go on.
            used = np.zeros(len(source), bool)
            used[label] = True
            number = np.cumsum(used) - 1
            source, weight = source[used], weight[used]
        if len(pieces) == 1:
            yield chosen, number[label], source, weight
            return
        for piece in pieces:
            label = self.labels(np.concatenate([source, piece]))
            number = np.empty(label.max() + 1, np.int64)
            number[label[: len(source)]] = np.arange(len(source))
            yield piece, number[label[len(source) :]], source, weight


def match_windows(units, earlier, contents, edges):
    """Decide the windows of some whole groups of runs.

    ``contents``: arrays key, content, n, doc, row, first, windows and a list ``blob``. ``earlier``:
    a window goes if a smaller doc has it; otherwise if any other place has it. ``edges``: keys that
    may go on in another partition. Yields (columns of intervals, ``EDGE`` records), either may be None.
    """
    windows = _Windows(units, contents)
    edge = np.isin(contents["key"], edges)
    cuts = units.cuts(windows.joint) if edge.any() else None
    source_of = np.full(len(windows), -1, np.min_scalar_type(-len(windows) - 1))
    for chosen in windows.slices():
        told = np.empty(0, np.int64)
        for piece, label, source, weight in windows.classes(chosen):
            owner = windows.owned(piece)[0]
            if earlier:
                gone = contents["doc"][windows.owned(source)[0]][label] < contents["doc"][owner]
            else:
                # A content that recurs as a whole is decided as a whole.
                gone = (weight[label] > 1) & (contents["n"][owner] == 1)
            source_of[piece[gone]] = source[label[gone]]
            if cuts is None:
                continue
            at_edge = edge[owner]
            # A class is told once, though its windows may come in several pieces.
            classes = np.setdiff1d(label[at_edge], told)
            told = np.union1d(told, classes)
            left = piece[at_edge & ~gone & (np.bool_(earlier) | (contents["n"][owner] == 1))]
            if len(classes) + len(left):
                yield None, np.concatenate(
                    [_edges(windows, cuts, source[classes], weight[classes], 0), _edges(windows, cuts, left, 0, 1)]
                )
    for a, b in _run_chunks(windows.begin, SORT_WINDOWS):
        first = windows.begin[a]
        gone = np.flatnonzero(source_of[first : windows.begin[b]] >= 0) + first
        if len(gone):
            yield _intervals(windows, gone, source_of[gone], earlier), None


INTERVAL_FIELDS = ["key", "content", "low", "high", "src_doc", "src_row", "src_place"]
INTERVAL_SCHEMA = "key bigint, content bigint, low int, high int, src_doc bigint, src_row bigint, src_place int"
INTERVAL_TYPES = [np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int32]
#: What a window at a partition's edge tells the others: its digest, how often it occurs, where, and
#: whether its own fate is open.
EDGE = np.dtype([(n, np.int64) for n in ("h1", "h2", "weight", "doc", "row", "place", "key", "content", "offset", "open")])
MATCH_SCHEMA = INTERVAL_SCHEMA + ", shard int, edge binary"


def _intervals(windows, gone, source, earlier):
    """Runs of consecutive windows that go; of words, from consecutive places of one source."""
    contents = windows.contents
    owner, offset = windows.owned(gone)
    src_owner, src_place = windows.owned(source)
    src_doc, src_row = contents["doc"][src_owner], contents["row"][src_owner]
    src_place = src_place + contents["first"][src_owner]
    cut = np.ones(len(gone), bool)
    cut[1:] = gone[1:] != gone[:-1] + 1
    cut[1:] |= owner[1:] != owner[:-1]
    if earlier:
        cut[1:] |= (src_row[1:] != src_row[:-1]) | (src_place[1:] != src_place[:-1] + 1)
    low = np.flatnonzero(cut)
    high = np.concatenate([low[1:] - 1, [len(gone) - 1]])
    who = owner[low]
    values = (contents["key"][who], contents["content"][who], offset[low], offset[high], src_doc[low], src_row[low], src_place[low])
    return [np.asarray(v, t) for v, t in zip(values, INTERVAL_TYPES)]


def _edges(windows, cuts, chosen, weights, is_open):
    """``EDGE`` records of windows that may occur in another partition: one per class, one per open window."""
    contents, joint = windows.contents, windows.joint
    owner, offset = windows.owned(chosen)
    digest = b"".join(
        hashlib.blake2b(joint[i:j], digest_size=16).digest() for i, j in cuts(windows.symbol[owner] + offset)
    )
    out = np.empty(len(chosen), EDGE)
    out["h1"], out["h2"] = np.frombuffer(digest, np.int64).reshape(-1, 2).T
    values = (weights, contents["doc"][owner], contents["row"][owner], contents["first"][owner] + offset,
              contents["key"][owner], contents["content"][owner], offset, is_open)
    for name, v in zip(EDGE.names[2:], values):
        out[name] = v
    return out


def _settle(earlier):
    """Decides the open windows of one shard of edge records by all partitions' classes."""

    def of_group(table):
        edge = np.frombuffer(b"".join(table.column("edge").to_pylist()), EDGE)
        parts = max(1, -(-len(edge) // SETTLE_EDGES))
        part = edge["h2"].view(np.uint64) % np.uint64(parts)
        return pa.concat_tables([of_windows(edge[part == p]) for p in range(parts)])

    def of_windows(edge):
        edge = edge[np.lexsort((edge["place"], edge["row"], edge["doc"], edge["open"], edge["h2"], edge["h1"]))]
        new = np.ones(len(edge), bool)
        new[1:] = (edge["h1"][1:] != edge["h1"][:-1]) | (edge["h2"][1:] != edge["h2"][:-1])
        window = np.cumsum(new) - 1
        # Sorted so, the first record of a window is its class with the smallest place.
        first = edge[new][window]
        if earlier:
            found = (edge["open"] == 1) & (first["doc"] < edge["doc"])
        else:
            found = (edge["open"] == 1) & (np.bincount(window, weights=edge["weight"])[window] > 1)
        edge, first = edge[found], first[found]
        values = (edge["key"], edge["content"], edge["offset"], edge["offset"], first["doc"], first["row"], first["place"])
        return pa.table([pa.array(np.asarray(v, t)) for v, t in zip(values, INTERVAL_TYPES)], names=INTERVAL_FIELDS)

    return of_group


def _match_partition(units, earlier, shards):
    names = [*INTERVAL_FIELDS, "shard", "edge"]
    fields = ["key", "content", "n", "doc", "row", "first", "windows"]

    def of_batches(batches):
        batches = list(batches)  # one range partition, about PART_BYTES
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        key = table.column("key").to_numpy()
        if not len(key):
            return
        # Sorted by the symbols from the minimizer on, so runs of one key stand together.
        columns = {f: table.column(f).to_numpy() for f in fields}
        blobs = table.column("blob")
        # The first and the last group of a partition may go on in its neighbours.
        edges = np.unique(key[[0, -1]])
        change = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        windows = np.concatenate([[0], np.cumsum(columns["windows"])])
        at = 0
        while at < len(change) - 1:
            to = at + 1
            while to < len(change) - 1 and windows[change[to + 1]] - windows[change[at]] <= SORT_WINDOWS:
                to += 1
            some = slice(change[at], change[to])
            part = {f: c[some] for f, c in columns.items()}
            part["blob"] = [b.as_py() for b in blobs[some]]
            for out, told in match_windows(units, earlier, part, edges):
                if out:
                    nothing = [pa.nulls(len(out[0]), pa.int32()), pa.nulls(len(out[0]), pa.binary())]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, out), *nothing], names=names)
                if told is not None:
                    yield _dealt(told, shards, names)
            at = to

    return of_batches


def _dealt(told, shards, names):
    """Edge records in one row for every shard they go to."""
    shard = (told["h1"].view(np.uint64) % np.uint64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    numbers, at = np.unique(shard[order], return_index=True)
    cut = [told[order[a:b]].tobytes() for a, b in zip(at, [*at[1:], len(order)])]
    nothing = [pa.nulls(len(cut), pa.int64() if t == np.int64 else pa.int32()) for t in INTERVAL_TYPES]
    return pa.RecordBatch.from_arrays([*nothing, pa.array(numbers), pa.array(cut, pa.binary())], names=names)


def _fetch(units):
    """The contents of the runs listed with every text, and the symbols from their minimizer on."""
    names = ["key", "content", "n", "doc", "row", "first", "windows", "lead", "blob"]

    def of_batches(batches):
        for batch in batches:
            out, size = [], 0
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                data = units.plain(text.as_py())
                start, end = units.places(data)
                # A space ends the last word, lest a longer word of another key sort into the group.
                tail = b" " if units.words else b""
                kmers = ngram_hash(units.symbols(data), units.kmer).view(np.int64)
                for r in wanted.as_py():
                    a, b = r["first"], r["last"]
                    anchor = a + int(np.argmax(kmers[a : b + units.window - units.kmer + 1] == r["key"]))
                    stop = min(anchor + units.window, b + units.window)
                    out.append((r["key"], r["content"], r["n"], r["doc"], r["row"], a, b - a + 1,
                                data[start[anchor] : end[stop - 1]] + tail, data[start[a] : end[b + units.window - 1]]))
                    size += len(out[-1][-1])
                    if size >= AT_ONCE_BYTES:
                        yield pack(out)
                        out, size = [], 0
            if out:
                yield pack(out)

    def pack(out):
        types = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return of_batches


FETCH_SCHEMA = (
    "key bigint, content bigint, n bigint, doc bigint, row bigint, first int, windows bigint, lead binary, blob binary"
)


# -- the whole


def repeated_spans(docs, units, earlier, id_col="doc_id", text_col="text"):
    """Windows to remove, as spans: (row, doc, first, last, src_doc, src_row, src_first).

    ``first`` and ``last`` number windows of row ``row``; every window between them goes. ``earlier``
    asks for a smaller doc_id that has the window, whose place is (src_doc, src_row, src_first);
    otherwise any other place will do, and the source columns mean nothing.
    """
    rows = identified(docs, id_col, text_col)
    runs = stage(rows.mapInArrow(_runs(units), RUN_SCHEMA), "runs")
    keys = runs.groupBy("key").agg(
        F.count("*").alias("n"), F.min("content").alias("c0"), F.max("content").alias("c1"), F.max("many").alias("many")
    )
    mixed = (F.col("c0") != F.col("c1")) | (F.col("many") & F.lit(not earlier))
    keys = stage(keys.filter((F.col("n") > 1) | mixed).select(F.col("key").alias("k"), mixed.alias("mixed")), "keys")
    # Both sides are plain tables here and below: adaptive execution may split what one key holds.
    shared = stage(runs.join(keys, runs["key"] == keys["k"]).drop("k", "many"), "shared")
    place = F.struct("doc", "row", "first", "last")
    contents = shared.groupBy("key", "content").agg(
        F.count("*").alias("n"), F.min(place).alias("src"), F.max("mixed").alias("mixed")
    )
    contents = stage(contents, "contents")
    resolved = stage(
        shared.drop("mixed").join(contents.select("key", "content", "n", "src", "mixed"), ["key", "content"]), "resolved"
    )
    whole = (F.col("src.doc") < F.col("doc")) if earlier else (F.col("n") > 1)
    wholes = resolved.filter(whole).select(
        "row", "doc", "first", "last", F.col("src.doc").alias("src_doc"), F.col("src.row").alias("src_row"),
        F.col("src.first").alias("src_first"),
    )
    wanted = contents.filter("mixed").select(
        F.col("src.row").alias("row"),
        F.struct("key", "content", "n", F.col("src.doc").alias("doc"), F.col("src.row").alias("row"),
                 F.col("src.first").alias("first"), F.col("src.last").alias("last")).alias("run"),
    )
    # The runs of one document: no more than its text has.
    wanted = wanted.groupBy("row").agg(F.collect_list("run").alias("wanted"))
    texts = rows.select("row", "text").join(wanted, "row").select("text", "wanted")
    fetched = stage(texts.mapInArrow(_fetch(units), FETCH_SCHEMA), "contents")
    size = fetched.agg(F.sum(F.length("blob") + F.length("lead"))).first()[0] or 0
    ranged = fetched.repartitionByRange(max(1, -(-size // PART_BYTES)), "lead", "content")
    ranged = ranged.sortWithinPartitions("lead", "content").drop("lead")
    shards = shuffle_partitions(docs.sparkSession)
    matched = stage(ranged.mapInArrow(_match_partition(units, earlier, shards), MATCH_SCHEMA), "matched")
    # Windows at the partitions' edges travel in bulk, one row per partition and shard.
    told = matched.filter("shard IS NOT NULL").select("shard", "edge")
    settled = told.groupBy("shard").applyInArrow(_settle(earlier), INTERVAL_SCHEMA)
    intervals = matched.filter("shard IS NULL").select(*INTERVAL_FIELDS).union(settled)
    intervals = stage(intervals, "intervals")
    parts = resolved.filter("mixed").filter(~whole).join(intervals, ["key", "content"]).select(
        "row", "doc", (F.col("first") + F.col("low")).alias("first"), (F.col("first") + F.col("high")).alias("last"),
        "src_doc", "src_row", F.col("src_place").alias("src_first"),
    )
    return stage(wholes.union(parts), "spans")


def merged(first, last, window):
    """Disjoint (start, end) symbol ranges covered by windows ``first`` to ``last``, as arrays."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + window)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    stop = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])
    return start[new], end[stop]


def with_spans(docs, spans, id_col="doc_id", text_col="text"):
    """``docs`` with ``spans``: the list of (first, last) of every row, null where there is none."""
    listed = spans.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    keyed = docs.withColumn("__row", F.xxhash64(F.col(id_col), F.col(text_col)))
    listed = listed.select(F.col("row").alias("__at"), F.col("spans").alias("__spans"))
    return keyed.join(listed, keyed["__row"] == listed["__at"], "left").drop("__row", "__at")
