"""Packing of documents into sequences of fixed length, best fit first, then by local search.

Texts are tokenized once, in batches; only documents longer than a sequence are cut, the shorter
piece first. Pieces are dealt evenly into groups of bounded size. Every group is packed by best fit
in decreasing length, and its underfull bins are improved by swaps: documents are exchanged one for
one, two for one or one for two between two bins, or moved, whenever the sum of squared fills grows, so room
gathers in few bins until they are empty. The bins a group leaves underfull are opened again and go
to the next round with those of the other groups, until one group takes them all or a round gains nothing.

Nulls are empty texts: one piece, the end token alone. Repeated rows are packed one by one. A
document's pieces are numbered from 0 and may stand in any sequences. An empty table gives no rows.
"""

import bisect
import heapq
import math
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm.common import stage

LENGTH, END = 1024, 2
#: Pieces packed in one task and round.
GROUP_PIECES = 20_000
#: Entries of a worker's table of words already tokenized; when full it is started anew.
WORD_TABLE = 500_000


# -- tokens


def _cache():
    """A place that outlives one task in a Python worker."""
    return sys.modules.setdefault("_footfall_worker_cache", types.ModuleType("_footfall_worker_cache")).__dict__


class WordTokenizer:
    """Token ids of byte-level BPE, looked up word by word.

    A single space between two characters that are no white space always starts a new pre-token, so
    what stands between such spaces is tokenized on its own and remembered. New words are coded
    together: each begins with its space, hence with the only tokens that do. Texts with other white
    space next to a space, or with a special token, go through the tokenizer whole.
    """

    #: Pre-tokens of byte-level BPE (fixed value).
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        bytes_of = {c: bytes([b]) for b, c in _byte_letters().items()}
        ranks = {
            b"".join(bytes_of[c] for c in token): i
            for token, i in self.whole.get_vocab(with_added_tokens=False).items()
            if token not in self.special
        }
        self.words = tiktoken.Encoding("words", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for t, i in ranks.items() if t.startswith(b" ")]] = True
        self.table = {}

    def __call__(self, text):
        """The ids as unsigned 32-bit little-endian bytes."""
        parts = text.split(" ")
        if len(parts) < 2 or not self._separable(text, parts):
            return self._ids(text)
        first = self._ids(parts[0]) if parts[0] else b""
        del parts[0]
        table = self.table
        out = list(map(table.get, parts))
        if None in out:
            if len(table) > WORD_TABLE:
                table.clear()
            fresh = self._code(list(dict.fromkeys(p for p, ids in zip(parts, out) if ids is None)))
            table.update(fresh)
            out = [fresh[p] if ids is None else ids for p, ids in zip(parts, out)]
        return first + b"".join(out)

    def _code(self, words):
        ids = np.array(self.words.encode_ordinary(" " + " ".join(words)), "<u4")
        starts = np.flatnonzero(self.spaced[ids]).tolist()
        assert len(starts) == len(words)
        data = ids.tobytes()
        return {w: data[4 * a : 4 * b] for w, a, b in zip(words, starts, [*starts[1:], len(ids)])}

    def _ids(self, text):
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _separable(self, text, parts):
        if text[-1] == " " or any(s in text for s in _BESIDE) or any(s in text for s in self.special):
            return False
        return not any(s in text for s in _OTHER)


#: White space that stands next to a space seldom enough to be left to the tokenizer; other kinds at all.
_BESIDE = ["  ", " \n", "\n ", " \t", "\t ", " \r", "\r "]
_OTHER = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n\t\r"]


def _byte_letters():
    """The printable letter that stands for every byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def pieces(docs, tokenizer, id_col="doc_id", text_col="text", length=LENGTH, end=END):
    """(doc_id, piece, start, length, ids_crc32) of every piece."""
    kind = dict(docs.dtypes)[id_col]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    tail = np.array([end], "<u4").tobytes()

    def of_batches(batches):
        cache = _cache()
        if tokenizer not in cache:
            cache[tokenizer] = WordTokenizer(tokenizer)
        encode = cache[tokenizer]
        for batch in batches:
            at, out = [], ([], [], [], [])
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + tail
                n = len(ids) // 4
                # The remainder comes first, so every later piece fills a sequence.
                cuts = [0, *range(n % length or length, n, length), n] if n > length else [0, n]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    at.append(i)
                    for column, x in zip(out, (piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))):
                        column.append(x)
            types_ = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(out, types_)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(id_col, text_col).mapInArrow(of_batches, schema)


# -- bins of one group


def best_fit(sizes, length):
    """Bins (lists of item numbers) by best fit, largest items first."""
    bins, room_of = [], []
    by_room = []  # sorted (room, bin)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect.bisect_left(by_room, (sizes[i], -1))
        if at < len(by_room):
            room, b = by_room.pop(at)
            bins[b].append(i)
        else:
            b, room = len(bins), length
            bins.append([i])
        room -= sizes[i]
        if room:
            bisect.insort(by_room, (room, b))
    return bins


class _Gives:
    """What every underfull bin may give: nothing, one item or two, with its tokens and the bin's room."""

    def __init__(self, sizes):
        self.sizes, self.at, self.n = sizes, {}, 0
        self.rows = np.empty((3, 1024), np.int64)  # tokens given, bin, room; a replaced row has no room
        self.items = [None] * 1024

    def put(self, k, items, room):
        """Replace the rows of bin ``k``; a full or empty bin has none."""
        if k in self.at:
            a, b = self.at.pop(k)
            self.rows[2, a:b] = 0
        if not items or not room:
            return
        gives = [(), *[(i,) for i in items], *[(i, j) for n, i in enumerate(items) for j in items[n + 1 :]]]
        if self.n + len(gives) > self.rows.shape[1]:
            self._compact(len(gives))
        a, b = self.n, self.n + len(gives)
        self.rows[0, a:b] = [sum(self.sizes[i] for i in g) for g in gives]
        self.rows[1, a:b], self.rows[2, a:b], self.items[a:b] = k, room, gives
        self.at[k], self.n = (a, b), b

    def _compact(self, more):
        spans = sorted(self.at.items(), key=lambda x: x[1])
        live = np.concatenate([np.arange(a, b) for _, (a, b) in spans]) if spans else np.empty(0, np.int64)
        rows, items = self.rows[:, live], [self.items[i] for i in live]
        size = 2 * (len(live) + more) + 1024
        self.rows, self.items, self.n = np.empty((3, size), np.int64), items + [None] * (size - len(items)), len(live)
        self.rows[:, : self.n] = rows
        begin = 0
        for k, (a, b) in spans:
            self.at[k], begin = (begin, begin + b - a), begin + b - a

    def best(self, donor, items, fill, length):
        """(bin, items given, items taken, shift): the largest shift from ``donor``, or None."""
        given, bin_, room = self.rows[:, : self.n]
        # Only bins at least as full as the donor take, so the sum of squares grows.
        able = np.flatnonzero((bin_ != donor) & (room > 0) & (length - room >= fill))
        given, room, found, shift = given[able], room[able], None, 0
        for take in [*[(i,) for i in items], *[(i, j) for n, i in enumerate(items) for j in items[n + 1 :]]]:
            if found and len(take) == 2:
                break  # pairs are for donors from which no single document can be taken
            d = sum(self.sizes[i] for i in take) - given
            d[d > room] = 0
            at = int(d.argmax()) if len(d) else 0
            if len(d) and d[at] > shift:
                found, shift = (at, take), int(d[at])
        if found is None:
            return None
        at = int(able[found[0]])
        return int(bin_[at]), self.items[at], found[1], shift


def local_search(bins, sizes, length):
    """Swap documents between underfull bins while the sum of squared fills grows.

    The emptiest bin not yet tried is the donor, and every underfull bin at least as full a partner:
    shifting d > 0 tokens from g to f >= g raises f^2 + g^2. The donor makes its largest shift
    (a move, or an exchange of one or two for one or two) until it is empty or has none. Passes over
    the donors go on until none changes a bin, or all room together would not empty one.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    room = sum(length - f for f in fill)
    if room < length:
        return bins
    gives = _Gives(sizes)
    for k, b in enumerate(bins):
        gives.put(k, b, length - fill[k])
    changed = True
    while changed and room >= length:
        changed, tried = False, set()
        heap = [(f, k) for k, f in enumerate(fill) if 0 < f < length]
        heapq.heapify(heap)
        while heap and room >= length:
            f, donor = heapq.heappop(heap)
            if donor in tried or f != fill[donor]:
                continue
            tried.add(donor)
            while bins[donor] and (best := gives.best(donor, bins[donor], fill[donor], length)):
                k, give, take, d = best
                for i in give:
                    bins[k].remove(i)
                    bins[donor].append(i)
                for i in take:
                    bins[donor].remove(i)
                    bins[k].append(i)
                fill[k] += d
                fill[donor] -= d
                gives.put(k, bins[k], length - fill[k])
                gives.put(donor, bins[donor], length - fill[donor])
                if 0 < fill[k] < length and k not in tried:
                    heapq.heappush(heap, (fill[k], k))
                changed = True
            if not bins[donor]:
                room -= length
    return [b for b in bins if b]


def _packer(length):
    """Packs a partition; ``open`` tells the items of bins that are not full."""
    names = ["id", "sequence", "offset", "open"]

    def of_batches(batches):
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        ids, sizes = table.column("id").to_numpy(), table.column("length").to_numpy().tolist()
        task = int(table.column("group")[0].as_py())
        bins = local_search(best_fit(sizes, length), sizes, length)
        held = {}
        for i, name in enumerate(table.column("bin").to_pylist()):
            held.setdefault(name, []).append(i)
        if None not in held:
            # Bins of the rounds before meet as they are, so no round undoes what another gained.
            met = local_search(list(held.values()), sizes, length)
            full = lambda x: sum(sum(sizes[i] for i in b) == length for b in x)
            bins = min(met, bins, key=lambda x: (len(x), -full(x)))
        out = ([], [], [], [])
        for number, b in enumerate(bins):
            fill = sum(sizes[i] for i in b)
            offset = 0
            for i in b:
                out[0].append(ids[i])
                out[1].append((task << 32) + number)
                out[2].append(offset)
                out[3].append(fill < length)
                offset += sizes[i]
        kinds = [pa.int64()] * 3 + [pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return of_batches


def assign(items, length=LENGTH):
    """(id, sequence_id, offset) for ``items`` (id bigint, length bigint)."""
    done, first_group, n, before = [], 0, items.count(), None
    left = items.withColumn("bin", F.lit(None).cast("long"))
    schema = "id bigint, sequence bigint, offset bigint, open boolean"
    while n:
        groups = max(1, math.ceil(n / GROUP_PIECES))
        dealt_by = F.xxhash64(F.coalesce("bin", "id"), F.lit(first_group))
        dealt = left.withColumn("group", F.pmod(dealt_by, F.lit(groups)) + first_group)
        packed = stage(dealt.groupBy("group").applyInArrow(_grouped(_packer(length)), schema), "packed")
        # Every bin has one item at offset 0.
        at_0 = F.col("offset") == 0
        bins, open_bins, remain = packed.agg(
            F.count_if(at_0), F.count_if(at_0 & F.col("open")), F.count_if("open")
        ).first()
        done.append(packed.filter("NOT open"))
        unfilled = packed.filter("open")
        if groups == 1 or bins == before and remain == n:
            done.append(unfilled)
            break
        before = open_bins
        left = stage(unfilled.select("id", F.col("sequence").alias("bin")).join(left.drop("bin"), "id"), "left")
        first_group, n = first_group + groups, remain
    if not done:
        return items.select("id", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).limit(0)
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select("id", F.col("sequence").alias("sequence_id"), "offset")


def _grouped(pack):
    def of_group(table):
        return pa.Table.from_batches(list(pack(table.to_batches())), schema=None)

    return of_group


def pack(docs, tokenizer, id_col="doc_id", text_col="text", length=LENGTH, end=END):
    """One row per piece with its sequence and its offset there."""
    cut = stage(pieces(docs, tokenizer, id_col, text_col, length, end).withColumn("id", F.monotonically_increasing_id()), "pieces")
    # Pieces as long as a sequence need no search; their own number names it, apart from the others.
    full = cut.filter(F.col("length") == length).withColumn("sequence_id", -1 - F.col("id")).withColumn("offset", F.lit(0).cast("long"))
    rest = cut.filter(F.col("length") < length)
    placed = rest.join(assign(rest.select("id", "length"), length), "id")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(*columns).union(placed.select(*columns))
