"""Helpers of the corpus operators: staged tables, words, and rolling hashes over numpy arrays."""

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

_local_roots = {}


def shared_root(spark):
    """The folder named by ``spark.checkpoint.dir``; a local-mode session without it gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="footfall-llm-")
    return _local_roots[context.applicationId]


def new_folder(spark, name):
    return f"{shared_root(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name):
    """Write ``df`` as a table in the shared folder and read it back; cuts the lineage there."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name):
    """A column name that no table of the caller can hold."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def utf8(col):
    """Bytes of a text column, empty for null."""
    return F.coalesce(F.encode(col, "UTF-8"), F.lit(b""))


# -- rolling hashes: h(i, j) = sum of x[t] * B^(t - i) over i <= t < j, modulo 2^64

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}


def _power(base, n):
    """base^0 .. base^(n-1), kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            have = np.full(size, base, np.uint64)
            have[0] = 1
            have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 20:
            _powers[base] = have
    return have[:n]


def mix(x):
    """The finalizer of splitmix64: spreads all bits of each value."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_hash(x):
    """Running sums from which ``span_hash`` takes the hash of any span of ``x``."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * _power(_BASE, len(x)), out=out[1:])
    return out


def span_hash(prefix, starts, ends):
    with np.errstate(over="ignore"):
        return (prefix[ends] - prefix[starts]) * _power(_INVERSE, len(prefix))[starts]


def ngram_hash(x, n):
    """Mixed hash of every ``n`` consecutive values of ``x`` (none if there are fewer)."""
    if len(x) < n:
        return np.empty(0, np.uint64)
    p = prefix_hash(x)
    with np.errstate(over="ignore"):
        return mix((p[n:] - p[:-n]) * _power(_INVERSE, len(p))[: len(p) - n])


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
#: Longer words take a hash of their bytes: sums of powers modulo 2^64 agree by construction on some words of
#: 1,024 bytes and more, whatever the base.
LONG_WORD = 64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data):
    """Start and end of every word of ``data`` (bytes)."""
    a = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = ~_SPACE[a]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data):
    """A 64-bit hash of every word of ``data`` (bytes), in order."""
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    p = prefix_hash(BYTE_HASH[np.frombuffer(data, np.uint8)])
    out = mix(span_hash(p, starts, ends) ^ (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], 42)
    return out


def sliding_min(x, width):
    """Minimum of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x
