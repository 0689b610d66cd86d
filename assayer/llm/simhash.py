"""Near-duplicates by SimHash, with pigeonring filtering of the candidates.

A fingerprint has 64 bits, cut into ``segments`` segments that form a ring. If
two fingerprints differ in at most ``distance`` bits, the pigeonring principle
says that there is a segment from which on every chain of consecutive segments,
of whatever length ``l``, differs in at most ``l * distance / segments`` bits.
For 9 segments and 4 bits that is: two equal segments, at most 1 bit in the
first three and four, at most 2 in the first five and six, and so on.

So a link is only looked for among fingerprints that share, for some start, the
equal segments and all but one of those that may hold one differing bit. These
are the keys (18 per fingerprint, of some 21 bits). Candidates are pruned by the
longer chains, and what is left is checked by the full distance.

Fingerprints are linked, not documents: equal ones are one node. In a bucket of
many fingerprints only the links of a spanning forest are kept, found by
comparing each fingerprint with those that are not yet reached; buckets larger
than ``BLOCK`` are cut into blocks, and each pair of blocks is a bucket.

Defined results: a null text is an empty text; a text without words has the
fingerprint zero and is linked like any other; rows without ``doc_id`` are
linked too, but the smallest id is that of the others; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import pieces, reach_workers, split_words, written
from assayer.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints of a bucket that one task compares with each other.
BLOCK = 4096
#: Buckets up to this size are compared side by side, larger ones one by one.
SMALL = 32

_LOW = np.uint64(0x0101010101010101)


# -- fingerprints ------------------------------------------------------------------


def fingerprints(column: pa.Array, width: int) -> np.ndarray:
    """The SimHash of each text's shingles of ``width`` words."""
    joined, ends = _joined_words(pc.ascii_lower(column))
    data, starts, stops, counts = joined
    words = np.diff(ends)
    shingles = np.where(words > 0, np.maximum(words - width + 1, 1), 0)
    first = np.repeat(ends[:-1], shingles) + _within(shingles)
    last = np.minimum(first + width, np.repeat(ends[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    cut = zip(starts[first].tolist(), stops[last].tolist())
    hashes = np.fromiter((digest(data[a:b], SEED) for a, b in cut), np.uint64, len(first))
    return _majority(hashes, shingles)


def _within(counts: np.ndarray) -> np.ndarray:
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def _joined_words(column: pa.Array):
    """All words with one space between them, and where each begins and stops."""
    words, ends = split_words(column)
    raw = words.cast(pa.large_binary())
    sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
    data = b" ".join(raw.to_pylist())
    stops = np.cumsum(sizes + 1) - 1
    return (data, stops - sizes, stops, sizes), ends


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits set in more than half of each row's hashes."""
    result = np.zeros(len(counts), np.uint64)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return result
    # At most 255 hashes are added up at a time: each byte counts one bit.
    blocks = -(-counts[rows] // 255)
    starts = np.repeat(np.cumsum(counts[rows]) - counts[rows], blocks)
    starts = starts + 255 * _within(blocks)
    firsts = np.cumsum(blocks) - blocks
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _LOW
        sums = np.add.reduceat(lanes, starts).view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(sums.astype(np.int64), firsts, axis=0)
        over = (2 * total > counts[rows, None]).astype(np.uint64)
        for byte in range(8):
            result[rows] |= over[:, byte] << np.uint64(8 * byte + shift)
    return result


#: Bytes of text whose shingles are hashed at a time.
HASH_BYTES = 2 << 20


def fingerprint_documents(
    docs: DataFrame, width: int = 4, carry: list[str] | None = None
) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (64 bits as a signed long).

    The columns named in ``carry``, and the text with them, come along in a
    struct, ``carried``.
    """
    reach_workers(docs.sparkSession)
    schema = "doc_id long, fingerprint long"
    if carry:
        # The text goes to the task and back once, within the struct.
        names = list(dict.fromkeys([*carry, "text"]))
        chosen = docs.select("doc_id", F.struct(*names).alias("carried"))
        schema += f", carried {dict(chosen.dtypes)['carried']}"
    else:
        chosen = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch["carried"].field("text") if carry else batch["text"]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pc.fill_null(whole, "")
            for piece in pieces(iter([pa.record_batch(columns)]), limit=HASH_BYTES):
                found = fingerprints(piece["text"], width).view(np.int64)
                made = {"doc_id": piece["doc_id"], "fingerprint": pa.array(found)}
                if carry:
                    made["carried"] = piece["carried"]
                yield pa.record_batch(made)

    return chosen.mapInArrow(run, schema)


# -- links -------------------------------------------------------------------------


class Ring:
    """The segments of the fingerprint and the chains that candidates must pass."""

    def __init__(self, distance: int, segments: int) -> None:
        if not 0 <= distance < segments <= BITS:
            raise ValueError("there must be more segments than differing bits")
        self.distance, self.segments = distance, segments
        edges = [BITS * k // segments for k in range(segments + 1)]
        self.masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
        budget = [length * distance // segments for length in range(segments + 1)]
        self.equal = max(n for n in range(segments + 1) if budget[n] == 0)
        self.one_off = max(n for n in range(segments + 1) if budget[n] <= 1)
        #: The longest chain of each budget: (segments, differing bits allowed).
        self.chains = [
            (max(n for n in range(segments + 1) if budget[n] == b), b)
            for b in sorted(set(budget))
        ]

    def chain_mask(self, start: int, length: int) -> int:
        return sum(self.masks[(start + k) % self.segments] for k in range(length))

    def keys(self) -> list[tuple[int, int]]:
        """(start, bits that must be equal), one per bucket table."""
        found = []
        for start in range(self.segments):
            within = self.chain_mask(start, self.one_off)
            loose = range(self.equal, self.one_off) or [None]
            for left_out in loose:
                free = 0
                if left_out is not None:
                    free = self.masks[(start + left_out) % self.segments]
                found.append((start, within & ~free))
        return found

    def linked(self, one: np.ndarray, other: np.ndarray, start: int) -> np.ndarray:
        """Which pairs pass the chains from ``start`` and the full distance."""
        differing = one ^ other
        passed = np.arange(len(differing))
        for length, budget in self.chains:
            mask = np.uint64(self.chain_mask(start, length))
            within = np.bitwise_count(differing[passed] & mask) <= budget
            passed = passed[within]
        full = np.bitwise_count(differing[passed]) <= self.distance
        return passed[full]


def _signed(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def _forest(found: np.ndarray, ring: Ring, start: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected among these fingerprints."""
    waiting = np.arange(len(found))
    while len(waiting):
        reached, waiting = [int(waiting[0])], waiting[1:]
        while reached and len(waiting):
            seed = reached.pop()
            same = np.full(len(waiting), found[seed])
            near = ring.linked(found[waiting], same, start)
            if len(near):
                for k in waiting[near].tolist():
                    yield seed, k
                    reached.append(k)
                waiting = np.delete(waiting, near)


def fingerprint_links(
    nodes: DataFrame, distance: int = 4, segments: int = 9, block: int = BLOCK
) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints within ``distance`` bits.

    ``nodes`` has distinct values of ``fingerprint``.
    """
    ring = Ring(distance, segments)
    tables = ring.keys()
    starts = np.array([start for start, _ in tables])
    value = F.col("fingerprint")
    keys = F.array(
        *[
            F.struct(F.lit(t).alias("t"), value.bitwiseAND(_signed(mask)).alias("bits"))
            for t, (_, mask) in enumerate(tables)
        ]
    )
    keyed = nodes.select("fingerprint", F.explode(keys).alias("k"))
    keyed = keyed.select("fingerprint", "k.t", "k.bits")
    sizes = keyed.groupBy("t", "bits").agg(F.count("*").alias("n")).where(F.col("n") > block)
    cut = sizes.select("t", "bits", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    others = F.when(
        F.col("parts").isNotNull(), F.sequence(F.lit(0), F.col("parts") - 1)
    ).otherwise(F.array(F.lit(0)))
    units = (
        keyed.join(cut, ["t", "bits"], "left")
        .select("fingerprint", "t", "bits", F.coalesce(own, F.lit(0)).alias("p"), others.alias("q"))
        .select("fingerprint", "t", "bits", "p", F.explode("q").alias("q"))
        .select(
            "t", "bits", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"), "fingerprint"
        )
    )
    dealt = units.repartition("t", "bits", "p", "q")
    ordered = dealt.sortWithinPartitions("t", "bits", "p", "q", "fingerprint")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_buckets(batches):
            t, bits, p, q, found = columns
            found = found.view(np.uint64)
            same = (
                (t[1:] == t[:-1]) & (bits[1:] == bits[:-1]) & (p[1:] == p[:-1]) & (q[1:] == q[:-1])
            )
            first = np.concatenate([[0], np.flatnonzero(~same) + 1])
            size = np.diff(np.concatenate([first, [len(t)]]))
            left, right = [], []
            within = np.repeat(size, size) - _within(size)  # rows from here to the end
            small = np.repeat(size <= SMALL, size)
            for step in range(1, SMALL):
                one = np.flatnonzero(small & (within > step))
                if not len(one):
                    break
                start = starts[t[one]]
                for s in np.unique(start):
                    here = one[start == s]
                    near = here[ring.linked(found[here], found[here + step], int(s))]
                    left.append(near)
                    right.append(near + step)
            for a, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
                pairs = list(_forest(found[a : a + n], ring, int(starts[t[a]])))
                if pairs:
                    both = np.array(pairs) + a
                    left.append(both[:, 0])
                    right.append(both[:, 1])
            one = np.concatenate([*left, np.zeros(0, np.int64)]).astype(np.int64)
            two = np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)
            yield pa.record_batch(
                {
                    "a": pa.array(found[one].view(np.int64)),
                    "b": pa.array(found[two].view(np.int64)),
                }
            )

    return ordered.mapInArrow(link, "a long, b long").distinct()


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The rows as arrays, cut only between buckets."""
    names = ("t", "bits", "p", "q", "fingerprint")
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        more = [batch[n].to_numpy(zero_copy_only=False) for n in names]
        held = more if held is None else [np.concatenate(x) for x in zip(held, more)]
        key = held[:4]
        last = np.all([k == k[-1] for k in key], axis=0)
        begin = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        if begin:
            yield [x[:begin] for x in held]
            held = [x[begin:] for x in held]
    if held is not None:
        yield held


def link_documents(
    docs: DataFrame,
    width: int = 4,
    distance: int = 4,
    segments: int = 9,
    carry: list[str] | None = None,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (signed long), ``component_id`` and ``stays``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links
    between fingerprints of at most ``distance`` differing bits. ``stays`` is
    true for one row of each component, one with that id. The columns named in
    ``carry`` come along in a struct, ``carried``.
    """
    spark = docs.sparkSession
    # Rows are numbered as they are written: ids may repeat or be null.
    numbered = fingerprint_documents(docs, width, carry).withColumn(
        "row", F.monotonically_increasing_id()
    )
    marked = written(spark, numbered, "fingerprints", "zstd")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    nodes = written(
        spark, marked.groupBy("fingerprint").agg(F.min(order).alias("least")), "nodes"
    )
    links = fingerprint_links(nodes.select("fingerprint"), distance, segments)
    group = components(links).withColumnRenamed("node", "fingerprint")
    grouped = nodes.join(group, "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    # Both sides of the next join are written, so that it stands between two shuffles
    # of its own and AQE can split a component of very many fingerprints.
    grouped = written(spark, grouped, "grouped")
    firsts = grouped.groupBy("component").agg(F.min("least").alias("first"))
    firsts = written(spark, firsts, "firsts")
    found = grouped.join(firsts, "component").select("fingerprint", "first")
    return marked.join(found, "fingerprint").select(
        "doc_id",
        "fingerprint",
        F.col("first.doc_id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("stays"),
        *(["carried"] if carry else []),
    )
