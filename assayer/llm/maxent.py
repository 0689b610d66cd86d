"""Language-model scores by a hashed maximum-entropy model.

The probability of a token is factored by classes: P(class | history) times
P(word | class, previous word).

Classes: the end of a text; each of the ``SINGLES`` most frequent words; and all other
words by how frequent they are (``TIERS``) and a hash of their last two letters
(``SHAPES``). A word that was never learned is one more, once seen, word in the least
frequent tier. A softmax over these forty-odd classes has weights that are found by hashed
features of the history: the word before, the two words before (n-grams), and the
second and third word before alone (skips). The factors are

    P(class | history) = (n(previous, class) + a * softmax) / (n(previous) + a)
    P(word | class, previous word) = (n(previous, word) + b * share) / (n(previous, class) + b)

where ``n`` counts what all texts to learn from have after the previous word, ``share``
is the word's add-one share of its class, and ``a`` and ``b`` are trained weights that
depend on the count below the line. Each factor adds up to one. Every pair of words that
occurs has a count of its own, so what is learned grows with the corpus; the softmax
tells histories apart by what they share.

A token of a text that is learned from is not counted itself when it is trained on or
scored: its own pair, class and word count one less. So such a text scores like one that
is held out.

How it is computed:

1. Texts are cut into blocks. A block is one row of a written table: the words
   it has, how often they occur in texts to learn from, and its tokens as
   places in that list.
2. One shuffle by word adds up the counts; a second one brings them back to the
   blocks, where they are written to one file per block.
3. The same is done for pairs of words, and of word and class: every block sends its
   distinct ones by hash with how often it learned them, dealt by that hash; the sums over
   all blocks come back to the blocks that have the pair.
4. The weights are trained in rounds. Every task runs gradient steps (AdaGrad, sparse numpy
   batches) over the round's blocks, and the tasks' changes are averaged by feature,
   weighted by how often each task met it. Each block is used in one round.
5. All texts are scored block by block.

What is sent to all tasks are the weights and a few numbers per class; the counts of
words and pairs stay distributed.

Defined results: a null text is an empty text with the end as its only token; a
row without ``doc_id`` is learned from and scored; an empty table gives no
rows; without any text to learn from, all tokens are unknown and score 0.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.llm.common import (
    crc_mod,
    file_system,
    give_back,
    pieces,
    save_file,
    split_words,
    texts,
    written,
)
from assayer.session import new_workspace

SINGLES = 16
TIERS = 3
SHAPES = 8
CLASSES = 1 + SINGLES + TIERS * SHAPES
#: Counts are told apart by this many steps per power of two.
COUNT_STEPS = 4
COUNT_BINS = 64 * COUNT_STEPS

#: Rows of the table of weights that histories share; row 0 is the bias.
FEATURES = 1 << 14
FEATURES_PER_TOKEN = 4
#: Rows of weights that are summed up together.
CHUNK = 512

#: Bits of a history's hash that tell its row of weights.
ROW_BITS = FEATURES.bit_length() - 1
#: Weights of the softmax and of the shares against what was seen after a word, before
#: training, and how fast they are trained. They go by powers of two of what was seen.
BACKING = 2.0
BACKING_RATE = 0.05
SEEN_BINS = 64
#: Stands before the first word of a text; no word's hash is as large.
START_HASH = 1 << 33
#: Added to a class's number, in place of a word's hash.
CLASS_HASH = 1 << 34

ROUNDS = 2
BATCH = 32768
#: Tokens whose weights of all classes stay near the processor.
NEAR = 4096
RATE = 0.3

#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20
#: Stands for the end of a text; no word is empty.
END = ""

BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, learn array<boolean>, lengths array<int>, "
    "tokens binary, words array<string>, counts array<long>"
)


# -- blocks and counts ---------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(pieces(batches, limit=BLOCK_BYTES)):
        words, ends = split_words(pc.ascii_lower(batch["text"]))
        coded = words.dictionary_encode()
        size = len(coded.dictionary)
        tokens = np.insert(np.asarray(coded.indices), ends[1:], size).astype("<i4")
        lengths = np.diff(ends) + 1
        learn = np.asarray(batch["learn"])
        used = np.bincount(tokens[np.repeat(learn, lengths)], minlength=size + 1)
        listed = pa.concat_arrays([coded.dictionary, pa.array([END])])
        yield pa.record_batch(
            {
                "block": pa.array([base + number], pa.int64()),
                "doc_ids": _one_list(batch["doc_id"]),
                "learn": _one_list(batch["learn"]),
                "lengths": _one_list(pa.array(lengths, pa.int32())),
                "tokens": pa.array([tokens.tobytes()], pa.binary()),
                "words": _one_list(listed),
                "counts": _one_list(pa.array(used, pa.int64())),
            }
        )


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def count_bin(counts: np.ndarray) -> np.ndarray:
    """Bins of counts: 0 for none, then steps of a quarter of a power of two."""
    steps = np.floor(np.log2(np.maximum(counts, 1)) * COUNT_STEPS).astype(np.int64)
    return np.where(counts > 0, np.minimum(steps + 1, COUNT_BINS - 1), 0)


@dataclass(frozen=True)
class Entries:
    """A block's words: how often each was learned, its hash and its shape."""

    counts: np.ndarray
    hashes: np.ndarray
    shapes: np.ndarray

    def to_bytes(self) -> bytes:
        parts = (self.counts.astype("<i8"), self.hashes.astype("<u4"), self.shapes)
        data = b"".join(p.tobytes() for p in parts)
        packed = pa.compress(data, codec="zstd", asbytes=True)
        return len(self.counts).to_bytes(8, "little") + packed

    @staticmethod
    def read(folder: str, block: int) -> Entries:
        system, path = file_system(folder)
        with system.open_input_stream(f"{path}/{_entries_name(block)}", compression=None) as f:
            data = f.read()
        n = int.from_bytes(data[:8], "little")
        data = pa.decompress(data[8:], 13 * n, codec="zstd", asbytes=True)
        return Entries(
            np.frombuffer(data, "<i8", n),
            np.frombuffer(data, "<u4", n, 8 * n),
            np.frombuffer(data, np.uint8, n, 12 * n),
        )


def _entries_name(block: int) -> str:
    return f"entries-{block:016x}"


COUNTED_SCHEMA = (
    "block long, kinds long, mass array<long>, types array<long>, "
    "top_counts array<long>, top_hashes array<long>, top_shapes array<int>"
)


def _counted(blocks: DataFrame, folder: str) -> DataFrame:
    """Write each block's entries; one row of sums per block.

    ``mass`` and ``types`` are indexed by bin of count and shape. A word counts
    in the sums of the first block that has it.
    """
    listed = blocks.select(
        "block", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")
    ).select("block", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))
    # A block has a word once, so that no word has more rows than there are blocks.
    same = Window.partitionBy("word")
    known = listed.select(
        "block",
        "place",
        F.sum("n").over(same).alias("count"),
        (F.min("block").over(same) == F.col("block")).alias("first"),
        F.hash("word").alias("hash"),
        F.pmod(F.hash(F.right("word", F.lit(2))), F.lit(SHAPES)).alias("shape"),
        (F.col("word") == END).alias("end"),
    )

    def keep(rows: pa.Table) -> pa.Table:
        block = rows["block"][0].as_py()
        order = np.argsort(rows["place"].to_numpy())
        counts = rows["count"].to_numpy()[order]
        hashes = rows["hash"].to_numpy()[order].astype(np.int32).view(np.uint32)
        shapes = rows["shape"].to_numpy()[order].astype(np.uint8)
        own = Entries(counts, hashes, shapes)
        save_file(folder, _entries_name(block), iter([own.to_bytes()]))
        first = np.asarray(rows["first"].combine_chunks())[order] & (counts > 0)
        kinds = int(first.sum())
        first &= ~np.asarray(rows["end"].combine_chunks())[order]
        cell = (count_bin(counts) * SHAPES + shapes)[first]
        size = COUNT_BINS * SHAPES
        mass = np.bincount(cell, counts[first], size).astype(np.int64)
        types = np.bincount(cell, minlength=size)
        found = np.flatnonzero(first)
        found = found[np.argsort(-counts[found], kind="stable")[:SINGLES]]
        return pa.table(
            {
                "block": pa.array([block], pa.int64()),
                "kinds": pa.array([kinds], pa.int64()),
                "mass": _one_list(pa.array(mass)),
                "types": _one_list(pa.array(types, pa.int64())),
                "top_counts": _one_list(pa.array(counts[found])),
                "top_hashes": _one_list(pa.array(hashes[found].astype(np.int64))),
                "top_shapes": _one_list(pa.array(shapes[found].astype(np.int32))),
            }
        )

    rows = known.groupBy("block").applyInArrow(keep, COUNTED_SCHEMA)
    with _passing_shuffles(blocks.sparkSession):
        return written(blocks.sparkSession, rows, "counted")


# -- the model -----------------------------------------------------------------------


@dataclass
class Model:
    """Classes and weights; counts of words and pairs, which grow with the corpus, stay
    with the blocks (``Entries``, ``Seen``)."""

    tokens: int  # all tokens learned from
    kinds: int  # distinct ones
    ends: int
    singles: list[tuple[int, int]]  # (count, hash), most frequent first
    tier_of_bin: np.ndarray
    class_mass: np.ndarray
    class_types: np.ndarray
    weights: np.ndarray
    backing: np.ndarray  # logarithms of a and b, by bin of the count below the line

    def classes(self, entries: Entries) -> np.ndarray:
        """The class of each word of a block; the last one is the end."""
        tier = self.tier_of_bin[count_bin(entries.counts)]
        found = 1 + SINGLES + tier * SHAPES + entries.shapes
        for k, (count, number) in enumerate(self.singles):
            found[(entries.counts == count) & (entries.hashes == number)] = 1 + k
        found[-1] = 0
        return found

    def share(self, counts: np.ndarray, classes: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The add-one share of words in their classes, without ``own`` occurrences."""
        total = (self.class_mass + self.class_types)[classes] - own
        return np.minimum((counts - own + 1) / np.maximum(total, 1), 1.0)


def backed(
    backing: np.ndarray, part: np.ndarray, whole: np.ndarray, share: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A factor of the probability: ``part`` of ``whole``, backed by ``share``.

    With the bins of its weights, and the slope of its logarithm by theirs.
    """
    bins = np.frexp(whole.astype(np.float64))[1]  # 0 for none, then by powers of two
    weight = np.exp(backing)[bins]
    base = weight * share
    chance = (part + base) / (whole + weight)
    return chance, bins, base / (part + base) - weight / (whole + weight)


def _model(blocks: DataFrame, counted: DataFrame) -> Model:
    """Classes and their sums, with the weights of a model without features."""
    sums = counted.select(
        F.posexplode(F.arrays_zip("mass", "types")).alias("cell", "entry")
    ).where("entry.types > 0")
    sums = sums.groupBy("cell").agg(F.sum("entry.mass").alias("m"), F.sum("entry.types").alias("t"))
    size = COUNT_BINS * SHAPES
    mass, types = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in sums.collect():
        mass[row["cell"]], types[row["cell"]] = row["m"], row["t"]
    total = counted.agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("k"))
    tops = counted.select(F.inline(F.arrays_zip("top_counts", "top_hashes", "top_shapes")))
    tops = tops.orderBy(F.desc("top_counts"), "top_hashes").limit(SINGLES).collect()
    ends = F.size(F.filter("learn", lambda x: x)).cast("long")
    ends = blocks.agg(F.coalesce(F.sum(ends), F.lit(0)).alias("e")).first()["e"]
    tokens = int(mass.sum()) + ends

    class_mass, class_types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    class_mass[0], class_types[0] = ends, 1
    for k, row in enumerate(tops):
        cell = count_bin(np.array([row["top_counts"]]))[0] * SHAPES + row["top_shapes"]
        mass[cell] -= row["top_counts"]
        types[cell] -= 1
        class_mass[1 + k], class_types[1 + k] = row["top_counts"], 1
    # Tiers of about equal mass, from the rarest words up.
    each = mass.reshape(-1, SHAPES).sum(1)
    share = (np.cumsum(each) - each / 2) / max(1, each.sum())
    tier = np.clip((share * TIERS).astype(np.int64), 0, TIERS - 1)
    tier[0] = 0
    rest = 1 + SINGLES + np.repeat(tier * SHAPES, SHAPES) + np.tile(np.arange(SHAPES), len(tier))
    np.add.at(class_mass, rest, mass)
    np.add.at(class_types, rest, types)
    class_types[1 + SINGLES : 1 + SINGLES + SHAPES] += 1  # a word never learned
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    weights[0] = np.log((class_mass + class_types) / max(1, (class_mass + class_types).sum()) + 1e-9)
    singles = [(row["top_counts"], row["top_hashes"]) for row in tops]
    kinds = total.first()["k"]
    backing = np.full((2, SEEN_BINS), np.log(BACKING))
    return Model(tokens, kinds, ends, singles, tier, class_mass, class_types, weights, backing)


def histories(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of each token's histories: one line per kind of feature."""
    at = np.arange(len(hashes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    before = []
    for back in (1, 2, 3):
        word = np.empty(len(hashes), np.uint64)
        word[back:] = hashes[:-back]
        word[at < back] = 0x51ED27  # stands before the first word
        before.append(word)
    one, two, three = before
    mix, four = np.uint64(0x9E3779B97F4A7C15), np.uint64(4)
    codes = (
        one * four,
        (one * np.uint64(0x100000001B3) + two) * four + np.uint64(1),
        two * four + np.uint64(2),
        three * four + np.uint64(3),
    )
    found = np.empty((FEATURES_PER_TOKEN, len(hashes)), np.uint64)
    for k, code in enumerate(codes):
        np.multiply(code, mix, out=found[k])
        found[k] ^= code >> np.uint64(29)
        found[k] *= mix
    return found


def feature_rows(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The rows of weights of the tokens' histories, without the bias."""
    rows = histories(hashes, lengths) >> np.uint64(64 - ROW_BITS)
    return np.maximum(rows.astype(np.uint16), 1)


# -- pairs of words, and of word and class ----------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    packed = pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""
    return len(values).to_bytes(8, "little") + packed


def unpack(data: bytes) -> np.ndarray:
    """The 64-bit numbers that were packed."""
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    planes = pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of numbers."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x += b * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _with_places(values: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Values in order, and the place of each; the lowest ``free`` bits are not theirs.

    The place goes into those bits, so that numbers are sorted and not places.
    """
    packed = values | np.arange(len(values), dtype=np.uint64)
    packed.sort()
    low = np.uint64((1 << free) - 1)
    return packed >> np.uint64(free), (packed & low).astype(np.int64)


def _place_bits(values: np.ndarray) -> int:
    return max(1, len(values) - 1).bit_length()


def distinct(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, all below ``limit``, in order, and each code's place in them."""
    free = _place_bits(codes)
    if limit.bit_length() + free > 64:
        return np.unique(codes, return_inverse=True)
    ordered, place = _with_places(codes.astype(np.uint64) << np.uint64(free), free)
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    whose = np.empty(len(codes), np.int64)
    whose[place] = np.cumsum(first) - 1
    return ordered[first].astype(np.int64), whose


def by_hash(keys: np.ndarray) -> np.ndarray:
    """Places in the order of hashes, by as many of their highest bits as fit."""
    free = np.uint64(_place_bits(keys))
    return _with_places((keys >> free) << free, int(free))[1]


@dataclass(frozen=True)
class Pairs:
    """The distinct pairs of a block: previous word and word, previous word and class."""

    keys: np.ndarray  # hashes, word pairs first
    before: np.ndarray  # the previous word of each word pair
    pair_of: np.ndarray  # of each token
    class_of: np.ndarray  # of each word pair, counted from the first class pair

    @staticmethod
    def of(
        entries: Entries, classes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray
    ) -> Pairs:
        size = len(classes)
        before = np.empty(len(tokens), np.int64)
        before[1:] = tokens[:-1]
        before[np.cumsum(lengths) - lengths] = size  # the start of a text
        pairs, pair_of = distinct(before * size + tokens, size * (size + 1))
        before, word = np.divmod(pairs, size)
        cells, class_of = distinct(before * CLASSES + classes[word], (size + 1) * CLASSES)
        hashes = np.append(entries.hashes.astype(np.uint64), np.uint64(START_HASH))
        of_cell, group = np.divmod(cells, CLASSES)
        keys = [
            mixed(hashes[before], hashes[word]),
            mixed(hashes[of_cell], group.astype(np.uint64) + np.uint64(CLASS_HASH)),
        ]
        return Pairs(np.concatenate(keys), before, pair_of, class_of)

    def learned(self, learn: np.ndarray) -> np.ndarray:
        """How often the tokens to learn from have each pair."""
        words = np.bincount(self.pair_of[learn], minlength=len(self.class_of))
        cells = np.bincount(self.class_of, words, len(self.keys) - len(words))
        return np.concatenate([words, cells.astype(np.int64)]).astype(np.uint64)


@dataclass(frozen=True)
class Seen:
    """What all texts to learn from have after the word before each token of a block:
    this token, its class, and anything at all."""

    pair: np.ndarray
    of_class: np.ndarray
    all: np.ndarray

    @staticmethod
    def read(folder: str, block: int, pairs: Pairs, entries: Entries, model: Model) -> Seen:
        system, path = file_system(folder)
        with system.open_input_stream(f"{path}/{_seen_name(block)}", compression=None) as f:
            rows = pa.ipc.open_stream(f.read()).read_all()
        counts = np.empty(len(pairs.keys), np.int64)
        known = [unpack(x) for x in rows["counts"].to_pylist()]
        counts[by_hash(pairs.keys)] = np.concatenate(known)
        words = len(pairs.class_of)
        # Each occurrence of a word is followed by a token, each start of a text too.
        times = np.append(entries.counts, model.ends)
        return Seen(
            counts[:words][pairs.pair_of],
            counts[words:][pairs.class_of][pairs.pair_of],
            times[pairs.before][pairs.pair_of],
        )

    def without(self, own: np.ndarray) -> Seen:
        """Less what the tokens themselves have added."""
        return Seen(self.pair - own, self.of_class - own, self.all - own)

    def some(self, which) -> Seen:
        return Seen(self.pair[which], self.of_class[which], self.all[which])


def _seen_name(block: int) -> str:
    return f"seen-{block:016x}"


PAIR_SCHEMA = "block long, bucket int, keys binary, counts binary"
ANSWER_SCHEMA = "block long, bucket int, counts binary"
#: Buckets that one task adds up.
BUCKETS_PER_TASK = 4


@contextlib.contextmanager
def _passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """The files of a query's shuffles go as soon as it is done."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _gather_pairs(blocks: DataFrame, folder: str, model: Model) -> None:
    """Write for each block how often all texts to learn from have its pairs."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(model)
    # A bucket has about half as many pairs as a block.
    bits = max(2, 2 * blocks.count()).bit_length()
    shift = np.uint64(64 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for row, tokens, lengths, entries in _block_rows(batches, folder):
            pairs = Pairs.of(entries, own.classes(entries), tokens, lengths)
            counts = pairs.learned(np.repeat(np.asarray(row["learn"].values), lengths))
            order = by_hash(pairs.keys)
            keys, counts = pairs.keys[order], counts[order]
            limits = np.arange(1 << bits, dtype=np.uint64) << shift
            cuts = np.append(np.searchsorted(keys, limits), len(keys))
            used = np.flatnonzero(np.diff(cuts))
            places = [slice(*cuts[b : b + 2]) for b in used]
            steps = [np.diff(keys[place], prepend=np.uint64(0)) for place in places]
            yield pa.record_batch(
                {
                    "block": pa.array([row["block"].as_py()] * len(used), pa.int64()),
                    "bucket": pa.array(used, pa.int32()),
                    "keys": pa.array(map(pack, steps), pa.binary()),
                    "counts": pa.array([pack(counts[place]) for place in places], pa.binary()),
                }
            )

    def add_up(rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpack(x), dtype=np.uint64) for x in rows["keys"].to_pylist()]
        ends = np.cumsum(list(map(len, keys)))
        together = np.concatenate(keys)
        order = np.argsort(together, kind="stable")
        ordered = together[order]
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        counts = np.concatenate([unpack(x) for x in rows["counts"].to_pylist()])
        sums = np.add.reduceat(counts[order], at)
        counts[order] = np.repeat(sums, np.diff(at, append=len(order)))
        answers = [pack(part) for part in np.split(counts, ends[:-1])]
        return pa.table(
            {
                "block": rows["block"],
                "bucket": rows["bucket"],
                "counts": pa.array(answers, pa.binary()),
            }
        )

    def keep(rows: pa.Table) -> pa.Table:
        block = rows["block"][0].as_py()
        rows = rows.select(["bucket", "counts"]).sort_by("bucket")
        kept = pa.BufferOutputStream()
        with pa.ipc.new_stream(kept, rows.schema) as out:
            out.write_table(rows)
        save_file(folder, _seen_name(block), iter([kept.getvalue()]))
        return pa.table({"block": pa.array([block], pa.int64())})

    columns = blocks.select("block", "learn", "lengths", "tokens")
    sent = columns.mapInArrow(send, PAIR_SCHEMA)
    # As many tasks as the buckets need, whatever the session's setting is.
    tasks = max(1, (1 << bits) // BUCKETS_PER_TASK)
    answered = sent.repartition(tasks, "bucket").groupBy("bucket")
    answered = answered.applyInArrow(add_up, ANSWER_SCHEMA).repartition(tasks, "block")
    with _passing_shuffles(spark):
        answered.groupBy("block").applyInArrow(keep, "block long").count()
    shared.unpersist()


# -- training ------------------------------------------------------------------------


def _exponentials(weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of each class's weight for each token, and their sums."""
    total = weights.take(rows[0], 0)
    for row in rows[1:]:
        total += weights.take(row, 0)
    total += weights[0]
    np.clip(total, -40, 40, out=total)
    np.exp(total, out=total)
    return total, total @ np.ones(total.shape[1], np.float32)


def class_probabilities(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """P(class | history) of each token."""
    found = np.empty((rows.shape[1], weights.shape[1]), weights.dtype)
    for first in range(0, len(found), NEAR):
        some = slice(first, first + NEAR)
        total, sums = _exponentials(weights, rows[:, some])
        np.divide(total, sums[:, None], out=found[some])
    return found


def _sums_by_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row of weights the sum of the values of the tokens that have it as
    a feature, and how many there are."""
    flat = rows.ravel().astype(np.int64)
    sums = np.empty((values.shape[1], FEATURES), np.float32)
    for line, column in zip(sums, np.ascontiguousarray(values.T, np.float64)):
        line[:] = np.bincount(flat, np.tile(column, len(rows)), FEATURES)
    return np.ascontiguousarray(sums.T), np.bincount(flat, minlength=FEATURES)


def gradient_steps(
    weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, classes: np.ndarray
) -> np.ndarray:
    """One pass of AdaGrad over the tokens, in batches; changes the arrays.

    Returns the probability that each token's class had before its batch.
    """
    before = np.empty(len(classes), np.float32)
    for first in range(0, len(classes), BATCH):
        some, want = rows[:, first : first + BATCH], classes[first : first + BATCH]
        error = class_probabilities(weights, some)
        own = np.arange(len(want)), want
        before[first : first + BATCH] = error[own]
        error[own] -= 1
        slope, times = _sums_by_row(error, some)
        slope[0], times[0] = error.sum(0), len(want)
        slope /= np.sqrt(np.maximum(times, 1))[:, None].astype(np.float32)
        step = slope * slope
        squares += step
        np.sqrt(squares, out=step)
        np.divide(slope, step, out=step)
        step *= np.float32(RATE)
        weights -= step
    return before


@dataclass
class Backing:
    """The weights of softmax and shares in training."""

    values: np.ndarray
    squares: np.ndarray
    met: np.ndarray

    @staticmethod
    def of(values: np.ndarray) -> Backing:
        return Backing(values.copy(), np.full(values.shape, 1e-3), np.zeros(values.shape, np.int64))

    def step(self, seen: Seen, chance: np.ndarray, share: np.ndarray) -> None:
        """A gradient step on some tokens."""
        parts = ((seen.of_class, seen.all, chance), (seen.pair, seen.of_class, share))
        for k, (part, whole, base) in enumerate(parts):
            _, bins, slope = backed(self.values[k], part, whole, base)
            times = np.bincount(bins, minlength=SEEN_BINS)
            slope = np.bincount(bins, slope, SEEN_BINS) / np.maximum(times, 1)
            self.squares[k] += slope * slope
            self.values[k] += BACKING_RATE * slope / np.sqrt(self.squares[k])
            self.met[k] += times


def _block_rows(batches: Iterator[pa.RecordBatch], folder: str):
    """Each block's row, its tokens, their lengths by text, and its entries."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch[name][k] for name in batch.schema.names}
            tokens = np.frombuffer(row["tokens"].as_buffer(), "<i4")
            lengths = np.asarray(row["lengths"].values, np.int64)
            yield row, tokens, lengths, Entries.read(folder, row["block"].as_py())
            give_back()


#: Stands for the weights of the shares among the chunks of weights.
BACKED = -1


def _train_round(
    blocks: DataFrame, folder: str, model: Model, number: int
) -> tuple[np.ndarray, np.ndarray]:
    """All weights after a round: the tasks' changes averaged by feature."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        weights = own.weights.copy()
        squares = np.ones_like(weights)
        met = np.zeros(FEATURES, np.int64)
        backing = Backing.of(own.backing)
        for row, tokens, lengths, entries in _block_rows(batches, folder):
            learn = np.asarray(row["learn"].values)
            if not learn.any():
                continue
            found = own.classes(entries)
            pairs = Pairs.of(entries, found, tokens, lengths)
            mine = np.repeat(learn, lengths)
            seen = Seen.read(folder, row["block"].as_py(), pairs, entries, own)
            seen = seen.some(mine).without(1)
            tokens, lengths = tokens[mine], lengths[learn]
            share = own.share(entries.counts, found, 1)[tokens]
            at = 0
            for part, sizes in _parts(tokens, lengths):
                rows = feature_rows(entries.hashes[part], sizes)
                chance = gradient_steps(weights, squares, rows, found[part])
                for first in range(0, len(part), BATCH):
                    batch = slice(at + first, at + min(first + BATCH, len(part)))
                    backing.step(seen.some(batch), chance[first : first + BATCH], share[batch])
                at += len(part)
                met += np.bincount(rows.ravel(), minlength=FEATURES)
                met[0] += len(part)
        change = (weights - own.weights) * met[:, None].astype(np.float32)
        chunks = [c for c in range(0, FEATURES, CHUNK) if met[c : c + CHUNK].any()]
        moved = ((backing.values - own.backing) * backing.met).astype(np.float32)
        changes = [moved.tobytes(), *(change[c : c + CHUNK].tobytes() for c in chunks)]
        times = [backing.met.tobytes(), *(met[c : c + CHUNK].tobytes() for c in chunks)]
        yield pa.record_batch(
            {
                "chunk": pa.array([BACKED, *chunks], pa.int32()),
                "change": pa.array(changes, pa.binary()),
                "met": pa.array(times, pa.binary()),
            }
        )

    of_round = F.pmod(F.hash("block"), F.lit(ROUNDS)) == number
    columns = blocks.where(of_round).select("block", "learn", "lengths", "tokens")
    sent = columns.mapInArrow(run, "chunk int, change binary, met binary")
    # Summed up pair by pair: neither a task nor the driver holds all tasks' tables.
    pairs = sent.rdd.map(
        lambda r: (r[0], (np.frombuffer(r[1], np.float32), np.frombuffer(r[2], np.int64)))
    )
    sums = pairs.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collect()
    weights, backing = model.weights.copy(), model.backing.copy()
    for chunk, (change, met) in sums:
        if chunk == BACKED:
            backing += (change / np.maximum(met, 1)).reshape(backing.shape)
            continue
        mean = change.reshape(-1, CLASSES) / np.maximum(met, 1)[:, None]
        weights[chunk : chunk + CHUNK] += mean.astype(np.float32)
    shared.unpersist()
    return weights, backing


#: Tokens whose class probabilities are held at a time.
TOKENS_AT_ONCE = 1 << 18


def _parts(tokens: np.ndarray, lengths: np.ndarray):
    """The tokens in parts of bounded size, with the lengths of the texts in them.

    A part ends where a text ends; a longer text is a part of its own.
    """
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + TOKENS_AT_ONCE, "right")))
        yield tokens[before : ends[last - 1]], lengths[first:last]
        first = last


SCORE_SCHEMA = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(blocks: DataFrame, folder: str, model: Model) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for row, tokens, lengths, entries in _block_rows(batches, folder):
            classes = own.classes(entries)
            pairs = Pairs.of(entries, classes, tokens, lengths)
            # A token that was learned from does not count itself.
            mine = np.repeat(np.asarray(row["learn"].values), lengths).astype(np.int64)
            seen = Seen.read(folder, row["block"].as_py(), pairs, entries, own).without(mine)
            share = own.share(entries.counts[tokens], classes[tokens], mine)
            inner = np.log10(backed(own.backing[1], seen.pair, seen.of_class, share)[0])
            base = np.log10((entries.counts + 1) / (own.tokens + own.kinds + 1))
            known, base_score, score = [], [], []
            at = 0
            for part, sizes in _parts(tokens, lengths):
                starts = np.cumsum(sizes) - sizes
                rows = feature_rows(entries.hashes[part], sizes)
                want = classes[part]
                each = inner[at : at + len(part)]
                chance = np.empty(len(part))
                for first in range(0, len(part), NEAR):
                    some = slice(first, first + NEAR)
                    total, sums = _exponentials(own.weights, rows[:, some])
                    chance[some] = total[np.arange(len(total)), want[some]] / sums
                here = seen.some(slice(at, at + len(part)))
                each += np.log10(backed(own.backing[0], here.of_class, here.all, chance)[0])
                at += len(part)
                known.append(np.add.reduceat((entries.counts[part] > 0).astype(np.int64), starts))
                base_score.append(np.add.reduceat(base[part], starts))
                score.append(np.add.reduceat(each, starts))
            if own.tokens == 0:
                score = [np.zeros(len(s)) for s in score]
            yield pa.record_batch(
                {
                    "doc_id": row["doc_ids"].values.cast(pa.int64()),
                    "n_tokens": pa.array(lengths),
                    "n_known": pa.array(np.concatenate(known)),
                    "base_score": pa.array(np.concatenate(base_score)),
                    "score": pa.array(np.concatenate(score)),
                }
            )

    columns = blocks.select("block", "doc_ids", "learn", "lengths", "tokens")
    return columns.mapInArrow(run, SCORE_SCHEMA)


def score_documents(docs: DataFrame, folds: int = 7, held_out: int = 2) -> DataFrame:
    """Scores of all documents by a model of those that are not held out.

    A document is held out if crc32 of its ``doc_id`` as text, modulo
    ``folds``, is ``held_out``. Columns: ``doc_id``, ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one
    unigrams) and ``score`` (log10).
    """
    spark = docs.sparkSession
    out = F.coalesce(crc_mod("doc_id", folds) == held_out, F.lit(False))
    marked = texts(docs).select("doc_id", "text", (~out).alias("learn"))
    blocks = written(spark, marked.mapInArrow(_blocks, BLOCK_SCHEMA), "blocks", "zstd")
    folder = new_workspace(spark, "llm-entries")
    model = _model(blocks, _counted(blocks, folder))
    _gather_pairs(blocks, folder, model)
    for number in range(ROUNDS):
        model.weights, model.backing = _train_round(blocks, folder, model, number)
    scored = _score(blocks, folder, model)
    return scored.select(
        "doc_id",
        out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
