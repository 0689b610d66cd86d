"""The operators' parts against plain Python."""

from __future__ import annotations

import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from compare import differences
from edges import edge_items, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from assayer.llm import (
    ans,
    bpe,
    bwt,
    cube,
    maxent,
    packing,
    qdwh,
    quality,
    search,
    simhash,
    suffix,
    warc,
    whiten,
)
from assayer.llm.components import components
from assayer.llm.oracle import ORACLE
from assayer.llm.queries import QUERIES
from assayer.llm.merkle import changed_paragraphs, tree
from assayer.llm.tokens import SEPARATOR, word_encoder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.text(
    st.one_of(
        st.characters(exclude_categories=("Cs",)),
        st.sampled_from("aAeEtTnN.,'! \t\n\x0b\x0c\r\x1c\x85|0" + SEPARATOR + "́̌"),
    ),
    max_size=60,
)


# -- tokens --------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=8))
def test_word_ids_are_those_of_whole_texts(texts):
    ids, sizes = word_encoder(WORD_BPE).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    found = [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]
    assert found == plain.word_ids(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=8))
def test_byte_pairs(texts):
    coding = bpe.byte_pairs(BYTE_BPE, public_tokenizers.PATTERN)
    ids, sizes = coding.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == plain.byte_ids(texts)
    data, _ = coding.decode(ids, sizes)
    assert data.tobytes() == "".join(texts).encode()


@pytest.mark.parametrize("word", ["a" * 5000, "thetion" * 900, "xq" * 300, "ab" * 257])
def test_long_matches(word):
    coding = bpe.byte_pairs(BYTE_BPE, public_tokenizers.PATTERN)
    ids, _ = coding.encode(pa.array([word]))
    assert ids.tolist() == plain.byte_ids([word])[0]


# -- packing -------------------------------------------------------------------


def test_bounded_best_fit_against_a_list_of_bins():
    pick = random.Random(5)
    for limit in (1, 2, 7, 100):
        bins = packing.OpenBins(100, limit)
        opened: list[list[int]] = []  # [free, number], in the order of their last change
        made = 0
        for _ in range(2000):
            size = pick.randrange(1, 101)
            fit = [b for b in opened if b[0] >= size]
            if fit:
                free = min(b[0] for b in fit)
                chosen = [b for b in opened if b[0] == free][-1]
                opened.remove(chosen)
            else:
                if len(opened) == limit:
                    fullest = min(b[0] for b in opened)
                    opened.remove([b for b in opened if b[0] == fullest][-1])
                chosen = [100, made]
                made += 1
            assert bins.place(size) == (chosen[1], 100 - chosen[0])
            if chosen[0] > size:
                opened.append([chosen[0] - size, chosen[1]])


# -- token files ---------------------------------------------------------------


@pytest.mark.parametrize("size", [0, 1, 5, ans.BLOCK - 1, ans.BLOCK, 3 * ans.BLOCK + 17])
def test_ans_round_trip(size):
    ids = np.random.default_rng(size).zipf(1.3, size).clip(0, 49_000).astype(np.uint32)
    counts = np.bincount(ids, minlength=1)
    table = ans.Table.of(ans.scaled_frequencies(counts))
    assert size == 0 or int(table.freq.sum()) == 1 << ans.SCALE
    assert ((table.freq > 0) == (counts > 0)).all()
    blocks = ans.encode_blocks(ids, table) if size else []
    back = ans.decode_blocks(blocks, table) if blocks else []
    assert np.array_equal(np.concatenate([*back, np.zeros(0, np.uint32)]), ids)
    if size:
        share = counts[counts > 0] / size
        whole = len(blocks) * ans.BLOCK  # the last block is filled up
        entropy = -(share * np.log2(share)).sum() * whole / 8
        assert sum(map(len, blocks)) < 1.02 * entropy + ans._HEAD * len(blocks) + 1024


def test_ans_refuses_damage():
    ids = np.arange(ans.BLOCK, dtype=np.uint32) % 7
    table = ans.Table.of(ans.scaled_frequencies(np.bincount(ids)))
    block = bytearray(ans.encode_blocks(ids, table)[0])
    block[-9] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        ans.decode_blocks([bytes(block)], table)


@pytest.mark.parametrize("counts", [[1], [5, 0, 1], [1] * 3000, [10**12, 1, 1, 0, 3]])
def test_frequencies_add_up(counts):
    freq = ans.scaled_frequencies(np.array(counts))
    assert freq.sum() == 1 << ans.SCALE
    assert ((freq > 0) == (np.array(counts) > 0)).all()


# -- archives ------------------------------------------------------------------


def test_archive_in_small_chunks(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    payloads = [b"", b"x" * 1000, "é\r\n\r\nWARC/1.1\r\n".encode()]
    data = b"".join(
        warc.record(k, "http://x", p, None if k else 9) for k, p in enumerate(payloads)
    )
    found = list(warc.read_records(io.BytesIO(data)))
    assert [r.fields["warc-type"] for r in found] == ["revisit", "response", "response"]
    assert [r.http[1] for r in found[1:]] == payloads[1:]


@pytest.mark.parametrize("place", [3, -2, -60])
def test_damaged_archives_are_refused(place):
    data = zlib.decompress(warc.record(1, "http://x", b"payload" * 50, None), 31)
    broken = bytearray(data)
    broken[place] ^= 1
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(bytes(broken)) + packer.flush()
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(packed)))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(io.BytesIO(packed[:-3])))


# -- near-duplicates -----------------------------------------------------------


def test_pigeonring_keys_lose_no_pair():
    """Every pair within the distance shares a key from which its chains pass."""
    pick = random.Random(3)
    for distance, segments in ((4, 9), (3, 8), (0, 4), (1, 2), (4, 5), (6, 16)):
        ring = simhash.Ring(distance, segments)
        for _ in range(400):
            a = pick.getrandbits(64)
            b = a
            for bit in pick.sample(range(64), pick.randint(0, distance)):
                b ^= 1 << bit
            one, two = np.array([a], np.uint64), np.array([b], np.uint64)
            assert any(
                (a & mask) == (b & mask) and len(ring.linked(one, two, start))
                for start, mask in ring.keys()
            )


@pytest.mark.parametrize("block", [8, 4096])
def test_fingerprint_groups(spark, block):
    """Dense clusters, chains and strangers, in buckets larger than a block too."""
    pick = random.Random(block)
    prints = {0, 2**64 - 1}
    for _ in range(4):
        centre = pick.getrandbits(64)
        for _ in range(60):
            value = centre
            for bit in pick.sample(range(64), pick.randint(0, 3)):
                value ^= 1 << bit
            prints.add(value)
    value = pick.getrandbits(64)
    for k in range(0, 60, 4):
        value ^= 0b1111 << k
        prints.add(value)
    prints |= {pick.getrandbits(64) for _ in range(200)}
    signed = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    nodes = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    links = simhash.fingerprint_links(nodes, block=block)
    found = {r["node"]: r["component"] for r in components(links).collect()}
    groups = plain.components([v & (2**64 - 1) for v in signed])
    wanted = {v: signed[g] for v, g in zip(signed, groups)}
    assert {v: found.get(v, v) for v in signed} == wanted


def test_components_of_a_long_path(spark):
    links = spark.range(0, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(links.union(links)).collect()
    assert len(found) == 301 and {r["component"] for r in found} == {0}


# -- repeated passages ---------------------------------------------------------


def test_merged_transforms():
    pick = random.Random(1)
    for _ in range(150):
        letters = pick.choice(["ab", "abc", "a", "abcdefgh\0"])
        shards = [
            [
                "".join(pick.choices(letters, k=pick.randrange(30))).encode()
                for _ in range(pick.randrange(1, 6))
            ]
            for _ in range(pick.choice([1, 2, 3, 5]))
        ]
        made = [
            bwt.shard(np.frombuffer(b"".join(s), np.uint8), np.array([len(x) for x in s]))
            for s in shards
        ]
        for part, own in zip(made, shards):
            suffixes = [
                [b + 1 for b in own[s][o:]] + [s - 1000]
                for s, o in zip(part.string, part.offset)
            ]
            assert suffixes == sorted(suffixes)
            for s, o, symbol in zip(part.string, part.offset, part.transform):
                assert symbol == (own[s][o - 1] + 1 if o else bwt.END)
        depth = pick.choice([1, 3, 10])
        merged = bwt.merge(made, depth)
        strings = [x for s in shards for x in s]
        windows: dict[bytes, set] = {}
        for s, x in enumerate(strings):
            for o in range(len(x) - depth + 1):
                windows.setdefault(x[o : o + depth], set()).add((s, o))
        groups: dict[int, set] = {}
        order = []
        for s, o, g in zip(merged.string, merged.offset, merged.group):
            groups.setdefault(g, set()).add((int(s), int(o)))
            order.append(strings[s][o : o + depth])
        assert order == sorted(order)
        wanted = [w for w in windows.values() if len(w) > 1]
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted))
        assert (merged.shared == depth).sum() == len(merged.group)


@pytest.mark.parametrize("hot", [2, 10**6])
def test_spans_over_many_blocks(spark, hot):
    """Passages with different neighbours, periods, and cores with many reaches."""
    pick = random.Random(hot)
    word = lambda: "".join(pick.choices("abcdefgh", k=pick.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(40)
    rows = []
    for k in range(60):
        text = prose(pick.randrange(0, 60))
        if k % 3 == 0:
            text += passage[pick.randrange(20) : len(passage) - pick.randrange(20)] + prose(10)
        if k % 10 == 0:
            text += "ab" * 150
        if k % 15 == 0 and rows:
            text = rows[k // 2]["text"]
        rows.append({"doc_id": (k * 37) % 60, "text": text})
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    found = suffix.repeated_spans(docs.repartition(4), block_bytes=1000, hot=hot).collect()
    gone = {r["doc_id"]: g for r, g in zip(rows, plain.repeated_bytes(rows))}
    texts = {r["doc_id"]: r["text"].encode() for r in rows}
    assert len(found) == len(rows)
    for r in found:
        marks = np.zeros(r["n_bytes"], bool)
        for a, b in zip(r["begins"], r["ends"]):
            assert not marks[a:b].any() and (a == 0 or not marks[a - 1])
            marks[a:b] = True
        assert np.array_equal(marks, gone[r["doc_id"]])
        kept = np.frombuffer(texts[r["doc_id"]], np.uint8)[~marks].tobytes()
        assert bytes(r["kept"]) == kept


def test_tasks_hold_one_block_at_a_time(spark, tmp_path):
    """Rows have no text, of which Spark and Parquet would hold many blocks at once."""
    texts = [(k, "".join(random.Random(k).choices("abcdefgh ", k=400))) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    made = suffix._blocks(docs, str(tmp_path), 1000)
    assert [row["bytes"] for row in made] == [800] * 30
    assert len({row["block"] for row in made}) == len({row["file"] for row in made}) == 30
    listed = pa.RecordBatch.from_pylist([row.asDict() for row in made])
    found = []
    for columns, block in suffix._each_block(iter([listed]), str(tmp_path)):
        assert columns.num_rows == 1 and len(block.data) == 800
        assert block.docs.tolist() == columns["docs"][0].as_py()
        found += zip(block.docs.tolist(), np.split(block.array, np.cumsum(block.lengths)))
    assert [(k, part.tobytes().decode()) for k, part in found] == texts


def test_messages_are_dealt_by_the_size_of_the_input(spark):
    """Whatever the session's number of partitions, and in a single shuffle."""
    none = spark.createDataFrame([], suffix.MESSAGE)
    for tasks in (2, 300):
        dealt = suffix._dealt(none, tasks * suffix.TASK_BYTES + 1)
        found = dealt.groupBy("kind", "bucket").applyInArrow(lambda rows: rows, suffix.MESSAGE)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        assert re.search(rf"hashpartitioning\(kind#\d+, bucket#\d+, {tasks}\)", plan)


# -- language model ------------------------------------------------------------


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(1)
    rows = rng.integers(1, 50, (maxent.FEATURES_PER_TOKEN, 4000)).astype(np.uint16)
    classes = (rows[0] % maxent.CLASSES).astype(np.int64)
    weights = np.zeros((maxent.FEATURES, maxent.CLASSES), np.float32)
    squares = np.ones_like(weights)

    def loss():
        chance = maxent.class_probabilities(weights, rows)
        assert np.allclose(chance.sum(1), 1, atol=1e-4)
        return -np.log(chance[np.arange(4000), classes]).mean()

    before = loss()
    values = rng.normal(size=(4000, 3)).astype(np.float32)
    sums, times = maxent._sums_by_row(values, rows)
    for row in range(60):
        of = (rows == row).sum(0)
        assert times[row] == of.sum() and np.allclose(sums[row], of @ values, atol=1e-3)
    for _ in range(30):
        maxent.gradient_steps(weights, squares, rows, classes)
    assert loss() < before - 1


def steps_of(spark, rows: list[tuple]):
    """Blocks, the folder of their files and the trained model of small documents."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)).alias("learn")
    marked = maxent.texts(docs).select("doc_id", "text", learn)
    blocks = maxent.written(spark, marked.mapInArrow(maxent._blocks, maxent.BLOCK_SCHEMA), "t")
    folder = maxent.new_workspace(spark, "t")
    model = maxent._model(blocks, maxent._counted(blocks, folder))
    maxent._gather_pairs(blocks, folder, model)
    for number in range(maxent.ROUNDS):
        model.weights, model.backing = maxent._train_round(blocks, folder, model, number)
    return blocks, folder, model


def small_texts(n: int = 300) -> list[tuple]:
    pick = random.Random(3)
    words = [f"w{int(pick.paretovariate(0.7))}" for _ in range(4000)] + ["The", "of", "é"]
    texts = [" ".join(pick.choices(words, k=pick.randrange(30))) for _ in range(n)]
    texts[5] = texts[6] = texts[7] = "one two three two one two three"
    return [(k, t) for k, t in enumerate(texts)] + [(None, "of of"), (8, None), (9, "")]


def word_classes(blocks, folder, model) -> dict[str, tuple[int, int, int]]:
    """Class, count and hash of every word that occurs."""
    found = {}
    for row in blocks.collect():
        entries = maxent.Entries.read(folder, row["block"])
        known = zip(model.classes(entries), entries.counts, entries.hashes)
        found |= dict(zip(row["words"], ((int(c), int(n), int(h)) for c, n, h in known)))
    return found


def test_scores_against_plain_counts(spark):
    """Every factor worked out by itself, from counts in dictionaries."""
    rows = small_texts()
    blocks, folder, model = steps_of(spark, rows)
    words = word_classes(blocks, folder, model)
    tokens = [[*plain.WORD.findall(plain.lowered(t or "")), maxent.END] for _, t in rows]
    learned = [i is None or i % 3 != 0 for i, _ in rows]
    count, pair, after = Counter(), Counter(), Counter()
    for own, learn in zip(tokens, learned):
        for before, word in zip([None, *own], own if learn else []):
            count[word] += 1
            pair[before, word] += 1
            after[before, words[word][0]] += 1
    assert all(words[w][1] == count[w] for w in words)
    total = model.class_mass + model.class_types
    found = {}
    for r in maxent._score(blocks, folder, model).collect():
        found.setdefault(r["doc_id"], []).append(r["score"])
    for (doc_id, _), own, learn in zip(rows, tokens, learned):
        hashes = np.array([words[w][2] for w in own], np.uint32)
        features = maxent.feature_rows(hashes, np.array([len(own)]))
        score = 0.0
        for k, word in enumerate(own):
            c, n, _ = words[word]
            before = own[k - 1] if k else None
            logit = model.weights[0] + sum(model.weights[r] for r in features[:, k])
            chance = np.exp(logit[c]) / np.exp(logit.astype(float)).sum()
            m, seen = pair[before, word] - learn, after[before, c] - learn
            whole = (count[before] if k else sum(learned)) - learn
            share = min(1.0, (n - learn + 1) / (total[c] - learn))
            a = np.exp(model.backing[0][whole.bit_length()])
            b = np.exp(model.backing[1][seen.bit_length()])
            score += np.log((seen + a * chance) / (whole + a))
            score += np.log((m + b * share) / (seen + b))
        assert min(abs(x - score / np.log(10)) for x in found[doc_id]) < 1e-3


def test_probabilities_add_up(spark):
    """Over all words and the unknown ones, after any word."""
    blocks, folder, model = steps_of(spark, small_texts(120))
    words = word_classes(blocks, folder, model)
    learned = {w: v for w, v in words.items() if v[1]}
    after = defaultdict(Counter)
    for doc_id, text in small_texts(120):
        if doc_id is None or doc_id % 3:
            own = [*plain.WORD.findall(plain.lowered(text or "")), maxent.END]
            for before, word in zip([None, *own], own):
                after[before][word] += 1
    zero = np.zeros(1, np.int64)
    for before in [None, "one", "two", "of", "never seen"]:
        seen = Counter()
        for word, n in after[before].items():
            seen[learned[word][0]] += n
        mass = np.zeros(maxent.CLASSES)
        low = range(1 + maxent.SINGLES, 1 + maxent.SINGLES + maxent.SHAPES)
        unknown = [(c, 0, None) for c in low]
        for c, n, word in [(c, n, w) for w, (c, n, _) in learned.items()] + unknown:
            share = model.share(np.array([n]), np.array([c]), zero)
            pair, of_class = np.array([after[before][word]]), np.array([seen[c]])
            mass[c] += maxent.backed(model.backing[1], pair, of_class, share)[0][0]
        used = (model.class_mass + model.class_types) > 0
        assert np.allclose(mass[used], 1)
        softmax = np.random.default_rng(1).dirichlet(np.ones(maxent.CLASSES))
        of_class = np.array([seen[c] for c in range(maxent.CLASSES)])
        whole = np.full(maxent.CLASSES, of_class.sum())
        assert np.isclose(maxent.backed(model.backing[0], of_class, whole, softmax)[0].sum(), 1)


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
@pytest.mark.parametrize("limit", [5, 1 << 40, 1 << 62])
def test_distinct_codes_and_order_of_hashes(n, limit):
    codes = np.random.default_rng(n).integers(0, limit, n)
    found, whose = maxent.distinct(codes, limit)
    wanted, places = np.unique(codes, return_inverse=True)
    assert np.array_equal(found, wanted) and np.array_equal(whose, places)
    keys = maxent.mixed(codes.astype(np.uint64), np.arange(n, dtype=np.uint64) // 2)
    order = maxent.by_hash(keys)
    assert sorted(order.tolist()) == list(range(n))
    high = keys[order] >> np.uint64(20)
    assert (high[1:] >= high[:-1]).all()


def test_slope_of_the_backing_weights():
    rng = np.random.default_rng(2)
    seen = rng.integers(0, 50, 40)
    pair = np.minimum(rng.integers(0, 9, 40), seen)
    share, backing = rng.random(40), rng.normal(size=maxent.SEEN_BINS)
    _, bins, slope = maxent.backed(backing, pair, seen, share)
    step = 1e-6
    for k in range(40):
        moved = backing.copy()
        moved[bins[k]] += step
        ends = [maxent.backed(b, pair, seen, share)[0][k] for b in (backing, moved)]
        assert abs((np.log(ends[1]) - np.log(ends[0])) / step - slope[k]) < 1e-4


def test_more_words_than_rows_of_weights_are_told_apart(spark):
    """What follows each of 40,000 words, at random, is learned."""
    rng = np.random.default_rng(5)
    after = rng.integers(0, 2, 40_000).tolist()
    held = [plain.crc_mod(i, 7) == 2 for i in range(80_000)]
    free = iter([i for i in range(80_000) if not held[i]])
    kept = iter([i for i in range(80_000) if held[i]])

    def text(i: int, third: int) -> str:
        return f"a{i // 200}b{i % 200} {'yn'[third]}"

    # Every word is seen once, half of them twice.
    rows = [(next(free), text(i, after[i])) for i in range(40_000) for _ in range(1 + i % 2)]
    probes = []
    for i in rng.integers(0, 40_000, 2000).tolist():
        probes.append((next(kept), next(kept)))
        rows += zip(probes[-1], (text(i, after[i]), text(i, 1 - after[i])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    score = {r["doc_id"]: r["score"] for r in maxent.score_documents(docs).collect()}
    assert np.mean([score[right] > score[wrong] for right, wrong in probes]) > 0.95


def test_texts_that_occur_twice_score_apart(spark):
    """Also those that were learned from: their own tokens do not count."""
    rng = np.random.default_rng(9)
    made = [" ".join(f"v{k}" for k in rng.integers(0, 3000, 60)) for _ in range(400)]
    texts = made + made[:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = maxent.score_documents(docs.repartition(3)).collect()
    twice = {k for k in range(40)} | {400 + k for k in range(40)}
    mean = {r["doc_id"]: r["score"] / r["n_tokens"] for r in rows}
    learned = {r["doc_id"] for r in rows if not r["held_out"]}
    pairs = {k for k in twice if (k + 400 if k < 40 else k - 400) in learned}
    alone = [mean[k] for k in mean if k not in twice]
    caught = [mean[k] > max(alone) for k in pairs]
    assert np.mean(caught) > 0.95


# -- special tokens ------------------------------------------------------------


PARTS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", ">", "a", "Ab."]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PARTS, " ", "\n", "é", "don't"])).map("".join)))
def test_special_strings_are_what_the_library_makes_of_them(texts):
    ids, sizes = word_encoder(WORD_BPE).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    found = [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]
    assert found == plain.word_ids(texts)


def test_token_files_keep_every_id(spark, tmp_path):
    least = -(2**63)
    rows = [(least, "least"), (None, "none"), (None, "nil"), (0, "zero <|endoftext|> x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    files = ans.write_ids(docs, str(tmp_path), WORD_BPE)
    back = ans.read_ids(spark, str(tmp_path), files).orderBy("start").collect()
    assert [r["doc_id"] for r in back] == [None, None, least, 0]
    ids = np.frombuffer(back[-1]["ids"], "<u4").tolist()
    assert ids == plain.word_ids([rows[-1][1]])[0] + [1]


def test_a_task_begins_a_new_archive(spark, tmp_path):
    rows = [(k, f"http://{k}", f"page {k} " + "x" * 50) for k in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(pages, str(tmp_path), most=5000)
    made = archives.collect()
    assert len(made) > 3 and sum(r["records"] for r in made) == 100
    assert all(r["bytes"] < 5000 + 1000 for r in made)
    assert all((tmp_path / r["file"]).stat().st_size == r["bytes"] for r in made)
    back = warc.read_archives(spark, str(tmp_path), archives).collect()
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in back) == [
        (k, html) for k, _, html in rows
    ]


# -- native operators ----------------------------------------------------------


def test_native_plans_have_no_python(spark, tables):
    for name in ("op5_quality_rules", "op6_merkle"):
        plan = QUERIES[name](spark, tables["edge"])._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab \n.|!#Hom", max_size=80), min_size=1, max_size=5))
def test_quality_of_any_text(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.judge(docs).collect():
        text, q = r["document"]["text"], r["quality"]
        base = (
            q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"],
            q["n_repeat_words"], q["base_failed"],
        )
        assert base == plain.base_rules(text)
        assert (q["clean_text"], q["kept"]) == plain.cleaned(text)


MENU_PARTS = [*plain.MENU, *plain.NOTICES, "us", "to", "stone", "Ünder", "x", "powered by "]


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.lists(st.sampled_from([*MENU_PARTS, " ", " | ", "  ", "-", ".", "é"]), max_size=7),
        min_size=1,
        max_size=30,
    )
)
def test_menus_and_notices(spark, lines):
    made = ["".join(p.title() if k % 3 else p for k, p in enumerate(line)) for line in lines]
    made = [line.replace("\n", " ") for line in made]
    docs = spark.createDataFrame([(1, "\n".join(made))], "doc_id long, text string")
    [row] = quality.judge(docs).collect()
    assert row["quality"]["clean_text"] == plain.cleaned("\n".join(made))[0]


def test_lines_of_a_million_words_and_marks(spark, tmp_path):
    """No pattern may need stack or time in more than proportion to a line."""
    n = 1_000_000
    good = prose(3, 60)
    lines = [
        "home " * n, "| " * n, " " * n + "x", "#" * n, "»home" * n, "a" * n + ".", "a. " * n,
        " x" * 3 + " " * n + ".", "contact " * n + "stone", "\x0b \r" * n, "log " * n,
    ]
    rows = [(k, f"{good}\n{line}\n{good}") for k, line in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op5_quality_rules"](spark, str(tmp_path)).collect()
    found = {r["doc_id"]: r for r in found}
    for k, text in rows:
        base = plain.base_rules(text)
        row = found[k]
        assert (row["n_words"], row["word_chars"], row["n_symbols"]) == base[:3]
        assert (row["n_dup_lines"], row["n_repeat_words"], row["base_failed"]) == base[3:]
        assert row["kept"] == plain.cleaned(text)[1]
        assert row["n_bad_lines"] == sum(not plain.line_passes(x) for x in text.split("\n"))
    query, sql = QUERIES["op5_quality_rules"], ORACLE["op5_quality_rules"]
    assert differences(spark, query, sql, str(tmp_path)) == []


def test_differing_branches_locate_an_edit(spark):
    lines = [f"Paragraph {k}. It has two sentences, and a clause." for k in range(40)]
    changed = lines[:17] + ["Something else."] + lines[18:]
    inserted = lines[:5] + ["New."] + lines[5:]
    rows = [("\n".join(lines), "\n".join(changed)), ("\n".join(lines), "\n".join(inserted))]
    frame = spark.createDataFrame(rows, "a string, b string")
    frame = frame.select(tree(F.col("a")).alias("a"), tree(F.col("b")).alias("b"))
    found = frame.select(
        changed_paragraphs(F.col("b"), F.col("a")).alias("places"),
        F.size(F.array_except("b.sections", "a.sections")).alias("sections"),
        F.size("b.sections").alias("all"),
    ).collect()
    assert [r["places"] for r in found] == [[17], [5]]
    assert all(r["sections"] <= 2 < r["all"] for r in found)


def test_sections_do_not_depend_on_cutting_paragraphs(spark):
    """Texts that differ in their line ends only have different trees."""
    texts = ["a. b", "a.\nb", "a.  b", "a. b ", "a. b\n", "", "\n", " "]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    roots = [r["root"] for r in frame.select(tree(F.col("text"))["root"].alias("root")).collect()]
    assert len(set(roots)) == len(texts)


# -- mixing --------------------------------------------------------------------


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=20))
def test_words_are_counted_without_a_list(spark, texts):
    texts = [*texts, " " * 10**5, "a " * 10**5, " \n" * 3 + "b" * 10**5]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = frame.select(cube.word_count(F.col("text"))).collect()
    assert [r[0] for r in found] == [len(plain.WORD.findall(t)) for t in texts]


def falling(rng, n: int) -> np.ndarray:
    return np.sort(rng.zipf(1.5, n).clip(0, 20_000))[::-1]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 400])
@pytest.mark.parametrize("equal", [False, True])
def test_flight_keeps_both_totals(n, equal):
    rng = np.random.default_rng(n)
    sizes = np.full(n, 9) if equal else falling(rng, n)
    chances = np.full(n, 0.37)
    p = cube.flight(sizes, chances, rng.random(n))
    assert ((p >= 0) & (p <= 1)).all()
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert abs(p.sum() - chances.sum()) < 1e-9 * max(1, n)
    assert abs(p @ sizes - chances @ sizes) < 1e-9 * max(1, sizes.sum())


def test_flight_keeps_every_chance_on_average():
    rng = np.random.default_rng(4)
    sizes, chances = falling(rng, 40), np.full(40, 0.3)
    runs = 3000
    mean = sum(cube.decided(sizes, chances, [k], last=False) for k in range(runs)) / runs
    assert np.abs(mean - 0.3).max() < 5 * np.sqrt(0.3 * 0.7 / runs)


def test_a_document_that_no_other_can_make_up_for():
    sizes, chances = np.array([1000, 3, 3, 3, 3]), np.full(5, 0.5)
    p = cube.flight(sizes, chances, np.full(5, 0.9))
    assert p[0] == 0.5 and abs(p.sum() - 2.5) < 1e-12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.floats(0.01, 0.99)), max_size=9))
def test_landing_is_the_best_choice(units):
    sizes = np.array([s for s, _ in units], float)
    chances = np.array([p for _, p in units], float)
    chosen = cube.landing(sizes, chances)

    def cost(taken) -> float:
        words = abs(sum(n for n, t in zip(sizes, taken) if t) - sizes @ chances)
        return words + abs(sum(taken) - chances.sum())

    every = ([c >> k & 1 for k in range(len(units))] for c in range(1 << len(units)))
    assert abs(cost(chosen.tolist()) - min(map(cost, every))) < 1e-6


def test_mix_in_blocks_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(cube, "BLOCK", 16)
    monkeypatch.setattr(cube, "FAN_IN", 4)
    words = [(k * k) % 97 + 1 for k in range(600)]
    rows = [(k, "w " * n, "hot" if k % 3 else "cold", 5) for k, n in enumerate(words)]
    rows += [(7, "again and again", "hot", 5)] * 300  # rows that are alike
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place int")
    found = cube.mix(docs, weights=(1, 3)).collect()
    assert len(found) == 900
    for source in ("hot", "cold"):
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3
        count = len(own) * own[0]["target"] / own[0]["source_size"]
        assert abs(sum(r["copies"] for r in own) - count) <= 7
    parts = docs.repartition(7, "text")
    assert sorted(map(tuple, cube.mix(parts, weights=(1, 3)).collect())) == sorted(
        map(tuple, found)
    )


# -- search --------------------------------------------------------------------


def test_terms_are_bytes_of_words():
    text = "Don't-STOP ÀÉ àéx y_z 漢字9"
    want = [t.encode() for t in plain.TERM.findall(plain.lowered(text))]
    assert search.terms_of(text.encode()) == want


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_terms_are_counted_piece_by_piece(text, piece):
    words = search.terms_of(text.encode())
    assert search.counted_terms(text.encode(), piece) == (len(words), Counter(words))


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(1)
    best = search.Best(5, 4)
    rows = []
    for _ in range(30):
        scores = rng.integers(0, 4, (2, 9))
        ids = rng.integers(0, 50, 9)
        none = rng.random(9) < 0.1
        best.offer(3, scores, np.where(none, 0, ids), none)
        for (i, j), s in np.ndenumerate(scores):
            rows.append((i + 3, -s, bool(none[j]), 0 if none[j] else int(ids[j])))
    want = []
    for item in (3, 4):
        want += sorted(r for r in rows if r[0] == item and r[1] < 0)[:4]
    found = zip(*(best.rows[n].tolist() for n in ("item", "score", "no_id", "doc_id")))
    assert [(i, -s, b, d) for i, s, b, d in found] == want


def test_search_in_small_tiles_and_blocks(spark, edge_docs, edge_rows, monkeypatch):
    for name, value in (("TILE_ITEMS", 2), ("TILE_DOCUMENTS", 3), ("BLOCK_ITEMS", 3)):
        monkeypatch.setattr(search, name, value)
    monkeypatch.setattr(search, "TILE_TERMS", 7)
    items = spark.createDataFrame(edge_items(), "item_id long, text string")
    found = search.search(edge_docs, items, 3).collect()
    want = plain.search(edge_rows, edge_items(), 3)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


# -- whitening -----------------------------------------------------------------


@pytest.mark.parametrize("d", [0, 1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["wide", "definite", "steps", "equal", "none", "steep"])
def test_spectral_division(d, kind):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d))
    q = np.linalg.qr(a)[0] if d else a
    a = {
        "wide": a + a.T,
        "definite": a @ a.T,
        "steps": q @ np.diag(rng.integers(0, 3, d).astype(float)) @ q.T,
        "equal": 3 * np.eye(d),
        "none": np.zeros((d, d)),
        "steep": q @ np.diag(10.0 ** -np.arange(d).clip(0, 14)) @ q.T,
    }[kind]
    a = (a + a.T) / 2
    values, vectors = qdwh.components(a)
    want = np.linalg.eigvalsh(a)[::-1]
    scale = max(1e-300, np.abs(want).max(initial=0))
    assert np.abs(values - want).max(initial=0) < 1e-13 * scale
    assert np.linalg.norm(vectors.T @ vectors - np.eye(d)) < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * values) < 1e-13 * scale
    first, columns = qdwh.components(a, 5)
    assert np.abs(first - want[:5]).max(initial=0) < 1e-13 * scale
    assert columns.shape == (d, min(d, 5))


@pytest.mark.parametrize("least", [1.0, 1e-3, 1e-15])
def test_polar_factor(least):
    rng = np.random.default_rng(3)
    u, v = (np.linalg.qr(rng.standard_normal((9, 9)))[0] for _ in range(2))
    a = u @ np.diag(np.geomspace(1, least, 9)) @ v
    assert np.linalg.norm(qdwh.polar(a, least) - u @ v) < 1e-12 / min(1, least * 1e3)


def test_deviations_are_exact_up_to_64_bits_and_null_beyond():
    x = np.array([[10**9, 0], [-(10**9), 1], [3, 5]], np.int64)
    sums = [int(c) for c in x.sum(axis=0)]
    model = whiten.Whitening(3, sums, np.ones(2), np.eye(2), 2.0)
    want = [sum((3 * int(c) - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert model.deviations(x) == [w if w < 2**63 else None for w in want]
    assert want[0] < 2**63
    far = x * 10
    sums = [int(c) for c in far.sum(axis=0)]
    model = whiten.Whitening(3, sums, np.ones(2), np.eye(2), 2.0)
    assert model.deviations(far)[0] is None
