"""Text operators against brute force, held-out accuracy and exact round trips, on small tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from public_tokenizers import path as vocabulary_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cascata.llm import bpe, ctw, features, lang_id, packing, quality, queries, simhash, toxicity, url_filter

SF = "/root/testdata/sf0.001"
VOCABULARY = vocabulary_path("byte_bpe_50k.json")
ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, keep string, bits long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Nulls, empty and long texts, repeated rows, extra columns whose names clash with those of results."""
    rows = [(900_001, None), (900_002, ""), (900_003, " \n"), (900_004, "12 34"), (None, "Some text of nobody."), (900_005, "ab " * 30_000),
            (900_006, "Of the same and the same."), (900_006, "Of the same and the same."), (900_007, "<|endoftext|>a'll  b\u2003\n")]
    extra = spark.createDataFrame([(i, t, None, None, None, 2.0, "x", 5) for i, t in rows], ODD)
    plain = docs.limit(40).withColumn("score", F.lit(2.0)).withColumn("keep", F.lit("x")).withColumn("bits", F.lit(5).cast("long"))
    return extra.unionByName(plain).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def crc(key, divisor):
    return zlib.crc32(str(key).encode()) % divisor


def test_bpe_agrees_with_the_library_on_random_texts(library):
    random.seed(1)
    parts = ["a", "b", "re", "ll", "'s", "'t", "'", "''", " ", "  ", "\n", "\t", " ", "\u3000", "1", "23", "é", "ñ", "中文", "!", "...", "🙂",
             "<|endoftext|>", "\r\n", "\x1c", "\x85", "'re", "'VE", "don't", "²", "Ⅷ", "_", "\0", "aaaa", "ab"]
    made = ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(3000)] + ["", "  ", "a" * 5000, "ab" * 3001]
    encoder = bpe.Encoder(bpe.Vocabulary(VOCABULARY), most_pieces=500)
    ids, lengths = encoder.encode(made)
    ends = np.cumsum(lengths)
    for text, end, length in zip(made, ends, lengths):
        assert ids[end - length : end].tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder._encode_plainly(*_laid_out(encoder, "a b  c's"))[0].tolist() == library.encode("a b  c's", add_special_tokens=False).ids


def _laid_out(encoder, text):
    points = np.frombuffer((text + "\0\0\0").encode("utf-32-le"), np.uint32)
    kinds = encoder.kinds[points]
    kinds[-3:] = bpe.END
    return points, *bpe.cut_pieces(points, kinds), np.array([len(text)])


def test_bpe_cuts_very_long_texts_without_a_trace(library, monkeypatch):
    monkeypatch.setattr(bpe, "PART_CHARS", 50)
    text = "It's the  long one,\n\n with   blanks and words. " * 40
    assert len(list(bpe.safe_parts(text))) > 10 and "".join(bpe.safe_parts(text)) == text
    encoder = bpe.Encoder(bpe.Vocabulary(VOCABULARY))
    assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_op10_digests(spark, texts, library):
    rows = {r.doc_id: r for r in queries.op10_bpe(spark, SF).collect()}
    assert set(rows) == set(texts)
    for key, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[key].n_tokens == len(ids)
        assert rows[key].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[key].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_round_trip_keeps_odd_rows_and_columns(odd, empty):
    back = bpe.decode(bpe.encode(odd, VOCABULARY), VOCABULARY)
    assert back.columns == [*odd.columns, "token_ids", "decoded"]
    assert back.where("decoded <> coalesce(text, '')").count() == 0 and back.count() == odd.count()
    assert bpe.encode(empty, VOCABULARY).count() == 0


def packed_well(rows, ids, capacity):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length))
        assert r.doc_tokens == len(ids[r.doc_id]) + 1
    for spans in sequences.values():
        assert sum(n for _, n in spans) <= capacity
    for spans in sequences.values():
        at = 0
        for begin, n in sorted(spans):
            assert begin == at and n > 0
            at += n
    return sequences, pieces


def test_op5_pieces(spark, texts, library):
    ids = {k: library.encode(t, add_special_tokens=False).ids for k, t in texts.items()}
    rows = queries.op5_packing(spark, SF).collect()
    sequences, pieces = packed_well(rows, ids, 2048)
    assert {k for k, _ in pieces} == set(texts)
    for (key, total), spans in pieces.items():
        at = 0
        for begin, n in sorted(spans):
            assert begin == at
            at += n
        assert at == total
    for r in rows:
        part = np.array([*ids[r.doc_id], 1][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
    assert len(sequences) == -(-sum(len(x) + 1 for x in ids.values()) // 2048)


def test_packing_merges_leftovers_of_many_partitions_in_a_tree(spark, odd, empty):
    rows = packing.pack(odd.repartition(13), VOCABULARY, capacity=64, open_windows=3, fan_in=3).collect()
    sequences = defaultdict(int)
    for r in rows:
        assert len(r.token_ids) == r.length
        sequences[r.sequence_id] += r.length
    assert sum(n < 64 for n in sequences.values()) <= 1
    assert Counter(r.doc_id for r in rows if r.start == 0)[900_006] == 2
    assert [r.token_ids for r in rows if r.doc_id == 900_001] == [[1]]
    assert packing.pack(empty, VOCABULARY).count() == 0


def brute_fingerprint(text, words=3):
    found = text.encode().lower().split()
    shingles = [b" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(near):
    labels = np.arange(len(near))
    while True:
        renewed = np.array([labels[row].min() for row in near])
        if (renewed == labels).all():
            return labels
        labels = renewed


def test_op2_fingerprints_and_components(spark, texts):
    rows = sorted(queries.op2_simhash(spark, SF).collect())
    assert [r.doc_id for r in rows] == sorted(texts)
    bits = np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    assert bits.tolist() == [brute_fingerprint(texts[r.doc_id]) for r in rows]
    labels = components(np.bitwise_count(bits[:, None] ^ bits[None]) <= 3)
    assert [r.component_id for r in rows] == [rows[k].doc_id for k in labels]


@pytest.mark.parametrize("radius", range(6))
def test_bit_sliced_comparison_finds_just_the_near(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, (150, 2)).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3, 150, 2)).astype(np.uint64)
    values = np.concatenate([base, base ^ flips[0], base ^ flips[0] ^ flips[1], base ^ flips[2] ^ flips[1]])
    i, j = simhash.near(values, simhash.bit_planes(values), len(values), radius)
    wanted = np.argwhere(np.bitwise_count(values[:, None] ^ values[None]).sum(axis=2) <= radius)
    order = np.lexsort((j, i))
    assert np.array_equal(np.stack([i, j], 1)[order], wanted)


def test_links_survive_small_groups_and_tiles(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(1 << 62), 1 << 62, 60)
    values = {int(v) for b in base for v in (b, b ^ 1, b ^ 0b110, b ^ (7 << 40))} | {int(base[0]) ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(30)}
    rows = list(enumerate(sorted(values)))
    table = spark.createDataFrame(rows, "node long, bits long")
    found = dict(map(tuple, simhash.connected(simhash.links(table, group_rows=64, tile_rows=40)).collect()))
    bits = np.array([v for _, v in rows]).view(np.uint64)
    labels = components(np.bitwise_count(bits[:, None] ^ bits[None]) <= 3)
    assert [found.get(k, k) for k, _ in rows] == labels.tolist()


def test_simhash_slices_and_odd_rows(odd, empty, monkeypatch):
    text = "A b c d\te f, " * 50
    whole = simhash.fingerprint([text.encode(), b"", b" ", b"one", b"one TWO"])
    assert whole[:, 0].tolist() == [brute_fingerprint(t) for t in (text, "", " ", "one", "one TWO")]
    monkeypatch.setattr(simhash, "SLICE_BYTES", 20)
    assert np.array_equal(simhash.fingerprint([text.encode()], 3, 3), simhash.fingerprint([text.encode()], 3, 3))
    assert simhash.fingerprint([text.encode()])[0, 0] == whole[0, 0]
    monkeypatch.undo()
    found = {r.doc_id: r for r in simhash.near_duplicates(odd).collect()}
    assert found[900_001].fingerprint == "0" * 16
    assert found[900_001].component_id == found[900_002].component_id == found[900_003].component_id == 900_001
    assert simhash.near_duplicates(odd).count() == odd.count()
    assert simhash.near_duplicates(empty).count() == 0


def test_near_copies_of_the_pipeline(spark, empty):
    rng = random.Random(3)
    words = ["w%d" % k for k in range(5000)]
    rows, group = [], {}
    for g in range(40):
        text = rng.choices(words, k=300)
        for c in range(4):
            changed = list(text)
            for _ in range(c):  # each change touches five of some 300 shingles
                changed[rng.randrange(300)] = rng.choice(words)
            group[len(rows)] = g
            rows.append((len(rows), " ".join(changed), "extra"))
    table = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = simhash.keep_first(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4 * g for g in range(40)]
    assert simhash.keep_first(empty).count() == 0


def test_repeated_passages_do_not_make_copies(spark):
    """Near copies are told by shingle sets: a passage repeated often neither joins texts nor parts copies."""
    rng = random.Random(4)
    words = ["w%d" % k for k in range(5000)]
    passage = " ".join(rng.choices(words, k=10))
    apart = [" ".join(rng.choices(words, k=100)) + " " + " ".join([passage] * 40) for _ in range(6)]
    text = rng.choices(words, k=300)
    copies = [" ".join(text + rng.choices(words, k=3)), " ".join(text) + " " + " ".join([passage] * 60)]
    table = spark.createDataFrame(list(enumerate(apart + copies)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_first(table).collect()) == [0, 1, 2, 3, 4, 5, 6]


def jaccard_pairs(texts, least):
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.lower().split() for t in texts)]
    return np.array([[len(x & y) >= least * len(x | y) for y in sets] for x in sets])


def test_only_copies_of_the_wanted_similarity_are_joined(spark):
    """Pairs from 0.6 to 0.79 all stay, also in chains and in tiles; pairs from 0.8 on are joined."""
    rng = random.Random(6)
    words = ["w%d" % k for k in range(5000)]
    texts = []
    for shared in (320, 330, 340, 345, 350, 380, 390):
        for _ in range(4):
            text = rng.choices(words, k=shared)
            texts += [" ".join(text + rng.choices(words, k=400 - shared)) for _ in range(3)]
    labels = components(jaccard_pairs(texts, 0.8))
    assert 0 < (labels != np.arange(len(texts))).sum() < 0.5 * len(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.component_id for r in simhash.similar(table).orderBy("doc_id").collect()] == labels.tolist()


def test_pairs_just_at_the_similarity_are_found(spark):
    """Pairs of Jaccard 0.8 against brute force, of long texts and of texts of few shingles."""
    rng = random.Random(8)
    words = ["w%d" % k for k in range(5000)]
    texts = []
    for length, changed in [(400, 44)] * 60 + [(9, 1)] * 60:
        text = rng.choices(words, k=length)
        texts += [" ".join(text), " ".join(text[:-changed] + (rng.choices(words, k=changed) if length > 9 else []))]
    near = jaccard_pairs(texts, 0.8)
    assert near.sum() == 2 * len(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [r.component_id for r in simhash.similar(table).orderBy("doc_id").collect()]
    assert found == components(near).tolist()


def test_near_copies_of_the_given_documents_are_those_of_brute_force(spark, docs):
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    wanted = components(jaccard_pairs([r.text or "" for r in rows], 0.8))
    found = {r.doc_id: r.component_id for r in simhash.similar(docs).collect()}
    worded = [i for i, r in enumerate(rows) if len((r.text or "").split()) >= 5]
    assert [found[rows[i].doc_id] for i in worded] == [rows[wanted[i]].doc_id for i in worded]


def test_texts_from_one_template_stay_apart(spark):
    """Half of each text is the same template; no two are alike, though each is near to hundreds."""
    rng = random.Random(12)
    words = ["w%d" % k for k in range(5000)]
    template = rng.choices(words, k=150)
    texts = [" ".join(template + rng.choices(words, k=150)) for _ in range(400)]
    texts += [texts[7] + " and more", texts[8] + " and more"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in table.collect()} - {r.doc_id for r in simhash.keep_first(table).collect()} == {400, 401}


def test_a_set_takes_part_in_as_many_groups_at_any_size(spark, docs):
    few = simhash.set_fingerprints(docs.limit(20), "doc_id", "text", 5, 4)
    assert {len(r.bands) for r in few.collect()} == {simhash.BANDS} == {len(r.bands) for r in simhash.set_fingerprints(docs, "doc_id", "text", 5, 4).collect()}


@pytest.mark.parametrize("radius", (0, 3, 65))
def test_counting_words_and_planes_finds_the_same(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, (100, 4)).astype(np.uint64)
    flips = np.packbits(rng.random((100, 256)) < 0.25, axis=1).view(np.uint64)
    values = np.concatenate([base, base, base ^ flips, base ^ np.uint64(1)])
    found = [set(zip(*map(np.ndarray.tolist, pair))) for pair in (
        simhash.near(values, simhash.bit_planes(values), len(values), radius), simhash.near_wide(values, values, radius))]
    assert found[0] == found[1] and len(found[0]) > len(values)


def test_sets_are_linked_within_and_across_tiles():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(12):
        base = rng.integers(1, 1 << 62, 100).astype(np.uint64)
        sets += [np.unique(np.r_[base[: 100 - k], rng.integers(1, 1 << 62, k).astype(np.uint64)]) for k in (0, 5, 9, 12, 30, 50)]
    wanted = np.array([[len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) for y in sets] for x in sets])
    values = np.zeros((len(sets), 4), np.uint64)  # every pair is a candidate
    items, roots = simhash.link_sets(sets, values, None, 3, 0.8)
    labels = np.arange(len(sets))
    labels[items] = roots
    assert labels.tolist() == components(wanted).tolist()
    first = np.arange(len(sets)) % 2 == 0
    items, roots = simhash.link_sets(sets, values, first, 3, 0.8)
    labels = np.arange(len(sets))
    labels[items] = roots
    assert labels.tolist() == components(wanted & (first[:, None] != first[None]) | np.eye(len(sets), dtype=bool)).tolist()


def test_op1_is_right_on_held_out_rows(spark, docs):
    rows = queries.op1_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) for r in rows) and len(rows) == docs.count()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd, empty):
    model = lang_id.fit(odd, F.lit(True))
    found = {r.doc_id: r for r in lang_id.predict(odd, model).collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0.0 for k in (900_001, 900_002, 900_003, 900_004))
    assert lang_id.predict(odd, model).columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    nothing = lang_id.fit(empty, F.lit(True))
    assert nothing.languages == [] and lang_id.predict(empty, nothing).count() == 0
    assert {r.lang_pred for r in lang_id.predict(odd, nothing).collect()} == {"und"}


def test_document_frequencies_cover_all_rows(docs):
    counts, n = lang_id.document_frequencies(docs, "text", lang_id.CHARACTERS)
    expected = np.zeros_like(counts)
    for r in docs.select("text").collect():
        _, feature, _ = lang_id.CHARACTERS.counts([r.text])
        expected[feature] += 1
    assert n == docs.count() and np.array_equal(counts, expected)


def brute_ctw(training, depth):
    nodes = defaultdict(lambda: [0, 0])
    for text in training:
        raw = bytes([ctw.MARK]) * depth + text + bytes([ctw.MARK])
        for i in range(depth, len(raw)):
            for d in range(depth + 1):
                decision = 1
                for bit in range(7, -1, -1):
                    value = raw[i] >> bit & 1
                    nodes[raw[i - d : i], decision][value] += 1
                    decision = 2 * decision + value
    below, logs = defaultdict(float), {}
    for context, decision in sorted(nodes, key=lambda n: -len(n[0])):
        alone = float(ctw.log_kt(*map(np.float64, nodes[context, decision])))
        own = alone if len(context) == depth else np.logaddexp(math.log(0.5) + alone, math.log(0.5) + below[context, decision])
        logs[context, decision] = alone, own
        if context:
            below[context[1:], decision] += own
    return nodes, logs


def brute_score(text, model, depth):
    nodes, logs = model
    raw, total = bytes([ctw.MARK]) * depth + text + bytes([ctw.MARK]), 0.0
    for i in range(depth, len(raw)):
        decision = 1
        for bit in range(7, -1, -1):
            value, chance = raw[i] >> bit & 1, 0.5
            for d in range(depth, -1, -1):
                node = raw[i - d : i], decision
                zeros, ones = nodes[node] if node in nodes else (0, 0)
                own = ((ones if value else zeros) + 0.5) / (zeros + ones + 1)
                alone, mixed = logs.get(node, (0.0, 0.0))
                share = math.exp(math.log(0.5) + alone - mixed) if d < depth else 1.0
                chance = share * own + (1 - share) * chance
            total += math.log10(chance)
            decision = 2 * decision + value
    return total


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 3, 100, 1e6])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-11)


@pytest.mark.parametrize("settings", [{}, {"split_rows": 200}, {"split_rows": 1, "LOT_BLOCKS": 2, "TASK_GRAMS": 5000, "PENDING_GRAMS": 100}])
def test_op3_scores(spark, docs, odd, settings, monkeypatch):
    for name in ("LOT_BLOCKS", "TASK_GRAMS", "PENDING_GRAMS"):
        monkeypatch.setattr(ctw, name, settings.get(name, getattr(ctw, name)))
    some = docs.where("n_chars < 700").limit(60).unionByName(odd.where("doc_id >= 900001 and doc_id <> 900005").select(docs.columns))
    rows = ctw.score(some, queries.id_remainder("doc_id", 10) == 0, block_bytes=4000, split_rows=settings.get("split_rows", 500_000)).collect()
    given = [(r.doc_id, (r.text or "").encode()) for r in some.collect()]
    training = [t for k, t in given if crc(k, 10)]
    counts = Counter(w for t in training for w in [*t.lower().split(), b" "])
    total, distinct = sum(counts.values()), len(counts)
    model = brute_ctw(training, ctw.DEPTH)
    assert len(rows) == len(given)
    text_of = dict(given)
    for r in rows:
        words = [*text_of[r.doc_id].lower().split(), b" "]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert r.held_out == (crc(r.doc_id, 10) == 0) and r.train_tokens == total
        assert r.n_tokens == len(words) and r.n_known == sum(w in counts for w in words)
        assert math.isclose(r.base_score, base, abs_tol=1e-9)
        assert math.isclose(r.score, brute_score(text_of[r.doc_id], model, ctw.DEPTH), rel_tol=1e-9, abs_tol=1e-7)


def test_a_dominating_context_is_split_and_changes_no_score(spark):
    """Most of the text ends in one pair of bytes; its unit is cut by the third."""
    rows = [(i, "the the the the then " * 20 + f"x{i}the the" * (i % 3)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held_out = F.col("doc_id") % 5 == 0
    whole = {r.doc_id: r.score for r in ctw.score(docs, held_out, block_bytes=3000, split_rows=1 << 40).collect()}
    split = {r.doc_id: r.score for r in ctw.score(docs, held_out, block_bytes=3000, split_rows=20).collect()}
    assert whole.keys() == split.keys() and all(math.isclose(whole[i], split[i], rel_tol=1e-11) for i in whole)


def test_squeezed_numbers_open_again():
    rng = np.random.default_rng(1)
    for kind in ("<u4", "<u8", "<f8"):
        values = rng.integers(0, 1 << 31, 1000).astype(kind)
        assert np.array_equal(ctw.opened(ctw.squeezed(values), kind), values)
        assert len(ctw.opened(ctw.squeezed(values[:0]), kind)) == 0
    keys = np.unique(rng.integers(0, 1 << 32, 500).astype(np.uint64)) + (np.uint64(77) << np.uint64(ctw.PAIR_SHIFT))
    assert np.array_equal(ctw.unpacked_keys(77, ctw.packed_keys(keys)), keys)


def test_scores_without_rows_and_without_training(spark, empty, docs):
    assert ctw.score(empty, F.lit(False)).count() == 0
    (row,) = ctw.score(docs.limit(1), F.lit(True)).collect()
    assert row.train_tokens == 0 and row.n_known == 0 and math.isclose(row.base_score, 0.0, abs_tol=1e-12)
    assert math.isclose(row.bits_per_byte, 8.0, rel_tol=1e-9)


def test_op4_finds_the_labelled_quality(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("truth"))
    rows = queries.op4_quality(spark, SF).join(labels, "doc_id").collect()
    assert np.mean([r.keep == (r.truth == 1) for r in rows]) > 0.93
    assert queries.op4_quality(spark, SF).count() == docs.count()


def test_an_id_on_a_third_of_the_rows_counts_once_in_a_sample(spark, docs):
    known = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    hot = known.limit(1).withColumn("doc_id", F.lit(5_000_000).cast("long")).withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("_")
    both = known.unionByName(hot)
    rows = lang_id.sampled(both, "lang", "doc_id", 1500).collect()
    assert len(rows) == len({r.doc_id for r in rows}) <= known.count() + 1
    model = quality.fit(both)
    assert np.allclose(model.weights, quality.fit(both).weights) and 0 < model.weak.prior < 1


def test_labels_without_a_document_take_no_place_in_the_sample(spark):
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choices(["river", "house", "green"], k=30)) + (" idiot moron" if k % 4 == 0 else "")) for k in range(400)]
    docs = spark.createDataFrame([*rows, *[(0, rows[0][1])] * 200], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k, _ in rows] + [(k, k % 2) for k in range(10_000, 60_000)], "doc_id long, toxic int")
    found = {r.doc_id: r.toxic for r in toxicity.grade(docs, toxicity.fit(docs, labels, per_label=200, least_strength=2.0)).collect()}
    assert sum(found[k] == (k % 4 == 0) for k, _ in rows) > 390


def test_ordinal_gradient_is_that_of_finite_differences():
    """One step of training moves the parameters against the slope that finite differences give."""
    rng = np.random.default_rng(8)
    rows = [np.unique(rng.integers(0, 6, rng.integers(0, 5))) for _ in range(60)]
    grades = rng.integers(0, 3, 60)

    def loss(weights, thresholds):
        total = np.array([weights[r].sum() for r in rows])
        upto = np.concatenate([np.ones((60, 1)), 1 / (1 + np.exp(-(total[:, None] - thresholds))), np.zeros((60, 1))], axis=1)
        return -np.log(upto[np.arange(60), grades] - upto[np.arange(60), grades + 1]).mean()

    weights, thresholds = toxicity.train_ordinal(rows, grades, 6, 3, ridge=0.0, steps=3000, rate=0.05)
    least = loss(weights, thresholds)
    for i in range(6):
        for step in (1e-3, -1e-3):
            moved = weights.copy()
            moved[i] += step
            assert moved[i] < 0 or loss(moved, thresholds) > least - 1e-6
    for i in range(2):
        for step in (1e-3, -1e-3):
            moved = thresholds.copy()
            moved[i] += step
            assert loss(weights, moved) > least - 1e-6
    assert thresholds[0] < thresholds[1]


def test_ftrl_against_a_loop_over_coordinates():
    from cascata.llm.features import softmax, train_ftrl

    rng = np.random.default_rng(4)
    rows = [(f := np.unique(rng.integers(0, 12, 5)), rng.random(len(f)) + 0.1) for _ in range(40)]
    targets = np.eye(3)[rng.integers(0, 3, 40)]
    made = train_ftrl(rows, targets, 12, rate=0.5, smooth=1.0, lasso=0.05, ridge=0.02, passes=2)
    z, n = [[0.0] * 3 for _ in range(12)], [[0.0] * 3 for _ in range(12)]

    def weight(i, c):
        if abs(z[i][c]) <= 0.05:
            return 0.0
        return (math.copysign(0.05, z[i][c]) - z[i][c]) / ((1.0 + math.sqrt(n[i][c])) / 0.5 + 0.02)

    order = np.random.default_rng(3)
    for _ in range(2):
        for k in order.permutation(40):
            features, values = rows[k]
            held = [[weight(i, c) for c in range(3)] for i in features]
            chance = softmax(np.array([sum(v * w[c] for v, w in zip(values, held)) for c in range(3)]))
            for j, (i, v) in enumerate(zip(features, values)):
                for c in range(3):
                    g = v * (chance[c] - targets[k][c])
                    z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / 0.5 * held[j][c]
                    n[i][c] += g * g
    assert np.allclose(made, [[weight(i, c) for c in range(3)] for i in range(12)], atol=1e-12)


def test_weak_labels_recover_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    accuracies, votes = [0.95, 0.9, 0.85, 0.8, 0.99], []
    for accuracy in accuracies:
        right = rng.random(len(truth)) < accuracy
        votes.append(np.where(rng.random(len(truth)) < 0.3, quality.ABSTAIN, np.where(truth == right, quality.GOOD, quality.BAD)))
    pattern, counts = np.unique(quality.patterns(np.stack(votes, 1)), return_counts=True)
    model = quality.estimate(quality.votes_of(pattern, 5), counts)
    assert np.allclose(model.accuracy(), accuracies, atol=0.03) and abs(model.prior - 0.8) < 0.03


def test_quality_of_odd_rows(odd, empty):
    model = quality.fit(odd)
    found = quality.score(odd, model)
    assert found.count() == odd.count() and found.columns == [c for c in odd.columns if c != "keep"] + ["posterior", "quality", "keep"]
    assert not any(r.keep for r in found.where("doc_id in (900001, 900002, 900003)").collect())
    assert quality.score(empty, quality.fit(empty)).count() == 0


def test_op6_leaves_clean_rows_alone(spark):
    bad = ["idiot", "moron", "scum", "loser"]
    rng = random.Random(2)
    plain = ["the", "house", "river", "walks", "under", "green", "trees", "slowly", "morning"]
    rows, labels = [], []
    for k in range(600):
        text = rng.choices(plain, k=60)
        for _ in range(k % 4 if k % 3 == 0 else 0):
            text[rng.randrange(60)] = rng.choice(bad)
        toxic = int(any(w in bad for w in text))
        rows.append((k, " ".join(text)))
        if k < 400:
            labels.append((k, toxic))
    table, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(table, known)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1] and (model.weights >= 0).all()
    found = {r.doc_id: r for r in toxicity.grade(table, model).collect()}
    for key, text in rows:
        assert found[key].toxic == any(w in bad for w in text.split())
    assert all(0 <= r.severity <= 2 for r in found.values())


def test_ordinal_gradient_follows_the_loss():
    rng = np.random.default_rng(4)
    rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(400)]
    total = np.array([np.array([2.0, 0, 1, 0, 3, 0])[r].sum() for r in rows])
    grades = np.searchsorted([1.5, 3.5], total + rng.logistic(size=400) * 0.3)
    weights, thresholds = toxicity.train_ordinal(rows, grades, 6, 3)
    assert weights[[0, 2, 4]].min() > 5 * weights[[1, 3, 5]].max() and thresholds[0] < thresholds[1]


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(900_006, 1), (900_006, 0), (None, 1), (900_007, None), (1, 0), (2, 0)], "doc_id long, toxic int")
    found = toxicity.grade(odd, toxicity.fit(odd, labels))
    assert found.count() == odd.count() and found.where("doc_id in (900001, 900002) and severity <> 0").count() == 0
    nothing = toxicity.fit(empty, labels)
    assert toxicity.grade(odd, nothing).where("toxic or severity <> 0").count() == 0


def test_op8_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    made = Counter(map(tuple, queries.op8_url_filter(spark, SF).collect()))
    assert made == Counter(con.execute(queries.OP8_SQL).fetchall())


def test_url_rules_and_list(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.A.NET", "x://a.net/", "x://b.a.net/p?q", "x://anet/", "x://example.net/en/1", "x://s.example.net/en/1#f",
            "x://example.com/de/", "x://example.com/d", "x://fr.org/fr/a", "x://org/fr/", "x://m.list.com/a.html?x", "x://list.com/a/", "x://list.com/b", "x://://y"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("list.com/a",), ("list.com/a",), (None,)], "canonical_url string")
    found = {r.page_id: r for r in url_filter.judge(pages, listed, queries.URL_RULES).collect()}
    assert [found[k].rule for k in range(len(urls))] == [
        None, None, None, None, "net/", "net/", None, "example.net/en/", "example.net/en/", "example.com/de/", None, "org/fr/", "org/fr/", None, None, None, None]
    assert [found[k].verdict for k in (4, 7, 9, 11, 13, 14, 15, 0)] == ["block", "allow", "block", "allow", "block", "block", "allow", "allow"]
    assert (found[3].host, found[3].path, found[0].host, found[16].host) == ("www.a.net", "", "", ":")
    for blocks in (1, 2):  # a crowded filter changes nothing
        again = url_filter.judge(pages, listed, queries.URL_RULES, most_blocks=blocks)
        assert {r.page_id: r.verdict for r in again.collect()} == {k: r.verdict for k, r in found.items()}
    assert url_filter.judge(pages.limit(0), listed.limit(0), []).count() == 0


def test_url_filter_lets_all_listed_pass(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h.com/"), F.col("id")).alias("canonical_url"))
    pages = listed.select(F.concat(F.lit("x://www."), "canonical_url").alias("url"))
    assert url_filter.judge(pages, listed, []).where("verdict = 'block'").count() == 3000


def test_url_filter_runs_no_python(spark):
    plan = queries.op8_url_filter(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pipeline_stages(spark, docs, texts, library):
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.materialize(stage(spark, kept, SF), "estagio")
        assert kept.columns == docs.columns and kept.join(before, "doc_id", "left_anti").count() == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert kept.join(labels.where("quality = 0"), "doc_id", "left_semi").count() < docs.join(labels.where("quality = 0"), "doc_id", "left_semi").count()
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id: library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in kept.select("doc_id").collect()}
    packed_well(rows, ids, 2048)
    assert {r.doc_id for r in rows} == set(ids)


def test_pipeline_keeps_clean_and_drops_planted(spark, docs):
    clean = [r.text for r in docs.join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0"), "doc_id").where(
        "n_chars > 400").orderBy("doc_id").limit(20).collect()]
    rows = [(5000 + k, t, "en", "s", len(t)) for k, t in enumerate(dict.fromkeys(clean))]
    rows += [(6000, rows[0][1], "en", "s", 1), (6001, None, None, None, None), (6002, "123 456", None, None, None), (6003, "AAA!! BBB!! " * 40, "en", None, None)]
    table = docs.unionByName(spark.createDataFrame(rows, docs.schema)).cache()
    kept = {r.doc_id for r in corpus_pipeline.good_text(spark, corpus_pipeline.language(spark, table, SF), SF).collect()}
    assert not kept & {6001, 6002, 6003} and len({r[0] for r in rows[:-4]} - kept) <= 1


def test_wide_fingerprints_are_compared_over_planes(monkeypatch):
    """From a word of values on, near copies go by bit planes and carry-save counters, as narrow fingerprints do."""
    rng = np.random.default_rng(11)
    values = rng.integers(0, 1 << 63, (simhash.PLANE_VALUES, 4)).astype(np.uint64)
    values = np.concatenate([values, values ^ np.uint64(1)])
    used, near = [], simhash.near
    monkeypatch.setattr(simhash, "near", lambda *args: used.append(len(args[1])) or near(*args))
    items, roots = simhash.link_tile(values, None, 65)
    assert used and set(used) == {256}
    assert items.tolist() == list(range(simhash.PLANE_VALUES, len(values))) and roots.tolist() == list(range(simhash.PLANE_VALUES))
    used.clear()
    sets = [np.sort(rng.integers(1, 1 << 62, 3).astype(np.uint64)) for _ in range(simhash.PLANE_VALUES)]
    items, roots = simhash.link_sets(sets + sets, values, None, 65, 0.8)
    assert used and items.tolist() == list(range(simhash.PLANE_VALUES, len(values)))


class CountingLibrary:
    """The tokenizers library, noting how many pieces it is given at once."""

    def __init__(self, library):
        self.library, self.sizes = library, []

    def encode_batch_fast(self, pieces, **options):
        self.sizes.append(len(pieces))
        return self.library.encode_batch_fast(pieces, **options)


def test_packing_hands_the_library_bounded_numbers_of_pieces(library):
    """What it returns takes about a KB a piece, and a block of texts may have any number of new ones."""
    pieces = [f" w{k}".encode() for k in range(3 * packing.PIECES_AT_ONCE + 5)]
    counted = CountingLibrary(library)
    ids, counts = packing.library_merge(counted)(pieces)
    whole = [e.ids for e in library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
    assert max(counted.sizes) <= packing.PIECES_AT_ONCE and sum(counted.sizes) == len(pieces)
    assert ids.tolist() == [i for x in whole for i in x] and counts.tolist() == [len(x) for x in whole]
    assert packing.library_merge(counted)([])[0].size == 0


def test_texts_of_a_block_are_read_part_by_part(monkeypatch):
    """A whole block as Python texts beside the block itself doubles what a worker holds."""
    read = []
    whole = features.byte_texts
    monkeypatch.setattr(features, "byte_texts", lambda column: read.append(len(column)) or whole(column))
    monkeypatch.setattr(features, "PART_CHARS", 10)
    block = pa.RecordBatch.from_pydict({"text": pa.array(["aaaa", None, "ção", "", "b" * 30, "cc"], pa.string())}).slice(1)
    parts = list(features.text_parts(block, 0))
    assert [t for _, _, texts in parts for t in texts] == ["", "ção", "", "b" * 30, "cc"] and max(read) < 5
    assert [(a, b) for a, b, _ in parts] == [(0, 3), (3, 4), (4, 5)]
