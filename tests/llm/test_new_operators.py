"""Lexical search, filter audit and exact duplicates against brute force, with their edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascata.llm import filter_audit, hybrid_search, perfect_dedup, queries

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, source string, score long, rank string, digest string, mask int, chars string, block string, kept string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, hot texts, and extra columns whose names clash with those of results."""
    texts = [None, "", " \t\n", "A B", "AB", "A\x0bB ", "hot text here", "Ünï cödé 東京 x", "a b c d", "x # y", "word " * 60, "ABC def", "\x00zero\x7f"]
    rows = [(i, texts[i % len(texts)], ["s", None, "", "t"][i % 4]) for i in range(80)]
    rows += [(1000 + i, "hot text here", "s") for i in range(60)] + [(None, "A B", "s"), (None, "only nobody", None), (7, "hot text here", "t")]
    rows += [(2000, "long " * 300_000 + "end", "t"), (2001, "".join(f"w{i} " for i in range(50_000)), "t")]
    return spark.createDataFrame([(*r, 1, "r", "d", 3, "c", "b", "k") for r in rows], ODD).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD)


# ------------------------------------------------------------- exact duplicates


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_every_known_digest_has_a_slot_of_its_own():
    words = np.random.default_rng(5).integers(0, 1 << 62, (30_000, 2)).astype(np.uint64)
    known = perfect_dedup.PerfectHash.over(words)
    assert sorted(known.slots(words).tolist()) == list(range(30_000))
    assert len(known.bits) < 4 * 30_000
    others = known.slots(words + np.uint64(1))
    assert others.min() >= -1 and others.max() < 30_000
    nothing = perfect_dedup.PerfectHash.over(words[:0])
    assert nothing.slots(words[:5]).tolist() == [-1] * 5


@pytest.mark.parametrize("old", ["doc_id % 2 = 0", "false", "true", "doc_id is null", "doc_id >= 1000"])
def test_exact_duplicates_do_not_depend_on_what_was_loaded_before(spark, odd, old, monkeypatch):
    monkeypatch.setattr(perfect_dedup, "SHARD_DIGESTS", 8)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[plain(t)].append((-len(t or ""), i is None, i or 0))
    made = perfect_dedup.deduplicate(odd, F.expr(old)).collect()
    assert len(made) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    kept = Counter()
    for r in made:
        group = by_sha[r["text_sha256"]]
        least = min(group)
        assert r["group_size"] == len(group) and r["keep_id"] == (None if least[1] else least[2])
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept) == set(by_sha) and set(kept.values()) == {1}


def test_groups_of_one_load_are_the_history_of_the_next(spark, odd):
    first, second = odd.where("doc_id < 1000"), odd.where("doc_id >= 1000 or doc_id is null")
    rows = perfect_dedup.digest_rows(first)
    groups = perfect_dedup.grouped(rows)
    more = perfect_dedup.digest_rows(second, first_row=rows.agg(F.max("row")).first()[0] + 1)
    merged = {bytes(r["digest"]): (r["doc_id"], r["size"]) for r in perfect_dedup.merge(groups, more).collect()}
    whole = {bytes(r["digest"]): (r["doc_id"], r["size"]) for r in perfect_dedup.grouped(perfect_dedup.digest_rows(odd)).collect()}
    assert merged == whole


def test_a_digest_that_shares_a_slot_but_not_all_bytes_is_no_member(spark):
    a, b = b"\x00" * 8 + b"\x01" * 16 + b"\x02" * 8, b"\x00" * 8 + b"\x01" * 16 + b"\x03" * 8
    known = spark.createDataFrame([(bytearray(a), 1, 5, 0, 1)], perfect_dedup.GROUP)
    arriving = spark.createDataFrame([(bytearray(b), 2, 5, 1, 1), (bytearray(a), 3, 9, 2, 1)], perfect_dedup.GROUP)
    found = perfect_dedup.look_up(perfect_dedup.build_index(known, 1), arriving, 1).collect()
    assert {(bytes(r["digest"]), r["doc_id"], r["size"], r["known"]) for r in found} == {(a, 3, 2, True), (b, 2, 1, False)}


def test_exact_duplicates_of_nothing(empty):
    assert perfect_dedup.deduplicate(empty, F.lit(True)).count() == 0


# ----------------------------------------------------------------- filter audit


def failing(text, first, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)), doc_id is not None and first is not None and first < doc_id]


def brute_audit(rows, labels):
    firsts = {}
    for i, t, _ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    parts = defaultdict(list)
    for i, t, s in rows:
        parts[s or ""].append((failing(t or "", firsts.get(t or ""), i), *labels.get(i, (False, False))))
    made = set()
    for part, docs in parts.items():
        shapley, steps = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                f = "ABCDE".index(name)
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[name] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(d[0][f] for d in docs) - len(gone),
                              sum(d[0][f] and sum(d[0]) == 1 for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone), name))
        made |= {(*s[:-1], shapley[s[-1]]) for s in steps}
    return made


def test_audit_of_odd_documents(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, (i % 3 == 0) * 1) for i in range(0, 90)] + [(3, 1, None), (None, 1, 1), (1000, None, 1), (99999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    known = {}
    for r in labels.collect():
        if r["doc_id"] is not None:
            good, toxic = known.get(r["doc_id"], (False, False))
            known[r["doc_id"]] = (good or r["quality"] == 1, toxic or r["toxic"] == 1)
    rows = [tuple(r) for r in odd.select("doc_id", "text", "source").collect()]
    made = filter_audit.audit(filter_audit.masked(odd, labels)).collect()
    assert len(made) == 3 * 600 and {tuple(r) for r in made} == brute_audit(rows, known)


def test_swaps_visit_every_order_once():
    for n in range(1, 6):
        order = list(range(n))
        seen = [tuple(order)]
        for level in filter_audit.adjacent_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == math.factorial(n)


def test_a_diagram_shares_equal_nodes_and_keeps_its_function_under_swaps():
    random.seed(3)
    counts = {m: (random.randrange(3), 0, 0) for m in range(32)}
    diagram = filter_audit.Diagram.of(counts, 5)
    assert all(len(set(level)) == len(level) for level in diagram.levels) and len(diagram.levels[0]) == 1

    def value(mask):
        at = 0
        for level, f in enumerate(diagram.order):
            at = diagram.levels[level][at][mask >> f & 1]
        return diagram.leaves[at]

    for level in filter_audit.adjacent_swaps(5):
        diagram.swap(level)
        assert all(value(m) == counts[m] for m in range(32)) and all(len(set(x)) == len(x) for x in diagram.levels)
    assert diagram.weights[0] == [tuple(map(sum, zip(*counts.values())))]


def test_audit_of_nothing(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.masked(empty, labels)).count() == 0


def test_long_texts_are_split_in_slices(monkeypatch):
    monkeypatch.setattr(filter_audit, "SLICE_BYTES", 50)
    text = " ".join(f"w{i % 40}" * (1 + i % 9) for i in range(900)).encode()
    assert filter_audit.word_counts(text) == (900, len(set(text.split())))


# --------------------------------------------------------------- lexical search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_search(docs, items, k):
    counted = [(i, Counter(TERMS.findall(lower(t)))) for i, t in docs]
    big_n, big_l = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERMS.findall(lower(t)))
    made = []
    for item, terms in asked.items():
        scores = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        made += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(made, key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "hot text HERE"), (2, "東京 x w77 w4999"), (3, "nothing that exists zzz"), (4, None), (5, "..."), (6, "long end a b c d word"), (1, "and more: def"), (None, "zero abc")]
    return spark.createDataFrame([(*r, 9) for r in rows], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("settings", [{}, {"BLOCK_BYTES": 400, "SHORT_LEAST": 2, "SHORT_SHARE": 0.01, "WINDOW_DOCS": 4, "CHUNK_QUERIES": 2, "_PENDING": 64, "_PIECE": 100}])
def test_search_of_odd_documents(spark, odd, items, settings, monkeypatch):
    for name, value in settings.items():
        monkeypatch.setattr(hybrid_search, name, value)
    docs = odd.where("doc_id is null or doc_id <> 2000") if settings else odd
    made = hybrid_search.rank(hybrid_search.build_index(docs), items, 10)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in made.collect()), key=repr) == brute_search(rows, [tuple(r)[:2] for r in items.collect()], 10)


def test_best_of_a_block_is_exact_however_lists_are_cut(monkeypatch):
    rng = np.random.default_rng(11)
    for trial in range(150):
        documents = int(rng.integers(1, 400))
        monkeypatch.setattr(hybrid_search, "WINDOW_DOCS", int(rng.choice([1, 7, 64, 2048])))
        monkeypatch.setattr(hybrid_search, "SHORT_LEAST", int(rng.choice([1, 20, 300])))
        lists, total = [], np.zeros(documents, np.int64)
        for _ in range(int(rng.integers(1, 9))):
            docs = np.flatnonzero(rng.random(documents) < rng.choice([0.02, 0.3, 0.95]))
            scores = rng.integers(0, int(rng.choice([3, 1000])), len(docs))
            total[docs] += scores
            lists.append(hybrid_search.Postings.of(docs, scores))
        k = int(rng.integers(1, 30))
        docs, scores = hybrid_search.best_of_block(lists, documents, k)
        order = np.lexsort((docs, -scores))
        wanted = [d for d in np.lexsort((np.arange(documents), -total))[:k].tolist() if total[d] > 0]
        assert docs[order].tolist() == wanted and scores[order].tolist() == total[wanted].tolist()


def test_search_of_nothing(empty, odd, items):
    assert hybrid_search.rank(hybrid_search.build_index(empty), items, 5).count() == 0
    assert hybrid_search.rank(hybrid_search.build_index(odd), items.limit(0), 5).count() == 0


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_filter_audit", "op13_exact_dedup"])
def test_new_queries_have_sql(name):
    assert name in queries.QUERIES and name in queries.ORACLE_SQL
