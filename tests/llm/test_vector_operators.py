"""Vector operators against brute force, on small tables."""

import contextlib
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascata.llm import ann, cap_filters, queries
from cascata.llm.arrays import HashIndex, ragged, slices
from cascata.llm.components import Forest, connected
from cascata.llm.hot_groups import in_tiles

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters of near copies, exact copies, another length, and rows that take no part."""
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(30):
        center = rng.normal(size=16)
        for _ in range(6):
            rows.append(center + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.35]))
    rows += [rows[0], rows[0], 2 * rows[1]] + list(rng.normal(size=(150, 16)))
    rows = [[float(x) for x in np.float32(r)] for r in rows]
    rows += [[float(x) for x in np.float32(rng.normal(size=3))] for _ in range(20)]
    rows += [None, [], [0.0] * 16, [NAN] + [1.0] * 15, [INF] + [1.0] * 15, [None] + [1.0] * 15, [1.0], [-2.0], [3.0]]
    return spark.createDataFrame([(k, r, "x") for k, r in enumerate(rows)], "vec_id long, embedding array<float>, id string").cache()


def usable(row):
    v = row.embedding
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_op9_against_all_pairs(vectors):
    rows = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect() if usable(r)}
    links = {k: {j for j, w in rows.items() if j != k and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9}
             for k, v in rows.items()}
    found = {r.vec_id: r for r in cap_filters.near_duplicates(vectors, recall=0.9999).collect()}
    assert len(found) == vectors.count()
    for r in found.values():
        assert r.kept == (r.vec_id == r.component_id)
        if r.vec_id not in rows:
            assert (r.n_links, r.component_id) == (0, r.vec_id)
    assert {k: found[k].n_links for k in rows} == {k: len(v) for k, v in links.items()}
    for key in rows:
        reached, todo = {key}, [key]
        while todo:
            for other in links[todo.pop()] - reached:
                reached.add(other)
                todo.append(other)
        assert found[key].component_id == min(reached)


def test_dense_groups_and_tiles_count_each_link_once(spark):
    rng = np.random.default_rng(3)
    center = rng.normal(size=24)
    rows = [(k, [float(x) for x in center + 0.1 * rng.normal(size=24)]) for k in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = cap_filters.near_duplicates(table, tile_rows=70, directions=64).collect()
    units = np.array([v for _, v in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= 0.9
    assert {r.vec_id: r.n_links for r in found} == dict(enumerate((near.sum(axis=1) - 1).tolist()))


def test_filters_are_compared_in_rounds_that_free_their_shuffle(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "ROUND_ROWS", 1, raising=False)
    rng = np.random.default_rng(14)
    units = np.concatenate([rng.normal(size=(2400, 64)), rng.normal(size=64) + 0.2 * rng.normal(size=(200, 64))])
    units = np.concatenate([units, units[:400] + 0.3 * rng.normal(size=(400, 64))])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(units)], "vec_id long, embedding array<double>").cache()
    table.count()
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def held():
        sizes = {}
        for folder in folders:
            for at, _, names in os.walk(folder):
                for name in names:
                    if name.startswith("shuffle_") and os.path.exists(path := os.path.join(at, name)):
                        with contextlib.suppress(FileNotFoundError):
                            sizes[name] = os.path.getsize(path)
        return sizes

    former, most, over = set(held()), [0], threading.Event()

    def watch():
        while not over.wait(0.1):
            most.append(sum(size for name, size in held().items() if name not in former))

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        found = cap_filters.near_duplicates(table, tile_rows=70)
    finally:
        over.set()
        watching.join()
    assert max(most) < 4 * units.nbytes
    near = units @ units.T >= 0.9
    wrong = sum(r.n_links != near[r.vec_id].sum() - 1 for r in found.collect())
    assert near.sum() > 20_000 and wrong <= 4


def test_rounds_hold_each_tile_once_and_bounded_rows(monkeypatch):
    monkeypatch.setattr(cap_filters, "ROUND_ROWS", 500)
    rng = np.random.default_rng(9)
    counts = rng.integers(0, 60, 5000)
    counts[[7, 1200]] = 900, 350
    rounds = cap_filters.rounds_of(counts, [0, 1000], 100, 100, 8)
    assert len(rounds) > 50 and all(r.rows <= 500 + 4096 for r in rounds)
    assert [r.first for r in rounds[1:]] == [r.last for r in rounds[:-1]]
    tiles = {}
    for r in rounds:
        for k, (start, stop, parts) in enumerate(zip(r.starts, r.stops, r.parts)):
            assert not start < 1000 < stop and (parts == 1 or stop == start + 1)
            every = [int(r.tile(np.array(k), np.array(low), np.array(high))) for low in range(parts) for high in range(low, parts)]
            assert len(set(every)) == len(every)
            for tile in every:
                if r.first <= tile < r.last:
                    assert tile not in tiles
                    tiles[tile] = (start, stop)
    assert sorted(tiles) == list(range(len(tiles)))
    covered = {f for start, stop in tiles.values() for f in range(start, stop)}
    assert covered >= set(np.flatnonzero(counts > 1).tolist())


def test_shared_filters_by_product_and_by_list_agree():
    rng = np.random.default_rng(2)
    lists = [np.sort(rng.choice(40, rng.integers(1, 8), replace=False)) for _ in range(60)]
    lengths = np.array([len(x) for x in lists])
    group = cap_filters._Group(np.eye(60), np.ones(60, int), np.concatenate(lists), np.cumsum(lengths) - lengths, lengths, 0.9)
    for filter_ in range(40):
        rows = np.array([k for k in range(60) if filter_ in lists[k]])
        if len(rows) > 1:
            i, j = np.triu_indices(len(rows), 1)
            first = cap_filters._first_common((rows[i], rows[j]), group.filters, group.starts, lengths)
            assert np.array_equal(first < filter_, group._meet_before(rows, rows, filter_)[i, j])


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(6)
    code = cap_filters.CapFilters(32, 128)
    code.height = code.height_for(0.9, 0.97)
    one, other = rng.normal(size=(2, 400, 32))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other = 0.9 * one + np.sqrt(0.19) * other / np.linalg.norm(other, axis=1, keepdims=True)
    (a, f), (b, g) = code.decode(one), code.decode(other)
    assert len(set(a[np.isin(a * 2**20 + f, b * 2**20 + g)])) > 0.93 * 400


def test_op9_finds_pairs_at_the_threshold_as_registered(spark):
    rng = np.random.default_rng(12)
    one, other = rng.normal(size=(2, 1500, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other = 0.902 * one + np.sqrt(1 - 0.902**2) * other / np.linalg.norm(other, axis=1, keepdims=True)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([one, other]))]
    found = cap_filters.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(r.n_links for r in found) >= 0.99 * len(rows)


def test_op9_on_the_given_table(spark):
    rows = queries.op9_embedding_neardup(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/embeddings.parquet").count()


def test_op7_finds_the_nearest(spark, vectors):
    rows = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect() if usable(r)}
    found = {}
    for r in ann.nearest(vectors, F.col("id") % 20 == 0, 20, block_rows=60, block_queries=5, certainty=3.0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    asked = [k for k in rows if k % 20 == 0]
    assert set(found) == {k for k in asked if any(len(v) == len(rows[k]) for j, v in rows.items() if j != k)}
    hits = wanted = 0
    for key, given in found.items():
        best = sorted((-(rows[key] * v).sum(), j) for j, v in rows.items() if j != key and len(v) == len(rows[key]))[:20]
        assert [rank for rank, _, _ in sorted(given)] == list(range(1, len(best) + 1))
        assert all(np.isclose(score, rows[key] @ rows[j]) for _, j, score in given)
        assert sorted(given) == [(k + 1, j, s) for k, (j, s) in enumerate(sorted(((j, s) for _, j, s in given), key=lambda x: (-x[1], x[0])))]
        hits += len({j for _, j, _ in given} & {j for _, j in best})
        wanted += len(best)
    assert hits > 0.98 * wanted


def test_op7_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, matrix = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    found = {}
    for r in queries.op7_ann(spark, SF).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for k in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[k]
        scores[k] = -np.inf
        hits += len(found[ids[k]] & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(found)


def test_bounds_hold_and_estimates_are_close():
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(500, 128))
    codes = ann.Codes(*ann.encode(vectors), 128, 3.0)
    query = rng.normal(size=128)
    (estimate,), (above,) = codes.estimates(query[None])
    assert (np.abs(estimate - vectors @ query) <= above).mean() > 0.98
    # the products with rounded queries are those of the unpacked signs, and the rounding is small beside the rest
    turned = query @ ann.rotation(128)
    signs = np.where((vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ ann.rotation(128) > 0, 1.0, -1.0)
    assert np.abs(estimate - (signs @ turned) * codes.scale).max() <= (above - np.linalg.norm(query) * codes.slack).max()
    assert (above < 1.25 * np.linalg.norm(query) * codes.slack).all()


def test_a_query_on_several_rows_has_the_neighbours_of_one(spark):
    rng = np.random.default_rng(5)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(120, 16)))]
    once = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 60 == 0, 10, block_rows=40)
    again = rows + [rows[0], rows[60], rows[60], rows[60]]
    twice = ann.nearest(spark.createDataFrame(again, "vec_id long, embedding array<double>"), F.col("id") % 60 == 0, 10, block_rows=40)
    ranked = {(r.query_id, r["rank"]): r.vec_id for r in once.collect()}
    seen = [(r.query_id, r["rank"]) for r in twice.collect()]
    assert len(seen) == len(set(seen)) == 20
    # an id with two vectors asks twice, and each is ranked on its own
    other = rng.normal(size=16).tolist()
    both = ann.nearest(spark.createDataFrame([*rows, (60, other)], "vec_id long, embedding array<double>"), F.col("id") == 60, 10, certainty=4.0).collect()
    assert sorted(r["rank"] for r in both) == sorted([*range(1, 11)] * 2)
    assert {r.vec_id for r in both} >= {v for (q, _), v in ranked.items() if q == 60}


def test_vectors_with_names_that_clash(spark):
    rng = np.random.default_rng(6)
    names = "vec_id long, embedding array<double>, id string, size string, vector string, words string, norm string, scalar string, query_id string, score string, component_id string, kept string, asked string"
    rows = [(k, v.tolist(), *["x"] * 11) for k, v in enumerate(rng.normal(size=(40, 8)))]
    table = spark.createDataFrame(rows, names)
    assert ann.nearest(table, F.col("id") % 20 == 0, 5).count() == 10
    assert cap_filters.near_duplicates(table).count() == 40


def test_empty_tables(vectors):
    none = vectors.limit(0)
    assert cap_filters.near_duplicates(none).count() == 0
    assert ann.nearest(none, F.col("id") % 20 == 0).count() == 0


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 130)] + [(200, 200), (300, 299), (None, 3)]
    found = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 130)} | {299: 299, 300: 299}


def test_forest_links_in_any_order():
    rng = np.random.default_rng(1)
    forest, label = Forest(200), np.arange(200)
    for _ in range(10):
        i, j = rng.integers(0, 200, (2, 15))
        forest.link(i, j)
        for a, b in zip(i, j):
            low, high = sorted((label[a], label[b]))
            label[label == high] = low
    assert np.array_equal(forest.roots, label)


def test_tiles_bring_every_pair_together_once(spark):
    rows = spark.range(500).select(F.col("id").alias("node"), F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 50).alias("key"))
    pairs = []
    for tile in in_tiles(rows, ["key"], "node", 64).groupBy("key", "_lo", "_hi").agg(
            F.collect_list(F.struct("node", "_first")).alias("m")).collect():
        assert len(tile.m) < 200
        for x in tile.m:
            for y in tile.m:
                if x.node < y.node and (tile["_lo"] == tile["_hi"] or x._first != y._first):
                    pairs.append((x.node, y.node))
    sizes = [304] + [4] * 49
    assert len(pairs) == len(set(pairs)) == sum(n * (n - 1) // 2 for n in sizes)


def test_hash_index_and_ragged():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 62, 5000).astype(np.uint64))
    index = HashIndex(4)
    index.add(keys[:100])
    index.add(keys[100:])
    assert np.array_equal(index.find(keys), np.arange(len(keys)))
    assert (index.find(keys + np.uint64(1)) == -1).mean() > 0.99
    assert ragged(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert list(slices([1, 1, 9, 1], 3)) == [(0, 2), (2, 3), (3, 4)]
