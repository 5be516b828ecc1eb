"""Search and recommender against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascata.operators import recommend, search
from cascata.schemas import CATEGORIES

RNG = np.random.default_rng(3)
DIM, N_CONTENTS, N_USERS = 8, 60, 12
BATCH = "2024-03-01 00:00:00"


@pytest.fixture(scope="module")
def world(spark):
    categories = [CATEGORIES[i % 3] for i in range(N_CONTENTS)]
    vectors = {i: RNG.normal(size=DIM) + np.eye(DIM)[i % 3] * 4 for i in range(N_CONTENTS - 10)}
    kinds = ["visualização", "início", "conclusão", "curtida", "avaliação"]
    acts = [(int(u), int(RNG.integers(N_CONTENTS)), kinds[int(RNG.integers(5))], int(RNG.integers(0, 30)),
             float(RNG.integers(0, 101)), [None, 2, 5][int(RNG.integers(3))]) for u in range(N_USERS) for _ in range(9)]
    contents = spark.createDataFrame([(i, f"t{i}", "Curso", c, "d") for i, c in enumerate(categories)],
                                     "conteudo_id bigint, titulo string, tipo string, categoria string, descricao string")
    store = spark.createDataFrame([(i, "base", [float(x) for x in v]) for i, v in vectors.items()],
                                  "conteudo_id bigint, modelo string, vetor array<double>")
    interactions = spark.createDataFrame(acts, "usuario_id bigint, conteudo_id bigint, tipo_interacao string, tempo_consumido bigint, "
                                               "percentual_conclusao double, avaliacao_atribuida bigint")
    return contents, store, interactions, categories, vectors, acts


def unit(v):
    return v / np.linalg.norm(v)


def brute_force(categories, vectors, acts, n):
    best, negatives, completed_total = {}, 0, 0
    for u in sorted({a[0] for a in acts}):
        mine = [a for a in acts if a[0] == u]
        seen = [(a[1], max(a[3], 1)) for a in mine if a[2] in ("visualização", "início", "conclusão") or a[3] > 0]
        liked = sorted({a[1] for a in mine if a[2] == "curtida" or (a[5] or 0) >= 4})
        done = {a[1] for a in mine if a[2] == "conclusão" or a[4] >= 100}
        vis = sum((w * unit(vectors[c]) for c, w in seen if c in vectors), np.zeros(DIM))
        cur = sum((unit(vectors[c]) for c in liked if c in vectors), np.zeros(DIM))
        total = sum(w for _, w in seen)
        ranked = []
        for c, cat in enumerate(categories):
            share_t = sum(w for x, w in seen if categories[x] == cat) / total if total else 0
            share_l = sum(categories[x] == cat for x in liked) / len(liked) if liked else 0
            iv = float(unit(vis) @ unit(vectors[c])) if c in vectors and np.linalg.norm(vis) > 0 else share_t
            ic = float(unit(cur) @ unit(vectors[c])) if c in vectors and np.linalg.norm(cur) > 0 else share_l
            score = 0 if c in done else round((min(max(iv, 0), 1) + min(max(ic, 0), 1)) / 2 * 100, 2)
            completed_total += c in done
            if score <= 40:
                negatives += 1
            else:
                ranked.append((-score, c))
        best[u] = [(c, -s) for s, c in sorted(ranked)[:n]]
    return best, negatives, completed_total


@pytest.mark.parametrize("block_contents, block_users", [(4096, 2048), (7, 5)])
def test_recommendations_match_brute_force(world, block_contents, block_users):
    contents, store, interactions, categories, vectors, acts = world
    blocks = recommend.score_blocks(interactions, contents, store, "base", DIM, 5, block_contents, block_users)
    made = {}
    for r in recommend.top_n(blocks, contents, 5, BATCH).orderBy("usuario_id", "posicao").collect():
        made.setdefault(r["usuario_id"], []).append((r["conteudo_id"], float(r["pontuacao"])))
    best, negatives, completed = brute_force(categories, vectors, acts, 5)
    assert made == {u: b for u, b in best.items() if b}
    summed = recommend.summary(blocks, 5).first()
    assert (summed["usuarios_processados"], summed["negativas_descartadas"], summed["negativas_por_conclusao"]) == (len(best), negatives, completed)
    assert summed["total"] == sum(len(b) for b in best.values())
    assert summed["positivas"] == sum(s >= 70 for b in best.values() for _, s in b)


def test_without_likes_the_score_is_half_the_views(spark, world):
    contents, store, *_ = world
    only = spark.createDataFrame([(1, 3, "visualização", 10, 5.0, None)], "usuario_id bigint, conteudo_id bigint, tipo_interacao string, "
                                 "tempo_consumido bigint, percentual_conclusao double, avaliacao_atribuida bigint")
    rows = recommend.top_n(recommend.score_blocks(only, contents, store, "base", DIM), contents, 5, BATCH).collect()
    assert rows and all(abs(float(r["pontuacao"]) - r["ivis"] * 50) < 0.01 and r["icur"] == 0 for r in rows)
    assert rows[0]["conteudo_id"] == 3 and float(rows[0]["pontuacao"]) == 50.0


def test_unknown_user(world):
    contents, store, interactions, *_ = world
    with pytest.raises(ValueError):
        recommend.for_user(interactions, contents, store, 999, "base", DIM, 5, BATCH)


@pytest.mark.parametrize("score, open_flag, expected", [(40.0, 1, "Negativo"), (40.01, 1, "Estável"), (69.99, 1, "Estável"),
                                                        (70.0, 1, "Positivo"), (90.0, 0, "Negativo")])
def test_classes(spark, score, open_flag, expected):
    made = spark.range(1).select(recommend.classify(F.lit(score), F.lit(open_flag)).alias("c")).first()["c"]
    assert made == expected


def test_search_matches_brute_force(spark, world):
    contents, store, _, _, vectors, _ = world
    query = RNG.normal(size=DIM)
    close = sorted(((-float(unit(query) @ unit(v)), i) for i, v in vectors.items()))[:7]
    made = search.semantic_search(store.repartition(5), contents, list(query), 7, "base").collect()
    assert [r["conteudo_id"] for r in made] == [i for _, i in close]
    assert [r["posicao"] for r in made] == list(range(1, 8))
    assert made[0]["similaridade"] == round(-close[0][0], 4)
    assert search.semantic_search(store, contents, list(query), 3, "outro").count() == 0


def test_search_arguments(world):
    contents, store, *_ = world
    with pytest.raises(ValueError):
        search.check_top_k(0)
    encoder = search.hashing_encoder(DIM)()
    with pytest.raises(ValueError):
        search.encode_query("  ", encoder)
    with pytest.raises(ValueError):
        search.demonstration(store, contents, ["a", "b", " "], encoder, 3, "base")
    assert search.demonstration(store, contents, ["a b", "b c", "c d"], encoder, 2, "base").count() == 6


def test_embedding_delta(spark, world):
    contents = world[0].limit(3).unionByName(spark.createDataFrame([(99, None, "Curso", CATEGORIES[0], "  ")], world[0].schema))
    stored = spark.createDataFrame([(0, "base", "t0\n\nd"), (1, "velho", "t1\n\nd")], "conteudo_id bigint, modelo string, texto_origem string")
    made = {r["conteudo_id"]: r["situacao"] for r in search.embedding_delta(contents, stored, "base").collect()}
    assert made == {0: "reaproveitado", 1: "pendente", 2: "pendente", 99: "ignorado_sem_texto"}
    encoded = search.embed_pending(search.embedding_delta(contents, stored, "base"), search.hashing_encoder(16), "base").collect()
    assert sorted(r["conteudo_id"] for r in encoded) == [1, 2]
    assert all(abs(np.linalg.norm(r["vetor"]) - 1) < 1e-6 for r in encoded)


def test_contents_without_a_vector_are_not_paired_with_users(spark):
    """One score per user and category; a user who completed the first contents is given the next ones."""
    contents = spark.createDataFrame([(i, f"t{i}", "Curso", CATEGORIES[i % 2]) for i in range(300)], "conteudo_id long, titulo string, tipo string, categoria string")
    store = spark.createDataFrame([], "conteudo_id long, modelo string, vetor array<double>")
    acts = [(u, 2 * k, "conclusão", 10, 100.0, 5) for u in range(4) for k in range(1, 3 * u + 1)] + [(9, 0, "visualização", 10, 20.0, None), (9, 1, "curtida", 0, 20.0, 5)]
    interactions = spark.createDataFrame(acts, "usuario_id long, conteudo_id long, tipo_interacao string, tempo_consumido long, percentual_conclusao double, avaliacao_atribuida long")
    blocks = recommend.score_blocks(interactions, contents, store, "base", DIM, 5).cache()
    made = {}
    for r in recommend.top_n(blocks, contents, 5, BATCH).orderBy("usuario_id", "posicao").collect():
        made.setdefault(r["usuario_id"], []).append((r["conteudo_id"], float(r["pontuacao"])))
    wanted = {u: [(i, 100.0) for i in [0, *range(6 * u + 2, 300, 2)][:5]] for u in (1, 2, 3)}
    # user 9 spent all minutes in one category and liked only the other: 50 points in either, ties by id
    assert made == wanted | {9: [(i, 50.0) for i in range(5)]}
    counted = recommend.summary(blocks, 5).first()
    assert counted["negativas_por_conclusao"] == 18
    assert counted["negativas_descartadas"] == sum(150 + 3 * u for u in (1, 2, 3))
    scored, pairs = recommend.scored_pairs(blocks).first()
    assert pairs == 4 * 300 and scored <= 4 * 2
