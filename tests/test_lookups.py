"""Look-ups that open few files, and searches and recommendations that skip cells."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cascata.operators import lookup_store, lookups, recommend, vector_index
from cascata.schemas import CATEGORIES
from cascata.session import new_folder

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    documents = spark.range(40_000).select(
        F.col("id").alias("usuario_id"), F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 997).alias("conteudo_id"),
        (F.col("id") % 6).alias("avaliacao"), F.lit("bom").alias("comentario"),
        F.array(F.concat(F.lit("t"), F.col("id") % 400), F.lit("todos")).alias("tags"), F.date_add(F.lit(DAY), (F.col("id") % 90).cast("int")).alias("data"))
    interactions = spark.range(30_000).select(
        (F.col("id") % 500).alias("usuario_id"), (F.col("id") % 83).alias("conteudo_id"), F.lit("conclusão").alias("tipo_interacao"),
        F.lit(10.0).alias("percentual_conclusao"))
    batches = spark.range(6_000).select(
        (F.col("id") % 500).alias("usuario_id"), (F.col("id") % 83).alias("conteudo_id"), F.lit(50.0).alias("pontuacao"),
        (F.col("id") / 500).cast("int").alias("posicao"), F.lit("Estável").alias("classificacao"),
        F.timestamp_add("DAY", (F.col("id") % 2).cast("int"), F.lit(dt.datetime(2024, 1, 1))).cast("timestamp_ntz").alias("gerado_em"))
    contents = spark.range(1000).select(F.col("id").alias("conteudo_id"), F.lit("t").alias("titulo"), F.lit("c").alias("categoria"))
    base = new_folder(spark, "consultas")
    version = lookup_store.build(spark, base, "r", documents.distinct(), interactions, batches)
    return lookup_store.Store(spark, base, version), documents.distinct(), interactions, batches, contents


def scanned(rows):
    """Files opened and rows that left the scans of a plan that was run."""
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    files = out = 0
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec":
            files += node.metrics().apply("numFiles").value()
            out += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return files, out


def test_a_lookup_opens_the_files_of_one_bucket_and_skips_most_of_their_rows(tables):
    store, documents, *_ = tables
    listed = sum(len(f) for f in store.version.tables["comentarios"].parts.values())
    found = store.of("comentarios", "conteudo_id", [123])
    files, rows = scanned(found)
    assert listed > 16 and files <= 2
    assert found.count() == documents.where("conteudo_id = 123").count() and rows < documents.count() / 10


def test_lookups_equal_the_scans_they_replace(tables):
    store, documents, interactions, batches, contents = tables
    for content in (5, 123, 99_999):
        assert store.comments_of_content(content).collect() == lookups.comments_of_content(documents, content).collect()
    for tag in ("todos", "t7", "nenhuma"):
        assert store.comments_by_tag(tag).collect() == lookups.comments_by_tag(documents, tag).collect()
    assert store.completed_by_user(contents, 44).collect() == lookups.completed_by_user(interactions, contents, 44).collect()
    newest = batches.agg(F.max("gerado_em")).first()[0]
    assert store.user_ranking(contents, 45, newest).collect() == lookups.user_ranking(batches, contents, 45).collect()


# ------------------------------------------------------------------ cells


def clustered(rng, n, dim=12, spread=0.05):
    middles = np.eye(dim)
    rows = middles[rng.integers(0, dim, n)] + rng.normal(size=(n, dim)) * spread
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.mark.parametrize("spread, most", [(0.05, 0.5), (3.0, 1.0)])
def test_a_batch_search_is_exact_and_reads_few_cells_where_vectors_cluster(spark, spread, most, monkeypatch):
    monkeypatch.setattr(vector_index, "QUERIES_AT_ONCE", 16)
    rng = np.random.default_rng(2)
    held = clustered(rng, 400, spread=spread).astype(np.float32)
    store = spark.createDataFrame([(i, "m", v.tolist()) for i, v in enumerate(held)], "conteudo_id long, modelo string, vetor array<float>")
    path = new_folder(spark, "indice")
    vector_index.build_index(store, "m", 12, path)
    asked = {f"q{i}": v for i, v in enumerate(clustered(rng, 40, spread=spread))}
    rows = [(n, v.tolist()) for n, v in asked.items()] + [("q0", asked["q0"].tolist()), ("curta", [1.0, 2.0]), ("zero", [0.0] * 12), ("nula", None)]
    hits, read = vector_index.indexed_batch(spark, path, spark.createDataFrame(rows, "consulta string, vetor array<double>"), 7)
    made = {}
    for r in hits.orderBy("consulta", "posicao").collect():
        made.setdefault(r["consulta"], []).append(r["conteudo_id"])
    unit = held.astype(float) / np.linalg.norm(held.astype(float), axis=1, keepdims=True)
    for name, v in asked.items():
        close = np.round(unit @ (v / np.linalg.norm(v)), 12)
        assert made.pop(name) == np.lexsort((np.arange(400), -close))[:7].tolist()
    assert not made
    cells = spark.read.parquet(f"{path}/celulas").count()
    assert read.agg(F.avg("celulas_lidas")).first()[0] <= most * cells


def test_recommendations_score_few_pairs_where_vectors_cluster(spark):
    rng = np.random.default_rng(4)
    n, users = 600, 30
    vectors = clustered(rng, n)
    contents = spark.createDataFrame([(i, f"t{i}", "Curso", CATEGORIES[i % 4]) for i in range(n)], "conteudo_id long, titulo string, tipo string, categoria string")
    store = spark.createDataFrame([(i, "m", v.tolist()) for i, v in enumerate(vectors) if i % 50], "conteudo_id long, modelo string, vetor array<double>")
    near = {u: int(rng.integers(n)) for u in range(users)}
    acts = []
    for u, c in near.items():
        alike = np.argsort(-(vectors @ vectors[c]))[:6]
        acts += [(u, int(x), "visualização" if j % 3 else "conclusão", 10, 100.0 if j % 3 == 0 else 20.0, 5 if j % 2 else None) for j, x in enumerate(alike)]
    interactions = spark.createDataFrame(acts, "usuario_id long, conteudo_id long, tipo_interacao string, tempo_consumido long, percentual_conclusao double, avaliacao_atribuida long")
    made = recommend.score_blocks(interactions, contents, store, "m", 12, n=5, block_contents=100, block_users=8).cache()
    scored, pairs = recommend.scored_pairs(made).first()
    assert pairs == n * users and 0 < scored < 0.3 * pairs
    # the same without any cell being passed over
    whole = recommend.score_blocks(interactions, contents, store, "m", 12, n=5, cells=1)
    assert recommend.summary(made, 5).collect() == recommend.summary(whole, 5).collect()
    assert recommend.top_n(made, contents, 5, "2024-03-01").orderBy("usuario_id", "posicao").collect() == \
        recommend.top_n(whole, contents, 5, "2024-03-01").orderBy("usuario_id", "posicao").collect()
