"""The job from raw files to recommendations, run twice, and its private publication."""

import json

import pytest

from cascata.operators import search
from cascata.plans.medallion import Paths
from cascata.plans.platform import Platform, Settings, run_platform
from cascata.session import shared_dir
from cascata.sources import versions, writers

SETTINGS = Settings("base", 16, search.hashing_encoder(16), ("banco de dados", "nuvem aws", "redes e dados"))
SALT = "sal-de-teste-0123456"


def catalogue(path, extra=""):
    rows = [f'{i},Titulo {i} {["dados", "nuvem", "redes"][i % 3]},Curso,Banco de Dados,Básico,{10 * i},2024-01-0{i},texto {["dados", "aws", "cabos"][i % 3]},Ana Lima' for i in range(1, 10)]
    path.write_text("conteudo_id,titulo,tipo,categoria,nivel,carga_horaria_min,data_publicacao,descricao,autor\n" + "\n".join(rows) + extra)


@pytest.fixture
def paths(tmp_path):
    kinds = ["visualização", "início", "conclusão", "curtida", "dormindo"]
    acts = [{"usuario_id": u, "conteudo_id": c, "tipo_interacao": kinds[(u * c) % 5], "data_hora": f"2024-01-0{1 + (u + c) % 9}T08:00:0{u}",
             "tempo_consumido": 5, "percentual_conclusao": 10.0, "avaliacao_atribuida": 5 if c % 2 else None} for u in range(1, 5) for c in range(1, 8)]
    said = [{"usuario_id": u, "conteudo_id": 1 + u, "avaliacao": 4, "comentario": "muito bom mesmo, recomendo", "tags": ["A", " b"], "data": "2024-02-01"} for u in range(1, 5)]
    for name, rows in (("i", acts), ("c", said)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(json.dumps(rows))
    catalogue(tmp_path / "catalogo.csv", "\nx,Ruim,Curso,Nada,Básico,1,2024-01-01,,B\n")
    return Paths(str(tmp_path / "catalogo.csv"), str(tmp_path / "i"), str(tmp_path / "c"), str(tmp_path / "base"))


def report(spark, paths, run_id, name):
    return spark.read.json(paths.layer(f"relatorios/{run_id}/{name}"))


def test_from_files_to_recommendations_twice(spark, paths, tmp_path):
    before = spark._jvm.java.io.File(shared_dir(spark)).list()
    run = run_platform(spark, paths, SETTINGS, "r1", SALT)
    assert set(spark._jvm.java.io.File(shared_dir(spark)).list()) == set(before)  # intermediates are gone
    assert {n: run.table(n).count() for n in ("usuario", "conteudo", "interacao", "comentario", "embedding_conteudo")} == {
        "usuario": 4, "conteudo": 9, "interacao": 22, "comentario": 4, "embedding_conteudo": 9}
    summary = {r["fonte"]: r for r in report(spark, paths, "r1", "resumo_ingestao").collect()}
    assert (summary["catalogo"]["lidos"], summary["catalogo"]["invalidos"], summary["catalogo"]["carregados"]) == (10, 1, 9)
    assert summary["interacoes"]["invalidos"] == 6 and summary["interacoes"]["carregados"] == 22
    assert list(summary["catalogo"]["tempos_etapas"].asDict()) and summary["catalogo"]["tempo_total_segundos"] > 0
    assert report(spark, paths, "r1", "busca").select("consulta").distinct().count() == 3
    batch = spark.read.parquet(paths.layer("recomendacoes"))
    counters = report(spark, paths, "r1", "resumo_recomendacoes").first()
    assert counters["total"] == batch.count() == report(spark, paths, "r1", "recomendacoes").count() and counters["usuarios_processados"] == 4
    assert report(spark, paths, "r1", "kpis").where("medida = 'total_interacoes' and item = 'geral'").first()["valor"] == 22.0
    assert {r["situacao"]: r["total"] for r in report(spark, paths, "r1", "embeddings").collect()} == {"pendente": 9}

    names = {r["usuario_id"]: r["pseudo_id"] for r in spark.read.parquet(f"{paths.layer('lgpd_restrito')}/dados").collect()}
    assert set(writers.read_current(spark, paths.layer("lgpd"), "vw_interacao_pseudonimizada").columns).isdisjoint({"usuario_id"})
    catalogue(tmp_path / "catalogo.csv", "\n10,Novo dados,Curso,Banco de Dados,Básico,5,2024-02-02,novo,Bia\n")
    again = run_platform(spark, paths, SETTINGS, "r2", SALT)
    assert again.table("conteudo").count() == 10 and again.table("interacao").count() == 22
    assert {r["situacao"]: r["total"] for r in report(spark, paths, "r2", "embeddings").collect()} == {"pendente": 1, "reaproveitado": 9}
    assert {r["usuario_id"]: r["pseudo_id"] for r in spark.read.parquet(f"{paths.layer('lgpd_restrito')}/dados").collect()} == names
    assert writers.current_version(spark, paths.layer("lgpd")) == "r2"


def test_an_unreadable_file_ends_the_run_before_anything_is_loaded(spark, paths, tmp_path):
    (tmp_path / "i" / "b.json").write_text("[{")
    with pytest.raises(ValueError, match="b.json"):
        run_platform(spark, paths, SETTINGS, "r1")
    assert versions.newest(spark, paths.layer("loja")) == versions.NOTHING


def test_a_leak_blocks_the_publication(spark, paths, monkeypatch):
    run_platform(spark, paths, SETTINGS, "r1")
    run = Platform(spark, paths, SETTINGS, "r2")
    from cascata.operators import privacy
    whole = privacy.comments_masked
    monkeypatch.setattr(privacy, "comments_masked", lambda rows, names: whole(rows, names).withColumnRenamed("comentario_mascarado", "comentario"))
    with pytest.raises(ValueError, match="coluna identificadora"):
        run.publish_private(SALT)
    assert versions.newest(spark, paths.layer("lgpd")) == versions.NOTHING
