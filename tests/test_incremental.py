"""Incremental Bronze and the vector index."""

import json

import numpy as np
import pytest

from cascata.operators import search, vector_index
from cascata.schemas import CATEGORIES, INTERACTION_COLUMNS, bronze_schema
from cascata.session import new_folder
from cascata.streaming.bronze_stream import ingest_new_files


def test_each_file_is_taken_once(spark, tmp_path):
    folder, bronze, checkpoint = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "marcas")
    folder.mkdir()

    def arrive(name, users):
        rows = [{"usuario_id": u, "conteudo_id": 1, "tipo_interacao": "início"} for u in users]
        (folder / name).write_text(json.dumps(rows))

    def run():
        ingest_new_files(spark, str(folder), "interacoes", INTERACTION_COLUMNS, bronze, checkpoint, "carga").awaitTermination()
        return spark.read.schema(bronze_schema(INTERACTION_COLUMNS)).parquet(bronze)

    arrive("a.json", [1, 2])
    assert run().count() == 2
    arrive("b.json", [3])
    assert sorted(r["usuario_id"] for r in run().collect()) == ["1", "2", "3"]
    assert run().select("execucao_id").distinct().count() == 2
    (folder / "c.json").write_text('[{"usuario_id": 4, "conteudo_id"')
    arrive("d.json", [5])
    assert sorted(r["usuario_id"] for r in run().collect()) == ["1", "2", "3", "5"]
    (entry,) = spark.read.parquet(bronze + "_ilegiveis").collect()
    assert (entry["registro_id"], entry["regra_violada"]) == ("arquivo:c.json", "ARQUIVO_CORROMPIDO")


@pytest.mark.parametrize("spread", [0.2, 3.0])
def test_index_gives_the_exact_neighbours(spark, spread):
    rng = np.random.default_rng(5)
    dim, total = 6, 800
    centres = rng.normal(size=(10, dim)) * 3
    found = centres[rng.integers(10, size=total)] + rng.normal(size=(total, dim)) * spread
    store = spark.createDataFrame([(i, "base", [float(x) for x in v]) for i, v in enumerate(found)],
                                  "conteudo_id bigint, modelo string, vetor array<float>")
    contents = spark.createDataFrame([(i, "t", "Curso", CATEGORIES[0]) for i in range(total)],
                                     "conteudo_id bigint, titulo string, tipo string, categoria string")
    path = new_folder(spark, "indice")
    vector_index.build_index(store, "base", dim, path, cells=16)
    for query in rng.normal(size=(4, dim)):
        plain = search.semantic_search(store, contents, list(query), 9, "base").collect()
        assert vector_index.indexed_search(spark, path, contents, list(query), 9).collect() == plain
